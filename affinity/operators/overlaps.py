"""Overlaps of the sets of many pairs, by sets packed into chunks.

Items are numbered by falling frequency and a set becomes one row per chunk of
``CHUNK`` numbers that it touches: up to ``FEW`` items as an array of their
places in the chunk, more as a bitmap of 64-bit words. So a row has at most
4 KB, a set of n items has at most min(n, items / CHUNK) rows, frequent
items share the first chunks, and a pair meets its partner chunk by chunk
instead of item by item. The overlap of two chunks is an array intersection, a
look-up of places in a bitmap, or the bit count of an AND.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.operators.skew import dense_numbers

CHUNK = 32768
WORDS = CHUNK // 64
FEW = 512


def packed_sets(rows: DataFrame, user: str, item: str) -> DataFrame:
    """(user, chunk, places array<int> or words array<bigint>) of distinct (user, item) rows."""
    counted = rows.groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    numbers = dense_numbers(counted, [F.col("_n").desc(), item], "_number").select(item, "_number")
    placed = rows.select(user, item).join(numbers, item).select(
        user, F.expr(f"_number div {CHUNK}").alias("chunk"), (F.col("_number") % CHUNK).cast("int").alias("place"))
    words = placed.groupBy(user, "chunk", F.expr("place div 64").cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, place % 64)")).alias("bits"), F.count(F.lit(1)).alias("n"))
    listed = words.groupBy(user, "chunk").agg(  # at most WORDS entries
        F.array_sort(F.collect_list(F.struct("w", "bits"))).alias("l"), F.sum("n").alias("n"))
    places = F.flatten(F.transform("l", lambda x: F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(
            F.getbit(x["bits"], b) == 1, x["w"] * 64 + b)), lambda p: p.isNotNull())))
    filled = F.map_from_entries("l")
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.element_at("m", w), F.lit(0).cast("bigint")))
    return listed.withColumn("m", filled).select(user, "chunk", F.when(F.col("n") <= FEW, places).alias("places"),
                                                 F.when(F.col("n") > FEW, dense).alias("words"))


def _looked_up(places: str, words: str) -> Column:
    """How many of the places are set in the bitmap."""
    return F.aggregate(places, F.lit(0), lambda n, p: n + F.getbit(
        F.get(F.col(words), F.floor(p / 64).cast("int")), p % 64).cast("int"))


def chunked_overlaps(pairs: DataFrame, rows: DataFrame, user: str, item: str) -> DataFrame:
    """(user1, user2, n_shared) of the distinct ``pairs`` that share an item;
    ``rows`` holds distinct (user, item) without nulls."""
    sets = packed_sets(rows, user, item)
    one, two = ([F.col(user).alias(f"user{i}"), "chunk", F.col("places").alias(f"p{i}"), F.col("words").alias(f"w{i}")] for i in (1, 2))
    met = pairs.select("user1", "user2").join(sets.select(*one), "user1").join(sets.select(*two), ["user2", "chunk"])
    both = F.aggregate(F.zip_with("w1", "w2", lambda a, b: F.bit_count(a.bitwiseAND(b))), F.lit(0), lambda n, x: n + x)
    overlap = (F.when(F.col("w1").isNotNull() & F.col("w2").isNotNull(), both)
               .when(F.col("w1").isNotNull(), _looked_up("p2", "w1")).when(F.col("w2").isNotNull(), _looked_up("p1", "w2"))
               .otherwise(F.size(F.array_intersect("p1", "p2"))))
    return met.groupBy("user1", "user2").agg(F.sum(overlap).alias("n_shared")).filter("n_shared > 0")
