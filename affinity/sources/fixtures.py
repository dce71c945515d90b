"""Interaction tables derived from the driver's parquet tables.

There is no rating table in the test data, so each operator family reads a
view built from one: ``ratings`` (customers rating parts through their
orders), ``event_items`` (users touching items in the event log) and
``doc_words`` (documents as sets of words). Each has a Spark builder
and an equal DuckDB SQL text, used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.bounds import small_side
from affinity.session import reliable_checkpoint

# The number that stands for a word in a hash function: 32 bits of its md5, in
# either engine. Sets, their sizes and Jaccard use the words themselves.
WORD_NUMBER = "CAST(conv(substring(md5(item_id), 1, 8), 16, 10) AS BIGINT)"
WORD_NUMBER_SQL = "('0x' || substr(md5(item_id), 1, 8))::BIGINT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id int, item_id int, rating double, ts timestamp): one row per
    (customer, part); rating = ceil(avg quantity / 5) / 2 in 0.5..5.0, time =
    first order date."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return (j.groupBy(F.col("o_custkey").cast("int").alias("user_id"),
                      F.col("l_partkey").cast("int").alias("item_id"))
            .agg((F.ceil(F.avg("l_quantity") / 5) / 2).alias("rating"),
                 F.min("o_orderdate").alias("ts")))


RATINGS_SQL = """
SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS item_id,
       ceil(avg(l_quantity) / 5) / 2 AS rating, min(o_orderdate) AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
"""


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id int, rating double): item = the ``k`` key of the event
    properties, rating = mean event value."""
    ev = table(spark, sf_dir, "events").select("user_id", "props", "value")
    return (ev.groupBy("user_id",
                       F.get_json_object("props", "$.k").cast("int").alias("item_id"))
            .agg(F.avg("value").alias("rating")))


EVENT_ITEMS_SQL = """
SELECT user_id, CAST(json_extract_string(props, '$.k') AS INT) AS item_id,
       avg(value) AS rating
FROM events GROUP BY 1, 2
"""


def doc_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id string): the distinct lower-case words of each document,
    over the whole text.

    A row's words are made distinct where they are split, without a shuffle, and
    come one after the other. Only documents that share their id with another
    row, or have none, need a ``distinct`` over rows; their ids are counted first.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("item_id")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    again = reliable_checkpoint(ids.filter((F.col("_n") > 1) | F.col("doc_id").isNull()).select("doc_id"))
    if again.isEmpty():
        return docs.select("doc_id", words)
    shared = small_side(again.withColumn("_again", F.lit(True)).withColumnRenamed("doc_id", "_id"))
    told = docs.join(shared, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    once, several = (told.filter(c).select("doc_id", words) for c in (F.col("_again").isNull(), F.col("_again")))
    return once.unionByName(several.distinct())


DOC_WORDS_SQL = """
SELECT DISTINCT doc_id, item_id
FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS item_id FROM documents)
"""


def texts_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part_id int, rating double, note string): parts with free text that
    holds quotes, commas, line breaks, empty strings and nulls."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    name, kind = F.col("p_name"), F.pmod(F.col("p_partkey"), F.lit(5))
    note = (F.when(kind == 0, F.concat(F.lit('say "'), name, F.lit('", ok')))
            .when(kind == 1, F.concat(name, F.lit("\n,next")))
            .when(kind == 2, F.lit("")).when(kind == 3, name))
    return part.select(F.col("p_partkey").cast("int").alias("part_id"),
                       (F.col("p_size") / 2).cast("double").alias("rating"), note.alias("note"))


TEXTS_OF_PARTS_SQL = """
SELECT CAST(p_partkey AS INT) AS part_id, CAST(p_size / 2 AS DOUBLE) AS rating,
       CASE p_partkey % 5 WHEN 0 THEN 'say "' || p_name || '", ok' WHEN 1 THEN p_name || chr(10) || ',next'
            WHEN 2 THEN '' WHEN 3 THEN p_name END AS note
FROM part
"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels: a table with real nulls, for null profiling."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left")


LABELLED_DOCUMENTS_SQL = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l USING (doc_id)
"""
