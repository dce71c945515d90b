"""Importance resampling towards a target distribution.

A text's features are its runs of one to ``longest`` words, hashed into
buckets. How much more often a bucket occurs in the target than in the corpus
is an array of ``buckets`` gains; a document's weight is the sum of the gains
of its features, and its score adds a Gumbel number from the hash of its id,
so that the highest scores are a draw without replacement.

The ranks come from a parallel sort by regular sampling:

1. Every task scores its documents and sorts them; the sorted runs are written
   as a table with each row's run and place in it.
2. Places at regular distances in all runs give the sample, and places at
   regular distances in the sorted sample give the splitters.
3. Rows are counted per segment between splitters; prefix sums of the counts
   say where each segment begins.
4. Segments that begin within the draw are exchanged, one to a task, and
   merged there; a row's rank is its segment's beginning plus its place. The
   other segments lie behind the draw and stay where they are.

Keys are (score descending, id, run, place), which no two rows share, so equal
ids or scores cannot crowd a segment. A segment exceeds its share by at most
``1 / samples`` of the rows per run. The driver holds the gains and at most
two times ``samples`` keys, however many documents there are.

Defined results: a null text has no words; a null id hashes as an empty string
and comes last among equal scores; repeated rows are documents of their own,
their order among equal ids and scores being that of the written runs. An
empty target or corpus has no features (gains follow from the formula). Other
columns are not returned.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code

# What is no part of a word becomes a space, A-Z become lower case; the bytes of non-ASCII characters stay.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LAST_ID = (1 << 63) - 1


def feature_codes(body: bytes | None, longest: int = 3) -> tuple[int, np.ndarray]:
    """Number of words, and the CRC-32 of every run of 1 to ``longest`` words.
    A run's checksum continues that of the run without its last word."""
    words = (body or b"").translate(WORD_BYTES).split()
    spaced = [b" " + w for w in words]
    runs = list(map(crc32, words))
    codes = runs
    for more in range(1, longest):
        runs = list(map(crc32, spaced[more:], runs))
        codes = codes + runs
    return len(words), np.array(codes, dtype=np.uint32)


def bucket_counts(docs: DataFrame, text_col: str, buckets: int, longest: int) -> np.ndarray:
    """Features per bucket over all texts, summed in each task before the shuffle."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for body in batch.column(0):
                _, codes = feature_codes(body.as_py(), longest)
                total += np.bincount(codes % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some])})

    parts = docs.select(F.col(text_col).cast("binary").alias("body")).filter("body IS NOT NULL").mapInArrow(emit, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) / (T + B)) / ((s + 1) / (S + B)))) per bucket, with B buckets."""
    b, big_s, big_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (big_s + b) / ((s + 1) * (big_t + b))))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def weigh(body: Column, gains: np.ndarray, longest: int) -> Column:
    """struct(n_words, n_features, weight) of a text's bytes."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weights(bodies: pd.Series) -> pd.DataFrame:
        out = []
        for text in bodies:
            n, codes = feature_codes(text, longest)
            out.append((n, len(codes), int(gains[codes % len(gains)].sum())))
        return pd.DataFrame(out, columns=["n_words", "n_features", "weight"])

    return weights(body)


def gumbel(id_col: str, salt: str) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of the sha256 of salt and id."""
    text = F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def sorted_runs(rows: DataFrame) -> DataFrame:
    """``rows`` (eligible, score, key, ...) as a written table whose files are
    runs sorted by score; ``at`` holds the run and the place in it."""
    runs = rows.sortWithinPartitions(F.col("eligible").desc(), F.col("score").desc(), "key")
    return shared_table(runs.withColumn("at", F.monotonically_increasing_id()))


def _place_in_run() -> Column:
    return F.col("at").bitwiseAND(F.lit((1 << 33) - 1))


def regular_splitters(runs: DataFrame, n: int, samples: int, segments: int) -> list[tuple]:
    """Keys that cut all rows into about equal segments, from regular places of the runs."""
    step = max(1, -(-n // samples))
    drawn = runs.filter(F.col("eligible") & (_place_in_run() % step == step // 2)).select("score", "key", "at").collect()
    keys = sorted((-r.score, r.key, r.at) for r in drawn)
    return [keys[len(keys) * i // segments] for i in range(1, segments)] if len(keys) >= segments else keys


def segment_of(splitters: list[tuple]) -> Column:
    """Number of splitters that do not come after the row."""
    first = np.array([s[0] for s in splitters], dtype=np.int64)

    @F.pandas_udf("int")
    def place(score: pd.Series, key: pd.Series, at: pd.Series) -> pd.Series:
        falling = -score.to_numpy()
        low, high = np.searchsorted(first, falling, "left"), np.searchsorted(first, falling, "right")
        for i in np.flatnonzero(low < high):  # the score of a splitter: id, run and place decide
            low[i] = bisect_right(splitters, (falling[i], key[i], at[i]), low[i], high[i])
        return pd.Series(low.astype(np.int32))

    return place("score", "key", "at")


def _before(splitter: tuple) -> Column:
    score, key, at = -splitter[0], splitter[1], splitter[2]
    return (F.col("score") > score) | ((F.col("score") == score) & (
        (F.col("key") < key) | ((F.col("key") == key) & (F.col("at") < at))))


def rank_best(runs: DataFrame, n: int, k: int, samples: int, segments: int) -> DataFrame:
    """``runs`` with ``rank``: 1 to k for the k highest keys of the n eligible rows, null for the rest."""
    none = F.lit(None).cast("long")
    if k < 1:
        return runs.withColumn("rank", none)
    splitters = regular_splitters(runs, n, samples, segments)
    sized = runs.filter("eligible").groupBy(segment_of(splitters).alias("segment")).count().collect()  # one row per segment
    counts = np.zeros(len(splitters) + 1, dtype=np.int64)
    for r in sized:
        counts[r.segment] = r["count"]
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
    used = int((begins < k).sum())
    inside = F.col("eligible") if used > len(splitters) else F.col("eligible") & _before(splitters[used - 1])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, int] = {}
        for batch in batches:
            segment = batch.column(batch.schema.get_field_index("segment")).to_numpy()
            present, first, size = np.unique(segment, return_index=True, return_counts=True)  # contiguous, as sorted
            rank = np.arange(1, len(segment) + 1)
            for s, f, m in zip(present.tolist(), first.tolist(), size.tolist()):
                rank[f:f + m] += begins[s] + met.get(s, 0) - f
                met[s] = met.get(s, 0) + m
            kept = batch.drop_columns(["segment"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(rank, mask=rank > k)], names=[*kept.schema.names, "rank"])

    schema = ", ".join(f"`{c}` {t}" for c, t in runs.dtypes) + ", rank long"
    merged = (runs.filter(inside).withColumn("segment", segment_of(splitters)).repartitionById(len(splitters) + 1, F.col("segment"))
              .sortWithinPartitions("segment", F.col("score").desc(), "key", "at").mapInArrow(number, schema))
    return merged.union(runs.filter(~inside).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, buckets: int = 10000, longest: int = 3,
             id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", salt: str = "42:",
             samples: int = 1 << 16, segments: int | None = None) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank`` (null if not drawn).

    Of the N documents with at least ``min_words`` words, floor(percent N / 100)
    of the highest scores are drawn. ``id_col`` holds integers. ``segments``
    follows ``spark.sql.shuffle.partitions`` unless given.
    """
    spark = docs.sparkSession
    ship_code(spark)
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("body"))
    scored = slim.select("id", weigh(F.col("body"), gains, longest).alias("w")).select(
        "id", "w.*", F.coalesce(F.col("id").cast("long"), F.lit(LAST_ID)).alias("key"))
    scored = scored.withColumn("score", F.col("weight") + gumbel("id", salt)).withColumn("eligible", F.col("n_words") >= min_words)
    runs = sorted_runs(scored)
    n = runs.filter("eligible").count()
    parts = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = rank_best(runs, n, percent * n // 100, samples, parts)
    return ranked.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")
