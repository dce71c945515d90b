"""Line dedup: drop lines that recur across documents.

Lines are exploded to 128-bit hashes of their normalised form, the distinct
documents of each hash are counted, and each text is rebuilt by position
without the lines it loses. The texts are hashed once, into a written table of
hashes and ids; only these are shuffled for the count, and the texts move
once, to meet the list of hashes that their own document loses. A hot line
costs one row per document in a two-level count, so no task receives it whole.
Verdicts come back to the hashes by a join, but for the hottest lines, those
with more than 1 / ``HOT_PARTS`` of all rows: there are fewer than
``HOT_PARTS`` of them, whatever the data, so they are broadcast and their rows
stay where they are.

Defined results: a null or empty text is one empty line; a document with a
null id neither counts nor loses lines; repeated rows of one id count as one
document; columns other than id and text pass through untouched, except that
``n_lines`` and ``n_dropped`` are replaced if the input has such columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code

# The six ASCII white-space characters x20 and x09-x0D.
BLANKS = b" \t\n\x0b\x0c\r"
HOT_PARTS = 2000


def _line_hashes(lines: list[bytes], min_chars: int) -> list[bytes | None]:
    """The 16-byte hash of each line's key; None where the key is shorter than
    ``min_chars`` code points. ``bytes.lower`` maps A-Z only."""
    digest, out = xxhash.xxh3_128_digest, []
    for line in lines:
        key = line.strip(BLANKS)
        if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
            out.append(None)
        else:
            out.append(digest(key.lower()))
    return out


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row (id, h1, h2) per distinct long key of each document."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, digests = [], []
            for doc, text in zip(pdf["id"], pdf["body"]):
                own = set(_line_hashes(text.split(b"\n"), min_chars))
                own.discard(None)
                digests.extend(own)
                ids.append(np.full(len(own), doc, dtype=np.int64))
            pair = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
            yield pd.DataFrame({"id": np.concatenate(ids) if ids else np.empty(0, np.int64),
                                "h1": pair[:, 0], "h2": pair[:, 1]})

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("body"))
    return slim.filter("id IS NOT NULL AND body IS NOT NULL").mapInPandas(emit, "id long, h1 long, h2 long")


def dropped_keys(keys: DataFrame, min_docs: int) -> DataFrame:
    """Keys found in at least ``min_docs`` documents, with the document that keeps them."""
    return (keys.groupBy("h1", "h2")
            .agg(F.count_distinct("id").alias("n"), F.max("id").alias("keeper"))
            .filter(F.col("n") >= min_docs).select("h1", "h2", "keeper", "n"))


def lost_lines(keys: DataFrame, min_docs: int) -> DataFrame:
    """The rows of ``keys`` (id, h1, h2) that their document loses."""
    dropped = shared_table(dropped_keys(keys, min_docs))
    limit = max(keys.count() // HOT_PARTS, 1)
    hot = F.broadcast(dropped.filter(F.col("n") > limit))  # fewer than HOT_PARTS
    met = keys.join(hot, ["h1", "h2"], "left")
    few = met.filter("keeper IS NULL").select("id", "h1", "h2").join(
        dropped.filter(F.col("n") <= limit).select("h1", "h2", "keeper"), ["h1", "h2"])
    return met.select("id", "h1", "h2", "keeper").union(few.select("id", "h1", "h2", "keeper")).filter("id < keeper")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the surviving lines as text, plus ``n_lines`` (before) and ``n_dropped``.

    A key is a line stripped of ASCII white space with A-Z lower-cased. Keys of
    at least ``min_chars`` code points in at least ``min_docs`` documents stay
    only in the largest id that holds them, there with all their lines.
    """
    ship_code(docs.sparkSession)
    keys = shared_table(line_keys(docs, id_col, text_col, min_chars))
    lost = (lost_lines(keys, min_docs)
            .groupBy(F.col("id").alias("__lost_id"))
            .agg(F.collect_set(F.struct("h1", "h2")).alias("__lost")))

    @F.pandas_udf("kept binary, n_lines long, n_dropped long")
    def rebuild(body: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        kept, total, gone = [], [], []
        for text, a, b in zip(body, h1, h2):
            lines = (text or b"").split(b"\n")
            total.append(len(lines))
            if a is not None and len(a):
                raw = np.stack([a, b], axis=1).astype(">i8").tobytes()
                bad = {raw[i:i + 16] for i in range(0, len(raw), 16)}
                lines = [x for x, h in zip(lines, _line_hashes(lines, min_chars)) if h not in bad]
            gone.append(total[-1] - len(lines))
            kept.append(b"\n".join(lines))
        return pd.DataFrame({"kept": kept, "n_lines": total, "n_dropped": gone})

    plain = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    out = docs.select(*plain).join(lost, F.col(id_col).cast("long") == F.col("__lost_id"), "left")
    out = out.withColumn("__r", rebuild(F.col(text_col).cast("binary"), F.col("__lost.h1"), F.col("__lost.h2")))
    return out.select(*[F.col("__r.kept").cast("string").alias(c) if c == text_col else F.col(c) for c in plain],
                      "__r.n_lines", "__r.n_dropped")
