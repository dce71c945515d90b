"""SimHash near-dedup by pigeonhole blocks.

A fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of a
text's word shingles. Two fingerprints that differ in at most ``max_bits`` of
``blocks`` blocks share at least ``blocks - max_bits`` whole blocks, so every
choice of that many blocks is one join key and every close pair meets under
at least one key. Equal fingerprints are collapsed first, which takes exact
copies out of all further work. Within a key only a spanning forest of the
verified links is emitted, never all pairs, and connected components follow
from iterated star contraction on the emitted links.

A key fixes half of the 64 bits; a group under it holds distinct fingerprints
only (8 bytes each), streamed in key order, one group in memory at a time.

Defined results: a null text or one without words has fingerprint zero and
links like any other; repeated rows share their fingerprint and component;
null ids are ignored by the minimum (a component of null ids only has a null
component id); extra columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code
from affinity.llm.graph import connected_components

SEED = 42
CHUNK = 1 << 16  # shingles whose bits are unpacked at once


def simhash(text: bytes, size: int = 3) -> int:
    """The signed 64-bit fingerprint of one text. ``bytes.lower`` maps A-Z only
    and ``bytes.split`` splits at x20 and x09-x0D only."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0] + [e + 1 for e in ends[:-1]]
    ends = ends[size - 1:] or [len(joined)]
    digest, n, votes = xxhash.xxh64_digest, len(ends), np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])])
        votes += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big", signed=True)


def _masks(blocks: int, share: int) -> list[int]:
    """One 64-bit mask (as a signed long) per choice of ``share`` of ``blocks`` blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [int(np.uint64(sum(c)).astype(np.int64)) for c in combinations(parts, share)]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def _forest(group: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect exactly what the links within ``max_bits`` connect:
    breadth-first search that compares each reached value with those not yet
    reached, so a dense group is exhausted after a few comparisons."""
    links, rest = [], group
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = _popcount(rest ^ x) <= max_bits
            if near.any():
                found = rest[near]
                links.extend((int(x), int(y)) for y in found)
                queue.extend(found)
                rest = rest[~near]
    return links


def block_links(prints: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp``, each verified."""

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key, held = None, []

        def flush():
            links = _forest(np.concatenate(held), max_bits) if held else []
            return pd.DataFrame(links, columns=["u", "v"], dtype=np.int64)

        for pdf in batches:
            combo, masked, fp = (pdf[c].to_numpy() for c in ("combo", "masked", "fp"))
            new = np.flatnonzero((combo[1:] != combo[:-1]) | (masked[1:] != masked[:-1])) + 1
            bounds = np.concatenate([[0], new, [len(fp)]])
            sizes = np.diff(bounds)
            for i in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0) | (np.arange(len(sizes)) == len(sizes) - 1)):
                a, b = bounds[i], bounds[i + 1]
                if a == b:
                    continue
                key = (combo[a], masked[a])
                if key != held_key:
                    if sum(map(len, held)) > 1:
                        yield flush()
                    held_key, held = key, []
                held.append(fp[a:b])
        if sum(map(len, held)) > 1:
            yield flush()

    masks = _masks(blocks, blocks - max_bits)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(m)).alias("masked"))
        for i, m in enumerate(masks)])).alias("k")).select("k.combo", "k.masked", "fp")
    dealt = keyed.repartition("combo", "masked").sortWithinPartitions("combo", "masked", "fp")
    return dealt.mapInPandas(link, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = 3, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable over links), ``group_key`` (one
    value per component) and ``text_key`` (a hash that tells rows apart that
    share an id)."""

    @F.pandas_udf("long")
    def fingerprint(text: pd.Series) -> pd.Series:
        return pd.Series([simhash(t or b"", size) for t in text], dtype=np.int64)

    ship_code(docs.sparkSession)
    slim = shared_table(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"),
        fingerprint(F.col(text_col).cast("binary")).alias("fp")))
    prints = slim.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = connected_components(block_links(prints.select("fp"), max_bits, blocks))
    placed = shared_table(
        prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("group_key")))
    firsts = placed.groupBy("group_key").agg(F.min("first_id").alias("component_id"))
    found = placed.join(firsts, "group_key").select("fp", "group_key", "component_id")
    return slim.join(found, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", "group_key", "text_key")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the
    smallest id (nulls last, then the smallest text hash), once."""
    found = near_duplicates(docs, id_col, text_col, **how)
    stays = found.groupBy("group_key").agg(
        F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "text_key")).alias("s")
    ).select(F.col("s.id").alias("__id"), F.col("s.text_key").alias("__key"))
    tagged = docs.withColumn("__text_key", F.xxhash64(F.col(text_col)))
    return (tagged.join(stays, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left_semi")
            .dropDuplicates([id_col, "__text_key"]).drop("__text_key"))
