"""The k largest inner products of each user with all items, exactly, without
the product of the two tables.

Items are sorted by the norm of their factors and cut into chunks of a bounded
size, which go to the tasks as broadcasts of at most ``chunk_bytes``. A task
takes its users in groups; a group meets the chunks from the largest norm down,
one in memory at a time, and carries the best k so far; as
|score| <= norm(user) * norm(item), a user is done as soon as norm(user) times
the largest norm still ahead is below the k-th score. Within a chunk the same
bound ends the walk block by block. Users are read once, and nothing is written
between the chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.skew import dense_numbers
from affinity.session import reliable_checkpoint, ship_code

CHUNK_BYTES = 32 << 20
BLOCK = 1024  # items that are compared at once
USERS = 512  # users that are compared at once
GROUP_BYTES = 64 << 20  # of users that meet the chunks together; each group of a task reads the chunks anew
SLACK = 1 + 1e-6  # the bound in floating point
BEST = "user bigint, items array<bigint>, scores array<float>, blocks int"


def _matrix(column: pa.Array, rank: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, rank)


def best_of_chunk(users: np.ndarray, items: np.ndarray, scores: np.ndarray, ids: np.ndarray, factors: np.ndarray,
                  ahead: float, ready: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge a chunk of items (sorted by falling norm) into each user's best
    k (items and scores, -inf where there are fewer): (items, scores, blocks
    looked at, done). ``ahead`` is the largest norm behind the chunk, -1 if none;
    ``ready`` are the items' norms and factors in 32 bits, if known. Scores are compared as 32-bit numbers, ties go to the smaller item.

    A block is multiplied in 32 bits first, and only items that may reach a
    user's k-th score, rounding allowed for, are multiplied in 64 bits and sorted.
    """
    k = items.shape[1]
    size = np.sqrt((users ** 2).sum(axis=1)) * SLACK
    norms, low = ready or (np.sqrt((factors ** 2).sum(axis=1)), factors.astype(np.float32))
    near = users.astype(np.float32)
    # what a product of 32-bit factors may be off by, relative to the norms
    off = 4 * (users.shape[1] + 2) * float(np.finfo(np.float32).eps)
    looked = np.zeros(len(users), dtype=np.int32)
    live = np.arange(len(users))
    for start in range(0, len(ids), BLOCK):
        live = live[size[live] * norms[start] >= scores[live, -1]]
        if not len(live):
            break
        looked[live] += 1
        part, names = factors[start:start + BLOCK], ids[start:start + BLOCK]
        rough = near[live] @ low[start:start + BLOCK].T
        slack = (off * norms[start] * size[live]).astype(np.float32)
        least = scores[live, -1] - slack
        if part.shape[0] > k and (full := np.isneginf(least)).any():  # at least k of the block are as good as its k-th
            least[full] = np.partition(rough[full], len(names) - k, axis=1)[:, len(names) - k] - 2 * slack[full]
        hits = np.flatnonzero(rough >= least[:, None])
        if not len(hits):
            continue
        row, col = np.divmod(hits, len(names))
        new = np.einsum("ij,ij->i", users[live[row]], part[col]).astype(np.float32)
        keep = new >= scores[live[row], -1]
        row, col, new = row[keep], col[keep], new[keep]
        _merge_few(items, scores, live[row], names[col], new)
    done = np.ones(len(users), dtype=bool) if ahead < 0 else size * ahead < scores[:, -1]
    return items, scores, looked, done


def _merge_few(items: np.ndarray, scores: np.ndarray, row: np.ndarray, names: np.ndarray, new: np.ndarray) -> None:
    """Put the entries (row, item, score), sorted by row, into the best k of their rows."""
    if not len(row):
        return
    rows, first, n = np.unique(row, return_index=True, return_counts=True)
    k, at = items.shape[1], np.repeat(np.arange(len(rows)), n)
    place = k + np.arange(len(row)) - np.repeat(first, n)
    for some in np.split(np.argsort(n, kind="stable"), np.flatnonzero(np.diff(np.sort(n) > k)) + 1):  # few entries, many
        mine = np.zeros(len(rows), dtype=bool)
        mine[some] = True
        here, to = mine[at], np.cumsum(mine) - 1
        width = k + int(n[some].max())
        s = np.full((len(some), width), -np.inf, dtype=np.float32)
        i = np.full((len(some), width), -1, dtype=np.int64)
        s[:, :k], i[:, :k] = scores[rows[mine]], items[rows[mine]]
        s[to[at[here]], place[here]], i[to[at[here]], place[here]] = new[here], names[here]
        order = np.lexsort((i, -s), axis=-1)[:, :k]
        scores[rows[mine]] = np.take_along_axis(s, order, axis=1)
        items[rows[mine]] = np.take_along_axis(i, order, axis=1)


def _pack(items: DataFrame, rank: int, per_chunk: int) -> DataFrame:
    """(chunk, place, ids, factors): the rows of a batch that are in one chunk as
    two binaries, so a chunk comes to the driver in few rows. ``items`` holds
    (place, id, features), in order within a partition if there are several chunks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, ids = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            factors = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, rank)
            chunk = place // per_chunk
            first = np.flatnonzero(np.diff(chunk, prepend=-1))
            last = [*first[1:], len(chunk)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[first], pa.int32()), pa.array(place[first], pa.int64()),
                 pa.array([ids[i:j].tobytes() for i, j in zip(first, last)], pa.binary()),
                 pa.array([factors[i:j].tobytes() for i, j in zip(first, last)], pa.binary())], names=["chunk", "place", "ids", "factors"])

    return items.select("place", "id", "features").mapInArrow(pack, "chunk int, place bigint, ids binary, factors binary")


def _unpack(rows: list, rank: int) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted(rows, key=lambda r: r.place)
    ids = np.frombuffer(b"".join(r.ids for r in rows), dtype=np.int64)
    return ids, np.frombuffer(b"".join(r.factors for r in rows), dtype=np.float32).reshape(-1, rank)


def _norms(factors: np.ndarray) -> np.ndarray:
    return np.sqrt((factors.astype(np.float64) ** 2).sum(axis=1))


def best_products(users: DataFrame, items: DataFrame, k: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Both frames hold (id, features array<float>); one row per user: (user,
    items, scores, blocks), best first, with the number of blocks looked at."""
    spark = users.sparkSession
    ship_code(spark)
    named = items.select(F.col("id").cast("long").alias("id"), "features")
    size = named.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("rank")).first()
    start = users.select(F.col("id").cast("long").alias("user"), "features")
    if not size.n:
        return start.select("user", F.array().cast("array<bigint>").alias("items"), F.array().cast("array<float>").alias("scores"),
                            F.lit(0).alias("blocks"))
    rank, sc = size["rank"], spark.sparkContext
    per_chunk = max(1, chunk_bytes // (8 * rank + 16))
    if size.n <= per_chunk:
        ids, factors = _unpack(_pack(named.withColumn("place", F.lit(0)), rank, per_chunk).collect(), rank)  # one chunk
        order = np.lexsort((ids, -_norms(factors)))
        chunks, tops = [sc.broadcast((ids[order], factors[order]))], []
    else:
        norm = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
        packed = _pack(dense_numbers(named.withColumn("norm", norm), [F.col("norm").desc(), "id"], "place"), rank, per_chunk)
        packed = reliable_checkpoint(packed)
        chunks, tops = [], []
        for c in range(-(-size.n // per_chunk)):
            ids, factors = _unpack(packed.filter(F.col("chunk") == c).collect(), rank)  # one chunk
            chunks.append(sc.broadcast((ids, factors)))
            tops.append(float(_norms(factors[:1])[0]))
    ahead = [*tops[1:], -1.0]  # the largest norm behind each chunk
    group = max(USERS, GROUP_BYTES // (12 * k + 16 * rank))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(names: np.ndarray, users: np.ndarray) -> Iterator[pa.RecordBatch]:
            items = np.full((len(users), k), -1, dtype=np.int64)
            scores = np.full((len(users), k), -np.inf, dtype=np.float32)
            blocks, live = np.zeros(len(users), dtype=np.int32), np.arange(len(users))
            for chunk, norm in zip(chunks, ahead):
                ids, low = chunk.value
                if len(chunks) > 1:
                    chunk.__dict__.pop("_value", None)  # a worker holds one chunk; the next group reads it anew
                factors, ready, left = low.astype(np.float64), (_norms(low), low), []
                for at in np.split(live, range(USERS, len(live), USERS)):
                    items[at], scores[at], looked, done = best_of_chunk(users[at], items[at], scores[at], ids, factors, norm, ready)
                    blocks[at] += looked
                    left.append(at[~done])
                live = np.concatenate(left)
                if not len(live):
                    break
            n = np.isfinite(scores).sum(axis=1)
            for at in range(0, len(users), USERS):
                some = range(at, min(at + USERS, len(users)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[some]), pa.array([items[i, :n[i]] for i in some], pa.list_(pa.int64())),
                     pa.array([scores[i, :n[i]] for i in some], pa.list_(pa.float32())), pa.array(blocks[some])],
                    names=["user", "items", "scores", "blocks"])

        held, rows = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, USERS):
                batch = whole.slice(at, USERS)
                held.append((batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), rank)))
                rows += batch.num_rows
                if rows >= group:
                    yield from lists(*map(np.concatenate, zip(*held)))
                    held, rows = [], 0
        if rows:
            yield from lists(*map(np.concatenate, zip(*held)))

    return start.mapInArrow(best, BEST)
