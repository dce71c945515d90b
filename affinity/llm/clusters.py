"""Centroid clustering: Lloyd rounds whose nearest centroid is found by
Orchard's search.

Every centroid has a list of the others, sorted by distance. A vector starts
at one centroid and walks down its list; whenever a listed centroid is closer
to the vector, the walk goes on in that centroid's list. A centroid is looked
at once per vector, and the walk ends at the first entry strictly beyond twice
the current distance: by the triangle inequality nothing closer, nor equally
close, can follow. Vectors walk in lock step over Arrow batches.

Components are scaled to integers, so distances, sums and means are exact and
no result depends on the order of the additions. Only the centroids with their
lists (k x (dims + 2 k) numbers) go to the tasks, and only k x dims sums come
back from a round, whatever the number of vectors.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component take no part, nor do those with a scaled component beyond
``largest(dims)`` in size (2^26 for 64 components), whose squared distances
would not fit in 64 bits. A null id hashes as an empty string. Repeated rows
are vectors of their own; rows of one id and hash take part in the start in
order of their components. With fewer vectors than ``k``, each is a centroid.
An empty table gives no rows. Other columns are not returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code

BATCH_CELLS = 1 << 22  # visited marks held at once: rows of a block x centroids


def largest(dims: int) -> int:
    """The largest scaled component whose squared distances can be compared fourfold in 64 bits."""
    return 1 << (math.isqrt((1 << 62) // (16 * dims)).bit_length() - 1)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid the numbers of all, nearest first, and their squared distances."""
    gaps = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
    np.fill_diagonal(gaps, -1)  # the centroid itself stands first, before its equals
    order = np.argsort(gaps, axis=1, kind="stable")
    sorted_gaps = np.take_along_axis(gaps, order, axis=1)
    return order, sorted_gaps


def orchard(points: np.ndarray, centroids: np.ndarray, order: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point (ties: smaller number) and the squared distance."""
    n, k = len(points), len(centroids)
    best = np.zeros(n, dtype=np.int64)
    dist = ((points - centroids[0]) ** 2).sum(axis=1)
    seen = np.zeros((n, k), dtype=bool)
    seen[:, 0] = True
    place = np.ones(n, dtype=np.int64)
    live = np.arange(n) if k > 1 else np.empty(0, dtype=np.int64)
    while len(live):
        at, listed = best[live], place[live]
        inside = gaps[at, listed] <= 4 * dist[live]  # not strictly beyond twice the distance
        live, met = live[inside], order[at, listed][inside]
        place[live] += 1
        fresh = ~seen[live, met]
        rows, met = live[fresh], met[fresh]
        seen[rows, met] = True
        d = ((points[rows] - centroids[met]) ** 2).sum(axis=1)
        closer = (d < dist[rows]) | ((d == dist[rows]) & (met < best[rows]))
        rows, met, d = rows[closer], met[closer], d[closer]
        best[rows], dist[rows], place[rows] = met, d, 1
        live = live[place[live] < k]
    return best, dist


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """(batch slice, its vectors, nearest centroid, squared distance) for blocks of a bounded size."""
    order, gaps = neighbour_lists(centroids)
    rows = max(1, BATCH_CELLS // len(centroids))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            points = _matrix(part.column(part.schema.get_field_index("v")), centroids.shape[1])
            yield part, points, *orchard(points, centroids, order, gaps)


def scaled_vectors(rows: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v): the vectors that take part, as floor(scale * x)."""
    bound = largest(dims)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)  # a null becomes NaN
            with np.errstate(invalid="ignore"):
                x = np.floor(scale * x)
                good = (np.abs(x) <= bound).all(axis=1)
            v = x[good].astype(np.int32)
            offsets = pa.array(np.arange(len(v) + 1, dtype=np.int32) * dims)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)),
                                              pa.ListArray.from_arrays(offsets, pa.array(v.ravel()))], names=["id", "v"])

    slim = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.size("v") == dims)
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(emit, f"id {kind}, v array<int>")


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, list[int]]:
    """Per non-empty cluster the sums of its components, then its size."""
    k, dims = centroids.shape

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), dtype=np.int64)
        for _, points, cluster, _ in _blocks(batches, centroids):
            by = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[by], return_index=True)
            total[present, :dims] += np.add.reduceat(points[by], first, axis=0)
            total[present, dims] += np.diff(np.append(first, len(by)))
        some = np.flatnonzero(total[:, dims])
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(some, pa.int32()),
                                          "s": pa.array(list(total[some]), pa.list_(pa.int64()))})

    parts = vectors.select("v").mapInArrow(emit, "cluster int, s array<long>")
    sums = parts.select("cluster", F.posexplode("s").alias("pos", "x")).groupBy("cluster", "pos").agg(F.sum("x").alias("x"))
    out: dict[int, list[int]] = {}
    for r in sums.collect():  # at most k x (dims + 1)
        out.setdefault(r.cluster, [0] * (dims + 1))[r.pos] = r.x
    return out


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``salt`` and the id."""
    text = F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit("")))
    top = vectors.withColumn("h", F.sha2(text.cast("binary"), 256)).orderBy("h", "v").limit(k)
    return [list(r.v) for r in top.collect()]


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            dims: int = 64, scale: int = 256, salt: str = "2:") -> DataFrame:
    """One row per vector that takes part: id, ``cluster``, ``distance``
    (squared), ``cluster_inertia``, ``inertia`` and ``centroid`` (the final one).

    ``rounds`` times every vector goes to its nearest centroid and every
    non-empty centroid becomes the floor of its vectors' mean; then vectors
    are assigned once more.
    """
    spark = rows.sparkSession
    ship_code(spark)
    vectors = shared_table(scaled_vectors(rows, id_col, vector_col, dims, scale))
    kind = vectors.schema["id"].dataType.simpleString()
    columns = "cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    start = first_centroids(vectors, k, salt)
    if not start:
        return spark.createDataFrame([], f"`{id_col}` {kind}, {columns}")
    centroids = np.array(start, dtype=np.int64)
    for _ in range(rounds):
        for c, (*sums, n) in _sums(vectors, centroids).items():
            centroids[c] = [s // n for s in sums]
    final = centroids.copy()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, best, dist in _blocks(batches, final):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best, pa.int32()), pa.array(dist)],
                                             names=["id", "cluster", "distance"])

    assigned = shared_table(vectors.mapInArrow(assign, f"id {kind}, cluster int, distance long"))
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    known = spark.createDataFrame([(c, s, [int(x) for x in final[c]]) for c, s in inertia.items()],
                                  "cluster int, cluster_inertia long, centroid array<long>")
    return assigned.join(F.broadcast(known), "cluster").select(  # at most k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia",
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), "centroid")
