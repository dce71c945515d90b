"""Recommenders: popularity baseline and ALS, with grid search."""

from __future__ import annotations

import gc
import hashlib
import itertools
import json
import threading
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from affinity.operators.metrics import ranking_metrics, ranking_metrics_lists, relevant_sets
from affinity.operators.products import best_products
from affinity.session import ensure_checkpoint_dir, reliable_checkpoint, ship_code
from affinity.sources.commits import Conflict, Folder


RATINGS_PER_BLOCK = 32_000_000  # 256 MB in a block of a fit
GRID_SHARE = 4  # fits that fill the cluster together when a grid is searched
GRID_FITS = 6  # fits that are run at once, as a fit often waits for its last task or for the driver


def popular_items(train: DataFrame, k: int = 100, user: str = "user_id",
                  item: str = "item_id") -> DataFrame:
    """The k items with most ratings in ``train`` as (item, popularity, rank).

    Ties in popularity go to the smaller item id, so the list is reproducible.
    The count is a partial aggregate; the top k is a bounded top-k (no full
    sort), and the rank is numbered over those k rows only.
    """
    counts = train.groupBy(item).agg(F.count(user).alias("popularity"))
    top = counts.orderBy(F.col("popularity").desc(), F.col(item).asc()).limit(k)
    w = Window.orderBy(F.col("popularity").desc(), F.col(item).asc())
    return top.withColumn("rank", F.row_number().over(w))


def recommend_popular(users: DataFrame, ranked_items: DataFrame, user: str = "user_id",
                      item: str = "item_id", k: int | None = None) -> DataFrame:
    """R2: the same ranked list for every user, as (user, rank, item) rows.

    The list is gathered into one row inside the plan and that row is
    broadcast, so each user costs one row until the list is unfolded. ``k``
    cuts the list; by default all of it is used. It is meant to be short (a
    top-k list).
    """
    listed = ranked_items if k is None else ranked_items.filter(F.col("rank") <= k)
    row = listed.agg(F.sort_array(F.collect_list(F.struct("rank", item))).alias("_list"))
    return (users.select(user).distinct().crossJoin(F.broadcast(row))  # one row
            .select(user, F.explode("_list").alias("_e")).select(user, "_e.rank", f"_e.{item}"))


def to_implicit(df: DataFrame, user: str = "user_id", item: str = "item_id",
                rating: str = "rating") -> DataFrame:
    """Every interaction becomes 1.0."""
    return df.select(user, item).withColumn(rating, F.lit(1.0))


def als_blocks(train: DataFrame, share: int = 2) -> int:
    """Blocks of a fit on ``train``, which is counted: the ``share``-th part of the
    cluster's parallelism, more if a block would get over ``RATINGS_PER_BLOCK``."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-cores // share), -(-train.count() // RATINGS_PER_BLOCK))


def fit_als(train: DataFrame, rank: int = 10, reg: float = 0.1, implicit: bool = False,
            alpha: float = 1.0, seed: int = 42, max_iter: int = 10, user: str = "user_id",
            item: str = "item_id", rating: str = "rating", nonnegative: bool = True,
            checkpoint_interval: int = 10, blocks: int | None = None):
    """Spark ML ALS, cold-start rows dropped, non-negative factors.

    A fixed seed makes a fit reproducible on one cluster layout. Long runs cut
    their lineage every ``checkpoint_interval`` iterations into the session's
    checkpoint folder. Half an iteration sends a factor to every block that holds
    one of its ratings, so it shuffles about as many copies of all factors as
    there are blocks. Blocks hence default to half of the cluster's parallelism
    (``als_blocks``).
    """
    from pyspark.ml.recommendation import ALS

    ensure_checkpoint_dir(train.sparkSession)  # checkpointInterval needs the folder
    n_blocks = blocks or als_blocks(train)
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, regParam=reg,
              implicitPrefs=implicit, alpha=alpha, coldStartStrategy="drop",
              nonnegative=nonnegative, seed=seed, maxIter=max_iter,
              checkpointInterval=checkpoint_interval, numUserBlocks=n_blocks,
              numItemBlocks=n_blocks)
    return als.fit(train)


def _lists(model, n: int, users: DataFrame | None, user: str, item: str) -> DataFrame:
    factors = model.userFactors
    if users is not None:
        factors = factors.join(users.select(F.col(user).alias("id")).distinct(), "id", "left_semi")
    kinds = {c: f.schema["id"].dataType for c, f in ((user, model.userFactors), (item, model.itemFactors))}
    # few bytes are much work here: a number of its own is not merged into few tasks
    dealt = factors.repartition(2 * factors.sparkSession.sparkContext.defaultParallelism, "id")
    best = best_products(dealt, model.itemFactors, n)
    return best.select(F.col("user").cast(kinds[user]).alias(user),
                       F.col("items").cast(ArrayType(kinds[item])).alias("items"), "scores")


def _rows(lists: DataFrame, user: str, item: str) -> DataFrame:
    return lists.select(user, F.posexplode(F.arrays_zip("items", "scores")).alias("_pos", "_r")).select(
        user, (F.col("_pos") + 1).alias("rank"), F.col("_r.items").alias(item), F.col("_r.scores").alias("score"))


def recommend_als(model, k: int = 100, user: str = "user_id", item: str = "item_id",
                  exclude: DataFrame | None = None, users: DataFrame | None = None, rows: bool = True) -> DataFrame:
    """Top-k items per user as (user, rank, item, score), equal scores in
    the order of the items. Exact, by ``products.best_products``: a user leaves
    off where no further item can enter the list. Without ``rows`` a list is one
    row (user, items, scores), which ``evaluate`` takes as well; not with ``exclude``.

    ``users`` limits scoring to a subset of users. Seen items are kept by
    default; ``exclude`` (user, item) leaves them out: a user with m excluded
    items is scored for k + m items (m rounded up to a power of two, one
    request for each such size), what remains is numbered anew and cut at k, so
    lists are full and without gaps as long as the catalogue lasts.
    """
    if exclude is None:
        lists = _lists(model, k, users, user, item)
        return _rows(lists, user, item) if rows else lists
    if not rows:
        raise ValueError("lists without seen items come as rows")
    seen = exclude.select(user, item).distinct()
    wanted = (users if users is not None else model.userFactors.select(F.col("id").alias(user))).select(user).distinct()
    extra = F.pow(F.lit(2), F.ceil(F.log2(F.col("_m").cast("double")))).cast("int")
    sized = wanted.join(seen.groupBy(user).agg(F.count(F.lit(1)).alias("_m")), user, "left").select(
        user, F.when(F.col("_m").isNull(), 0).otherwise(extra).alias("_extra"))
    sized = reliable_checkpoint(sized)
    out = None
    for (m,) in sized.select("_extra").distinct().orderBy("_extra").collect():  # powers of two
        part = _rows(_lists(model, k + m, sized.filter(F.col("_extra") == m).select(user), user, item), user, item)
        out = part if out is None else out.union(part)
    if out is None:
        return _rows(_lists(model, k, wanted, user, item), user, item)
    left = out.join(seen, [user, item], "left_anti")
    anew = Window.partitionBy(user).orderBy("rank")
    return left.withColumn("rank", F.row_number().over(anew)).filter(F.col("rank") <= k).select(
        user, "rank", item, "score")


def _gram(factors: DataFrame, rank: int) -> np.ndarray:
    """Sum of y y' over all items: rank x rank numbers, summed in each task first."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank, rank))
        for batch in batches:
            y = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, rank)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rank * rank)), pa.array(total.ravel())], names=["at", "x"])

    out = np.zeros(rank * rank)
    for r in factors.select("features").mapInArrow(partial, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        out[r["at"]] = r.x
    return out.reshape(rank, rank)


def fit_residuals(model, train: DataFrame, reg: float, implicit: bool = False, alpha: float = 1.0, user: str = "user_id",
                  item: str = "item_id", rating: str = "rating") -> DataFrame:
    """How far each train user's factors are from optimal: (user, n, residual).

    The last half-step of a fit solves, for every user and given the item
    factors, a least-squares problem over non-negative factors x. At its
    solution every component has x = 0 and a gradient >= 0, or a gradient of
    0: ``residual`` is the largest |min(x_j a_j, gradient_j)|, with a_j the
    curvature, relative to the largest component of the problem's right side.
    It takes one aggregate over the ratings; a model that was not fitted to
    them has residuals of about 1.
    """
    ship_code(train.sparkSession)
    rank = model.rank
    y, x = model.itemFactors.select(F.col("id").alias(item), F.col("features").alias("_y")), model.userFactors.select(
        F.col("id").alias(user), F.col("features").alias("_x"))
    gram = _gram(model.itemFactors, rank) if implicit else np.zeros((rank, rank))
    rows = train.select(user, item, F.col(rating).cast("double").alias("_r")).join(y, item).join(x, user)
    score = F.aggregate(F.zip_with("_x", "_y", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    # per rating: how much y y' counts in the problem's matrix, and y in its right side
    weight = F.lit(float(alpha)) * F.abs("_r") if implicit else F.lit(1.0)
    side = F.when(F.col("_r") > 0, 1.0 + weight).otherwise(0.0) if implicit else F.col("_r")
    counted = F.when(F.col("_r") > 0, 1).otherwise(0) if implicit else F.lit(1)
    rows = rows.select(user, "_x", "_y", (weight * score).alias("_p"), side.alias("_b"), weight.alias("_w"), counted.alias("_n"))
    terms = F.concat(F.transform("_y", lambda v: v * F.col("_p")), F.transform("_y", lambda v: v * F.col("_b")),
                     F.transform("_y", lambda v: v.cast("double") * v * F.col("_w")))
    sums = rows.groupBy(user).agg(F.first("_x").alias("_x"), F.sum("_n").alias("n"),
                                  vector_to_array(Summarizer.sum(array_to_vector(terms))).alias("_s"))

    @F.pandas_udf("double")
    def residual(factors: pd.Series, total: pd.Series, n: pd.Series) -> pd.Series:
        v, s = np.stack(factors).astype(np.float64), np.stack(total)
        size = reg * n.to_numpy(dtype=np.float64)[:, None]
        gradient = s[:, :rank] + v @ gram + size * v - s[:, rank:2 * rank]
        curvature = s[:, 2 * rank:] + np.diag(gram) + size
        off = np.abs(np.minimum(v * curvature, gradient)).max(axis=1)
        return pd.Series(off / np.maximum(np.abs(s[:, rank:2 * rank]).max(axis=1), 1e-300))

    return sums.select(user, "n", residual("_x", "_s", "n").alias("residual"))


def evaluate(recs: DataFrame, truth: DataFrame, k: int = 100, user: str = "user_id",
             item: str = "item_id", digits: int | None = 6) -> DataFrame:
    """P/R/NDCG/MAP at k of per-user lists, as rows or one row each, against any split."""
    if "items" in recs.columns:
        return ranking_metrics_lists(recs, truth, k, user, item, digits=digits)
    return ranking_metrics(recs, relevant_sets(truth, user, item), k, user, item, digits=digits)


class Ledger:
    """The finished points of a grid on shared storage, one small file each
    that is made at once, so a search goes on where its driver was lost."""

    def __init__(self, spark, path: str, train: DataFrame, val: DataFrame, fixed: dict):
        def mark(df: DataFrame) -> list:
            return [str(x) for x in df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()]

        self.folder = Folder(spark, path)
        self.context = {**fixed, "train": mark(train), "val": mark(val)}  # other data or settings: other points

    def name(self, point: tuple) -> str:
        text = json.dumps([point, self.context], sort_keys=True)
        return f"points/{hashlib.sha256(text.encode()).hexdigest()}"

    def read(self, point: tuple) -> dict | None:
        name = self.name(point)
        return json.loads(self.folder.read(name)) if self.folder.exists(name) else None

    def write(self, point: tuple, scores: dict) -> None:
        try:
            self.folder.create_once(self.name(point), json.dumps(scores))
        except Conflict:  # another driver fitted the same point
            pass


def tune(train: DataFrame, val: DataFrame, ranks: Sequence[int], regs: Sequence[float],
         alphas: Iterable[float] | None = None, k: int = 100, implicit: bool = False,
         seed: int = 42, max_iter: int = 10, user: str = "user_id", item: str = "item_id",
         rating: str = "rating", parallel: int = GRID_FITS, ledger: str | None = None):
    """Fit every grid point, score NDCG@k on ``val``, keep the first best
    (strictly greater wins). Returns (best params dict, results DataFrame,
    best model).

    ``parallel`` points are fitted at once, each in a scheduler pool of its own.
    A fit has a quarter of the cores for blocks, whatever ``parallel`` is, as
    its start depends on them; what it shuffled goes when the point is scored.
    With ``ledger`` (a folder on shared storage) finished points are kept
    there; a search that is started again on the same data and settings only
    fits the missing ones, and the best one anew if it was fitted before.
    """
    spark = train.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism  # every point reads these frames; many small partitions cost more than the fits
    train = train.select(user, item, rating).coalesce(tasks).persist()
    val_rel = relevant_sets(val, user, item).coalesce(tasks).persist()
    judged = val_rel.select(user).distinct().coalesce(tasks).persist()  # only users that val asks for are scored
    blocks = als_blocks(train, GRID_SHARE)
    grid = (list(itertools.product(ranks, list(alphas), regs)) if implicit and alphas is not None
            else [(r, None, g) for r in ranks for g in regs])
    kept = Ledger(spark, ledger, train, val.select(user, item), {"implicit": implicit, "seed": seed, "iterations": max_iter, "k": k}) if ledger else None
    best_model: dict = {}
    lock = threading.Lock()

    def fit(point: tuple):
        rank, alpha, reg = point
        return fit_als(train, rank=rank, reg=reg, implicit=implicit, alpha=alpha if alpha is not None else 1.0, seed=seed,
                       max_iter=max_iter, user=user, item=item, rating=rating, blocks=blocks)

    def run(number: int) -> dict:
        point = grid[number]
        if kept and (scores := kept.read(point)):
            return scores
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"grid-{number % parallel}")
        model = fit(point)
        lists = recommend_als(model, k, user, item, users=judged, rows=False)
        scores = ranking_metrics_lists(lists, val_rel, k, user, item, digits=None, distinct=True).first().asDict()
        if kept:
            kept.write(point, scores)
        with lock:  # one model is held: that of the first best point so far
            held = best_model.get("at")
            if held is None or (scores["ndcg_at_k"], -number) > held:
                best_model.update(at=(scores["ndcg_at_k"], -number), model=model)
        del model, lists
        if number % parallel == 0:
            gc.collect()
            spark._jvm.System.gc()  # Spark's cleaner removes shuffle files of what the JVM has collected
        return scores

    try:
        with ThreadPoolExecutor(parallel) as pool:
            found = list(pool.map(inheritable_thread_target(spark)(run), range(len(grid))))
        number = max(range(len(grid)), key=lambda i: (found[i]["ndcg_at_k"], -i))
        best = dict(zip(("rank", "alpha", "reg"), grid[number])) | {"ndcg": found[number]["ndcg_at_k"]}
        model = best_model["model"] if best_model.get("at") == (best["ndcg"], -number) else fit(grid[number])
    finally:
        judged.unpersist()
        val_rel.unpersist()
        train.unpersist()
    rows = [(rank, float(reg), None if alpha is None else float(alpha), int(m["n_users"]),
             *(float(m[c]) for c in ("precision_at_k", "recall_at_k", "ndcg_at_k", "map_at_k")))
            for (rank, alpha, reg), m in zip(grid, found)]
    results = spark.createDataFrame(
        rows, "rank int, reg double, alpha double, n_users bigint, precision_at_k double, "
              "recall_at_k double, ndcg_at_k double, map_at_k double")
    return best, results, model
