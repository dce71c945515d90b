"""Ranking metrics at k (K1-K5), as DataFrame aggregates.

Per user u with predictions P (ranked, first k used) and a distinct relevant
set L, hits at 1-based ranks r, the j-th hit having ordinal j:

* precision@k = hits / k
* recall@k    = hits / |L|
* NDCG@k      = sum_hits 1/ln(r+1) / sum_{i=1..min(|L|,k)} 1/ln(i+1)
* MAP@k       = sum_hits j/r / min(|L|, k)

Each metric is the mean over users present on both sides; users with no hit
count with 0. These agree with Spark's RankingMetrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

METRIC_COLS = ("precision_at_k", "recall_at_k", "ndcg_at_k", "map_at_k")


def ideal_dcg_table(spark: SparkSession, k: int) -> DataFrame:
    """(m, idcg): ideal DCG for m relevant items, m = 1..k. k rows."""
    w = Window.orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    return (spark.range(1, k + 1).select(F.col("id").cast("int").alias("m"))
            .withColumn("idcg", F.sum(1.0 / F.log(F.col("m") + 1.0)).over(w)))


def relevant_sets(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Distinct (user, item) rows: the relevant items of each user."""
    return df.select(user, item).distinct()


def _per_user(hits: DataFrame, users: DataFrame, user: str, k: int,
              spark: SparkSession) -> DataFrame:
    """hits: (user, rank) for ranks <= k; users: (user, n_rel). One row per user."""
    w = Window.partitionBy(user).orderBy("rank")
    per_hit = hits.withColumn("_j", F.row_number().over(w))  # at most k rows per user
    stats = per_hit.groupBy(user).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.sum(1.0 / F.log(F.col("rank") + 1.0)).alias("dcg"),
        F.sum(F.col("_j") / F.col("rank")).alias("ap_sum"))
    idcg = F.broadcast(ideal_dcg_table(spark, k))
    base = (users.withColumn("m", F.least(F.col("n_rel"), F.lit(k)).cast("int"))
            .join(idcg, "m"))
    return _means(base.join(stats, user, "left").fillna(0, subset=["n_hits", "dcg", "ap_sum"]), user, k)


def _means(j: DataFrame, user: str, k: int) -> DataFrame:
    return j.select(
        user, "n_rel", "n_hits",
        (F.col("n_hits") / F.lit(float(k))).alias("precision_at_k"),
        (F.col("n_hits") / F.col("n_rel")).alias("recall_at_k"),
        (F.col("dcg") / F.col("idcg")).alias("ndcg_at_k"),
        (F.col("ap_sum") / F.col("m")).alias("map_at_k"))


def _summarize(per_user: DataFrame, digits: int | None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_users")]
    for c in METRIC_COLS:
        v = F.avg(c)
        aggs.append((F.round(v, digits) if digits is not None else v).alias(c))
    return per_user.agg(*aggs)


def ranking_metrics(recs: DataFrame, relevant: DataFrame, k: int = 100,
                    user: str = "user_id", item: str = "item_id", rank: str = "rank",
                    digits: int | None = 6, per_user: bool = False) -> DataFrame:
    """K1-K4 for per-user lists. recs: (user, rank 1-based, item);
    relevant: (user, item). One row: n_users and the four means."""
    spark = recs.sparkSession
    rel = relevant_sets(relevant, user, item)
    n_rel = rel.groupBy(user).agg(F.count(F.lit(1)).alias("n_rel"))
    top = recs.filter(F.col(rank) <= k).select(user, item, F.col(rank).alias("rank"))
    users = top.select(user).distinct().join(n_rel, user)
    hits = top.join(rel, [user, item]).select(user, "rank")
    pu = _per_user(hits, users, user, k, spark)
    return pu if per_user else _summarize(pu, digits)


def ranking_metrics_lists(lists: DataFrame, relevant: DataFrame, k: int = 100, user: str = "user_id",
                          item: str = "item_id", digits: int | None = 6, per_user: bool = False,
                          distinct: bool = False) -> DataFrame:
    """K1-K4 for lists that are rows (user, items), best first and without repeats.

    The relevant rows of a user meet its list as it is, so a list is computed
    once and shuffled as one row; only the ranks of hits are brought together,
    at most k for a user. ``distinct`` says that the relevant rows are so already.
    """
    rel = relevant.select(user, item) if distinct else relevant_sets(relevant, user, item)
    top = lists.filter(F.size("items") > 0).select(
        user, F.slice("items", 1, k).cast(f"array<{rel.schema[item].dataType.simpleString()}>").alias("_items"))
    met = rel.join(top, user).select(user, F.array_position("_items", F.col(item)).alias("_rank"))
    found = met.groupBy(user).agg(F.count(F.lit(1)).alias("n_rel"),
                                  F.sort_array(F.collect_list(F.when(F.col("_rank") > 0, F.col("_rank")))).alias("_hits"))
    total = lambda terms: F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    scored = found.select(
        user, "n_rel", F.least(F.col("n_rel"), F.lit(k)).cast("int").alias("m"), F.size("_hits").cast("bigint").alias("n_hits"),
        total(F.transform("_hits", lambda r: 1.0 / F.log(r + 1.0))).alias("dcg"),
        total(F.transform("_hits", lambda r, i: (i + 1) / r)).alias("ap_sum"))
    pu = _means(scored.join(F.broadcast(ideal_dcg_table(lists.sparkSession, k)), "m"), user, k)
    return pu if per_user else _summarize(pu, digits)


def ranking_metrics_shared(ranked_items: DataFrame, relevant: DataFrame, k: int = 100,
                           user: str = "user_id", item: str = "item_id", rank: str = "rank",
                           digits: int | None = 6, per_user: bool = False) -> DataFrame:
    """K1-K4 when every user gets the same list (popularity baseline).

    ranked_items: (item, rank), at most k rows, broadcast. The user x list
    product is never built: each relevant row looks up its item's rank.
    """
    spark = ranked_items.sparkSession
    rel = relevant_sets(relevant, user, item)
    n_rel = rel.groupBy(user).agg(F.count(F.lit(1)).alias("n_rel"))
    lst = F.broadcast(ranked_items.filter(F.col(rank) <= k)
                      .select(item, F.col(rank).alias("rank")))
    hits = rel.join(lst, item).select(user, "rank")
    pu = _per_user(hits, n_rel, user, k, spark)
    return pu if per_user else _summarize(pu, digits)


def sample_lists(recs: DataFrame, relevant: DataFrame, n: int = 5, user: str = "user_id",
                 item: str = "item_id", rank: str = "rank") -> DataFrame:
    """K5: predicted and actual items of the ``n`` smallest user ids present on
    both sides, as rows (user, source, rank, item): source 'predicted' with
    its rank, or 'actual' with a NULL rank. Rows, not arrays, so a user with a
    huge relevant set is never gathered into one row."""
    both = recs.select(user).distinct().join(relevant.select(user).distinct(), user)
    chosen = F.broadcast(both.orderBy(user).limit(n))
    pred = recs.join(chosen, user).select(user, F.lit("predicted").alias("source"),
                                          F.col(rank).cast("int").alias("rank"), item)
    act = (relevant.select(user, item).distinct().join(chosen, user)
           .select(user, F.lit("actual").alias("source"), F.lit(None).cast("int").alias("rank"),
                   item))
    return pred.unionByName(act)
