"""The studies on MovieLens-format files (ratings, movies, tags, links CSV).

Each function composes the operators with the MovieLens column names
(userId, movieId, rating, timestamp) and returns DataFrames; nothing is
collected except bounded displays in the command line entry point.

    python -m affinity.plans.movielens eda      --data DIR
    python -m affinity.plans.movielens twins    --data DIR --out OUT
    python -m affinity.plans.movielens split    --data DIR --out OUT
    python -m affinity.plans.movielens evaluate --out OUT [--als] [--implicit]
    python -m affinity.plans.movielens validate --data DIR --out OUT
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators import metrics, minhash, pairs, profile, recommend, splits
from affinity.plans import recsys
from affinity.session import reliable_checkpoint
from affinity.sources import io

USER, ITEM, RATING, TIME = "userId", "movieId", "rating", "timestamp"
TABLES = {"ratings": io.RATINGS_SCHEMA, "movies": io.MOVIES_SCHEMA, "tags": io.TAGS_SCHEMA,
          "links": io.LINKS_SCHEMA}


def load(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four CSV files of a MovieLens directory, with fixed schemas."""
    return {name: io.read_csv(spark, f"{root.rstrip('/')}/{name}.csv", schema)
            for name, schema in TABLES.items()}


def ratings_parquet(spark: SparkSession, root: str, parquet: str) -> DataFrame:
    """Ratings as Parquet, converting the CSV once (all four columns kept)."""
    return io.load_or_convert(spark, parquet, f"{root.rstrip('/')}/ratings.csv",
                              io.RATINGS_SCHEMA, columns=(USER, ITEM, RATING, TIME))


def eda(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Schema, sample rows, count and null counts of each table; rating and genre distributions."""
    out = {}
    for name, df in tables.items():
        out[f"{name}_schema"] = profile.column_types(df)
        out[f"{name}_sample"] = profile.sample_rows(df, 5, df.columns[:2])
        out[f"{name}_count"] = profile.row_count(df)
        out[f"{name}_nulls"] = profile.null_counts(df)
    out["rating_distribution"] = profile.value_counts(tables["ratings"], RATING)
    out["genre_distribution"] = profile.exploded_counts(tables["movies"], "genres", "\\|",
                                                        name="genre")
    return out


def twins(ratings: DataFrame, k: int = 100) -> dict[str, DataFrame]:
    """Top-k similar users with Jaccard, their summary, and signature and
    bucket diagnostics."""
    rows = ratings.select(USER, ITEM)
    sigs = reliable_checkpoint(
        minhash.signatures(rows, USER, ITEM, min_items=minhash.MIN_ITEMS))
    top = minhash.top_pairs(sigs, k, user=USER)
    sized = minhash.jaccard(top, rows, USER, ITEM, sizes=sigs)
    return {
        "top_pairs": sized,
        "signature_counts": minhash.signature_counts(rows, USER, ITEM),
        "jaccard_summary": profile.describe(sized, ["jaccard"], exact=True),
        "set_size_summary": profile.describe(sigs, ["n_items"]),
        "set_size_summary_before": profile.describe(minhash.set_sizes(rows, USER, ITEM), ["n_items"]),
        "signature_clusters": minhash.signature_clusters(sigs, 10, USER),
        "largest_cluster_members": minhash.cluster_members(sigs, rows, 1, USER, ITEM),
        "bucket_stats": minhash.bucket_stats(minhash.bands(sigs, user=USER), USER),
    }


def split(ratings: DataFrame) -> DataFrame:
    """Sparse filter (5 / 5) then the 60/20/20 time split; adds ``split``."""
    return splits.time_split(filtered(ratings), USER, TIME, ITEM, recsys.TRAIN_FRAC, recsys.VAL_FRAC)


def filtered(ratings: DataFrame) -> DataFrame:
    return splits.filter_sparse(ratings, USER, ITEM, recsys.MIN_USER_RATINGS, recsys.MIN_ITEM_RATINGS)


def filter_report(ratings: DataFrame) -> DataFrame:
    """Rows, users and items before and after the sparse filter."""
    return splits.filter_report(ratings, filtered(ratings), USER, ITEM)


def split_checks(split_df: DataFrame) -> dict[str, DataFrame]:
    return {
        "sizes": splits.split_sizes(split_df),
        "overlap": splits.split_overlap(split_df, USER, ITEM),
        "ranges": splits.split_ranges(split_df, TIME),
        "order_violations": splits.split_order_violations(split_df, USER, TIME),
    }


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """Splits written by ``splits.write_splits`` (one folder per split)."""
    return io.read_parquet(spark, path)


def baseline(split_df: DataFrame, on: str = "test", k: int = 100) -> DataFrame:
    train = split_df.filter(F.col("split") == "train")
    top = recommend.popular_items(train, k, USER, ITEM)
    return metrics.ranking_metrics_shared(top, split_df.filter(F.col("split") == on), k, USER,
                                          ITEM)


def list_samples(split_df: DataFrame, on: str = "test", k: int = 100, n: int = 5) -> DataFrame:
    """Predicted (popularity) and actual lists of the first ``n`` users of ``on``."""
    truth = split_df.filter(F.col("split") == on)
    top = recommend.popular_items(split_df.filter(F.col("split") == "train"), k, USER, ITEM)
    return metrics.sample_lists(recommend.recommend_popular(truth, top, USER, ITEM), truth, n, USER, ITEM)


def als_study(split_df: DataFrame, implicit: bool = False, k: int = 100, seed: int = 42, ledger: str | None = None):
    """Grid search on val NDCG@k, best model scored on test: (best, grid, test).
    ``ledger``: the folder in which finished points are kept for a restart."""
    train = split_df.filter(F.col("split") == "train").select(USER, ITEM, RATING)
    val = split_df.filter(F.col("split") == "val")
    test = split_df.filter(F.col("split") == "test")
    if implicit:
        train = recommend.to_implicit(train, USER, ITEM, RATING)
        best, grid, model = recommend.tune(train, val, recsys.IMPLICIT_RANKS, recsys.IMPLICIT_REGS,
                                           recsys.IMPLICIT_ALPHAS, k=k, implicit=True, seed=seed,
                                           user=USER, item=ITEM, rating=RATING, ledger=ledger)
    else:
        best, grid, model = recommend.tune(train, val, recsys.EXPLICIT_RANKS, recsys.EXPLICIT_REGS,
                                           k=k, seed=seed, user=USER, item=ITEM, rating=RATING, ledger=ledger)
    recs = recommend.recommend_als(model, k, USER, ITEM, users=test.select(USER).distinct(), rows=False)
    return best, grid, recommend.evaluate(recs, test, k, USER, ITEM)


def validate(top: DataFrame, ratings: DataFrame, n_random: int = 10000,
             n_pick: int = 100) -> dict[str, DataFrame]:
    """Correlation of similar vs random pairs and the dropped-pair analysis."""
    r = ratings.select(USER, ITEM, RATING)
    shared = pairs.shared_ratings(top, r, USER, ITEM, RATING)
    status = reliable_checkpoint(pairs.pair_status(top, shared))
    rp = reliable_checkpoint(pairs.random_pairs(r, n_random, USER))
    rand_valid = pairs.pick_pairs(
        pairs.valid_pairs(pairs.pair_correlation(pairs.shared_ratings(rp, r, USER, ITEM, RATING))),
        n_pick)
    dropped = pairs.dropped_pairs(status)
    dropped_shared = pairs.shared_ratings(dropped, r, USER, ITEM, RATING)
    return {
        "comparison": pairs.compare_groups(pairs.correlation_summary(pairs.defined_pairs(status)),
                                           pairs.correlation_summary(rand_valid)),
        "dropped_overlap": pairs.overlap_summary(dropped),
        "constant_sides": pairs.constant_sides(dropped_shared),
        "rating_gap": pairs.rating_gap(dropped_shared),
    }


def main(argv=None):
    from affinity import get_spark

    ap = argparse.ArgumentParser(prog="affinity.plans.movielens")
    ap.add_argument("study", choices=["eda", "twins", "split", "evaluate", "validate"])
    ap.add_argument("--data", help="MovieLens directory with ratings.csv etc.")
    ap.add_argument("--out", help="output directory (Parquet / CSV)")
    ap.add_argument("--als", action="store_true")
    ap.add_argument("--implicit", action="store_true")
    ap.add_argument("--show", type=int, default=20, help="rows to display per table")
    a = ap.parse_args(argv)
    owned = SparkSession.getActiveSession() is None  # stop only a session we start
    spark = get_spark(app=f"affinity-{a.study}")

    def show(tables):
        for name, df in tables.items():
            print(f"== {name}")
            df.show(a.show, truncate=False)

    if a.study == "eda":
        show(eda(load(spark, a.data)))
    elif a.study == "twins":
        ratings = ratings_parquet(spark, a.data, f"{a.out}/ratings.parquet")
        t = twins(ratings)
        io.write_parquet(t["top_pairs"], f"{a.out}/top_pairs.parquet")
        io.write_csv(t["top_pairs"].select("user1", "user2", "count", "jaccard"),
                     f"{a.out}/top_pairs_csv")
        show(t)
    elif a.study == "split":
        ratings = ratings_parquet(spark, a.data, f"{a.out}/ratings.parquet")
        splits.write_splits(split(ratings), f"{a.out}/splits")
        show({"filter": filter_report(ratings), **split_checks(read_splits(spark, f"{a.out}/splits"))})
    elif a.study == "evaluate":
        s = read_splits(spark, f"{a.out}/splits")
        if a.als:
            best, grid, test = als_study(s, implicit=a.implicit, ledger=f"{a.out}/grid")
            print("best:", best)
            show({"grid": grid, "test": test})
        else:
            show({"baseline_val": baseline(s, "val"), "baseline_test": baseline(s, "test"),
                  "lists_val": list_samples(s, "val"), "lists_test": list_samples(s, "test")})
    elif a.study == "validate":
        ratings = ratings_parquet(spark, a.data, f"{a.out}/ratings.parquet")
        top = io.read_parquet(spark, f"{a.out}/top_pairs.parquet")
        show(validate(top, ratings))
    if owned:
        spark.stop()


if __name__ == "__main__":
    main()
