"""Similar-user study: signatures, LSH buckets, top pairs and their Jaccard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.expr import round_doubles
from affinity.operators import minhash, profile
from affinity.session import reliable_checkpoint
from affinity.sources import fixtures

K = 100
N_CLUSTERS = 10

# builder, user column, number of an item (None: the item itself), whether rows come user by user
SOURCES = {
    "events": (fixtures.event_items, "user_id", None, False),
    "docs": (fixtures.doc_words, "doc_id", fixtures.WORD_NUMBER, True),
}


def _src(spark: SparkSession, sf_dir: str, name: str):
    build, user = SOURCES[name][:2]
    return build(spark, sf_dir), user


def _sigs(spark: SparkSession, sf_dir: str, name: str):
    df, user = _src(spark, sf_dir, name)
    # Both derived tables are distinct (user, item) rows by construction.
    sigs = minhash.signatures(df, user, "item_id", min_items=minhash.MIN_ITEMS,
                              distinct_input=True, number=SOURCES[name][2], grouped=SOURCES[name][3])
    return df, user, sigs


def item_sets(spark, sf_dir, name):
    df, user = _src(spark, sf_dir, name)
    return minhash.item_sets(df, user, "item_id")


def users_with_min_items(spark, sf_dir, name):
    df, user = _src(spark, sf_dir, name)
    kept = minhash.min_set_size(df, minhash.MIN_ITEMS, user, "item_id")
    return kept.agg(F.count_distinct(user).alias("n_users"), F.count(F.lit(1)).alias("n_rows"))


def signature_digest(spark, sf_dir, name):
    _, user, sigs = _sigs(spark, sf_dir, name)
    return sigs.select(user, "n_items", F.col("sig")[0].alias("h_first"),
                       F.col("sig")[minhash.NUM_HASHES - 1].alias("h_last"),
                       F.aggregate("sig", F.lit(0).cast("bigint"),
                                   lambda acc, x: acc + x).alias("h_sum"))


def signature_counts(spark, sf_dir, name):
    df, user = _src(spark, sf_dir, name)
    return minhash.signature_counts(df, user, "item_id", distinct_input=True, number=SOURCES[name][2],
                                    grouped=SOURCES[name][3])


def signature_clusters(spark, sf_dir, name):
    _, user, sigs = _sigs(spark, sf_dir, name)
    return minhash.signature_clusters(sigs, N_CLUSTERS, user).select(
        "rep", "n_users", F.col("sig")[0].alias("h_first"))


def cluster_members(spark, sf_dir, name):
    df, user, sigs = _sigs(spark, sf_dir, name)
    return minhash.cluster_members(reliable_checkpoint(sigs), df, 1, user, "item_id")


def lsh_buckets(spark, sf_dir, name):
    _, user, sigs = _sigs(spark, sf_dir, name)
    b = minhash.buckets(minhash.bands(sigs, user=user), user)
    return b.select("band_idx", *[F.col("band")[i].alias(f"b{i}") for i in range(minhash.ROWS_PER_BAND)],
                    "n_users", "min_user", "max_user")


def bucket_stats(spark, sf_dir, name):
    _, user, sigs = _sigs(spark, sf_dir, name)
    return round_doubles(minhash.bucket_stats(minhash.bands(sigs, user=user), user))


def candidate_pairs(spark, sf_dir, name):
    """M10 between groups of equal signatures (no group is expanded)."""
    _, user, sigs = _sigs(spark, sf_dir, name)
    return minhash.candidate_groups(reliable_checkpoint(sigs), 1, user=user)


def top_pairs(spark, sf_dir, name):
    _, user, sigs = _sigs(spark, sf_dir, name)
    return minhash.top_pairs(reliable_checkpoint(sigs), K, user=user)


def similar_pairs(spark, sf_dir, name):
    df, user = _src(spark, sf_dir, name)
    # The words are read again for the pairs' documents alone: all of them are not kept.
    return minhash.similar_pairs(df, user, "item_id", k=K, distinct_input=True, persist_input=name == "events",
                                 number=SOURCES[name][2], grouped=SOURCES[name][3])


def jaccard_summary(spark, sf_dir, name):
    return round_doubles(profile.describe(similar_pairs(spark, sf_dir, name), ["jaccard"], exact=True))


def similar_pairs_with_sets(spark, sf_dir, name):
    """The items of both users of each top pair, as rows."""
    df, user = _src(spark, sf_dir, name)
    top = top_pairs(spark, sf_dir, name)
    return minhash.with_sets(top, df, user, "item_id")
