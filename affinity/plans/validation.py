"""Pair validation study: do similar users rate alike more than random ones?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators import minhash, pairs
from affinity.session import reliable_checkpoint
from affinity.sources import fixtures

K = 100
N_RANDOM = 1000
N_PICK = 100
DIGITS = 6


def _round(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(c, DIGITS).alias(c) if c in cols else F.col(c) for c in df.columns])


def _similar(spark, sf_dir):
    ev = fixtures.event_items(spark, sf_dir)
    sigs = minhash.signatures(ev, "user_id", "item_id", min_items=minhash.MIN_ITEMS)
    top = minhash.top_pairs(reliable_checkpoint(sigs), K)
    return ev, top


def similar_pair_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 + V2 on the top pairs of the event table."""
    ev, top = _similar(spark, sf_dir)
    c = pairs.pair_correlation(pairs.shared_ratings(top, ev))
    return _round(c, {"rating_correlation"})


def _summary(corrs: DataFrame) -> DataFrame:
    s = pairs.correlation_summary(corrs)
    return _round(s, {"mean", "sd", "least", "most", "mean_overlap"})


def similar_correlation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 + V4."""
    ev, top = _similar(spark, sf_dir)
    return _summary(pairs.valid_pairs(pairs.pair_correlation(pairs.shared_ratings(top, ev))))


def random_pairs_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 on the ratings table."""
    return pairs.random_pairs(fixtures.ratings(spark, sf_dir), N_RANDOM)


def random_pairs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 on the event table: more pairs than users, so several rounds."""
    return pairs.random_pairs(fixtures.event_items(spark, sf_dir), N_RANDOM)


def _random_valid(r: DataFrame) -> DataFrame:
    rp = pairs.random_pairs(r, N_RANDOM)
    v = pairs.valid_pairs(pairs.pair_correlation(pairs.shared_ratings(rp, r)))
    return pairs.pick_pairs(v, N_PICK)


def random_correlation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 -> V2 -> V3 -> 100 picked -> V4 on the ratings table."""
    return _summary(_random_valid(fixtures.ratings(spark, sf_dir)))


def _random_status(spark, sf_dir):
    r = fixtures.ratings(spark, sf_dir)
    rp = reliable_checkpoint(pairs.random_pairs(r, N_RANDOM))
    return r, pairs.pair_status(rp, pairs.shared_ratings(rp, r))


def defined_pairs_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 + V7: random pairs with a correlation, and their overlap."""
    return _round(pairs.defined_pairs(_random_status(spark, sf_dir)[1]), {"rating_correlation"})


def dropped_pairs_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 + V8."""
    return pairs.dropped_pairs(_random_status(spark, sf_dir)[1])


def dropped_overlap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9."""
    return _round(pairs.overlap_summary(dropped_pairs_ratings(spark, sf_dir)), {"mean", "sd"})


def _dropped_shared(spark, sf_dir):
    r, status = _random_status(spark, sf_dir)
    return pairs.shared_ratings(reliable_checkpoint(pairs.dropped_pairs(status)), r)


def zero_variance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V10 on the shared ratings of dropped pairs."""
    return pairs.constant_sides(_dropped_shared(spark, sf_dir))


def rating_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V11 on the shared ratings of dropped pairs."""
    return _round(pairs.rating_gap(_dropped_shared(spark, sf_dir)), {"mean1", "mean2", "gap"})


def similar_vs_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of similar and random pairs of the event table."""
    ev, top = _similar(spark, sf_dir)
    sim = pairs.valid_pairs(pairs.pair_correlation(pairs.shared_ratings(top, ev)))
    return pairs.compare_groups(_summary(sim), _summary(_random_valid(ev)))
