"""Profiling queries over the derived tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from affinity.functions.expr import round_doubles
from affinity.operators import minhash, profile, splits
from affinity.plans import recsys
from affinity.session import ensure_checkpoint_dir, reliable_checkpoint, track_table
from affinity.sources import fixtures, io


def ratings_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_profile(fixtures.ratings(spark, sf_dir), ["user_id", "item_id"])


def null_counts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(fixtures.labelled_documents(spark, sf_dir))


def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(fixtures.ratings(spark, sf_dir), "rating")


def part_name_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.exploded_counts(fixtures.table(spark, sf_dir, "part"), "p_name", " ")


def rating_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(profile.describe(fixtures.ratings(spark, sf_dir), ["rating"], exact=True))


def doc_set_size_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = minhash.set_sizes(fixtures.doc_words(spark, sf_dir), "doc_id", distinct_input=True)
    return round_doubles(profile.describe(sizes, ["n_items"]))


def ratings_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sample_rows(fixtures.ratings(spark, sf_dir), 20, ["user_id", "item_id"])


def ratings_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, types and present values."""
    return profile.column_types(fixtures.ratings(spark, sf_dir))


def sparse_filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reliable_checkpoint(fixtures.ratings(spark, sf_dir))  # derived once, read several times
    f = splits.filter_sparse(r, min_user=recsys.MIN_USER_RATINGS, min_item=recsys.MIN_ITEM_RATINGS)
    return splits.filter_report(r, f)


def _folder(spark: SparkSession) -> str:
    """A fresh folder under the session's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/roundtrip-{uuid.uuid4().hex}"


def ratings_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + S4 + S5: the ratings written as CSV, converted once to
    Parquet by ``load_or_convert`` (Parquet absent -> CSV read with a fixed
    schema, columns kept, nulls dropped), and read back."""
    base = _folder(spark)
    schema = T.StructType([T.StructField("user_id", T.IntegerType()),
                           T.StructField("item_id", T.IntegerType()),
                           T.StructField("rating", T.DoubleType()),
                           T.StructField("ts", T.TimestampNTZType())])
    io.write_csv(fixtures.ratings(spark, sf_dir), f"{base}/csv")
    return track_table(io.load_or_convert(spark, f"{base}/parquet", f"{base}/csv", schema,
                                          columns=("user_id", "item_id", "rating")), base)


def texts_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S5 on free text: quotes, commas, line breaks, empty strings, nulls."""
    path = _folder(spark)
    texts = fixtures.texts_of_parts(spark, sf_dir)
    io.write_csv(texts, path)
    return track_table(io.read_csv(spark, path, texts.schema), path)
