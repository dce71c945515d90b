"""CSV / Parquet scans and sinks.

Schemas are declared, never inferred: inference reads the data twice and gives
the same column different types on different sizes of the same data set.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.sources import commits
from affinity.sources.quoted_csv import read_records

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])
MOVIES_SCHEMA = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])
TAGS_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])
LINKS_SCHEMA = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("imdbId", T.IntegerType()),
    T.StructField("tmdbId", T.IntegerType()),
])


# How text is written and read alike: quotes doubled, line breaks inside quotes
# allowed, a null left empty, the empty string in quotes.
TEXT = {"header": True, "quote": "\"", "escape": "\"", "nullValue": "", "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False}
EMPTY = "\u0001"  # stands for a quoted empty string while a file is parsed
BROKEN = "_broken_line"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, broken: str | None = None) -> DataFrame:
    """CSV with a header row and a fixed schema. A row that does not fit
    the schema keeps the values that do; ``broken`` names a column for its
    source text (null for a good row).

    Large files are read in ranges, also where line breaks stand inside quotes
    (``quoted_csv``); the quotes are read once when this is called, and only
    those lines that have some."""
    wanted = schema.add(broken, T.StringType()) if broken else schema
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in TEXT.items() if k != "header"}
    options |= {"emptyValue": EMPTY, "mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": broken} if broken else {})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields)
    df = read_records(spark, path).select(F.from_csv("record", kinds, options).alias("r")).select("r.*")
    return df.select(*[F.when(F.col(f.name) != EMPTY, F.col(f.name)).when(F.col(f.name) == EMPTY, "").alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in wanted.fields])


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """S3: Parquet scan; selecting columns here lets the scan prune the rest.
    Of a table written by ``write_parquet``, the newest published version; any
    other Parquet path as it is."""
    df = spark.read.parquet(commits.current(spark, path) or path)
    return df.select(*columns) if columns else df


def _loaded(spark: SparkSession, path: str) -> bool:
    """Whether a whole table is there: a published version, a single file, or
    a folder whose writer marked it as finished."""
    folder = commits.Folder(spark, path)
    if commits.versions(folder):
        return True
    return folder.exists("") and (folder.exists("_SUCCESS") or not folder.fs.getFileStatus(folder.path("")).isDirectory())


def load_or_convert(spark: SparkSession, parquet_path: str, csv_path: str,
                    schema: T.StructType = RATINGS_SCHEMA,
                    columns: Sequence[str] | None = ("userId", "movieId")) -> DataFrame:
    """Read Parquet; if it is not there as a whole, convert the CSV once and read that.

    What a killed conversion left does not count; it is converted anew. Of
    concurrent first conversions one is published and all read that one. Only
    a missing table triggers the conversion; any other error propagates.
    The conversion keeps ``columns`` and drops rows with a null in any of them,
    and rows that did not fit the schema; how many of these there were is
    counted on the way and reported as a warning. Both branches return
    ``columns`` of the Parquet on storage, so the result has one schema.
    """
    if _loaded(spark, parquet_path):
        return read_parquet(spark, parquet_path, columns)
    df = read_csv(spark, csv_path, T.StructType(list(schema.fields)), BROKEN)
    seen = Observation("conversion")
    df = df.observe(seen, F.count_if(F.col(BROKEN).isNotNull()).alias("broken")).filter(F.col(BROKEN).isNull())
    rows = df.select(*(columns or schema.names)).dropna()
    commits.publish(spark, parquet_path, lambda folder: rows.write.parquet(folder), first_only=True)
    if seen.get["broken"]:
        warnings.warn(f"{csv_path}: {seen.get['broken']} rows do not fit the schema and were left out", stacklevel=2)
    return read_parquet(spark, parquet_path, columns)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, keep: int = 2) -> None:
    """Parquet sink, overwrite: the table gets a new version, which readers
    see once it is whole. The version before is kept for readers that are under
    way (``keep``), so a frame may also be written over the table it was read from."""

    def write(folder: str) -> None:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(folder)

    commits.publish(df.sparkSession, path, write, keep=keep)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with header, overwrite; ``read_csv`` gives back the same values."""
    df.write.mode("overwrite").options(**TEXT, emptyValue='""').csv(path)
