"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import ensure_checkpoint_dir, track_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship_code(spark: SparkSession) -> None:
    """Make the library importable in the Python workers, once per context:
    Spark's own file server hands the zipped sources to every executor."""
    context = spark.sparkContext
    if getattr(context, "_affinity_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    target = Path(tempfile.mkdtemp(prefix="affinity-code-")) / "affinity.zip"
    target.write_bytes(buffer.getvalue())
    context.addPyFile(str(target))
    context._affinity_shipped = True


# A setting of the session: the shuffle files of a finished execution are deleted.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_table(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: the lineage is cut, any executor can read it, and later scans still
    prune columns. What was shuffled to make the table is deleted at once, so
    the steps of a long operator do not add up on local disks; the session keeps
    that setting from the first table on. The table itself goes when no frame
    reads it any more."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    if spark.conf.get(CLEAN_UP, None) != "true":
        spark.conf.set(CLEAN_UP, "true")
    df.write.options(compression="zstd", **options).parquet(path)
    return track_table(spark.read.schema(df.schema).parquet(path), path)


def ascii_lower(word: Column) -> Column:
    """A-Z lower-cased, every other character kept. ``lower`` is Unicode-aware,
    so it only serves strings whose characters are all single bytes."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, LOWER))
