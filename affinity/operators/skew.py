"""Per-key numbering that stays spread out when one key is very large.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sorts each key inside a
single task; a user with a third of the ratings would make that task do a
third of the job. Here all rows are range-partitioned by (key, order), which
spreads a large key over many tasks, and written once to the shared checkpoint
folder with their place in the partition. The place in the whole table is that
place plus the sizes of the partitions before (one number per partition), and
the position in the key is the distance to the key's first row. One plan for
keys of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.session import reliable_checkpoint

PLACE_BITS = 33  # monotonically_increasing_id: partition above, place below


def number_within(df: DataFrame, key: str, order: Sequence[str | Column],
                  row_col: str = "row_num", size_col: str = "group_size",
                  partitions: int | None = None) -> DataFrame:
    """Add ``row_col`` (1-based position of the row inside its key, by
    ``order``) and ``size_col`` (rows of the key), both bigint.

    ``order`` must be a total order inside each key (add a unique column as
    the last tie-break), otherwise positions of tied rows are arbitrary.
    Null keys are one key.
    """
    by = [F.col(key), *[F.col(c) if isinstance(c, str) else c for c in order]]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = reliable_checkpoint(
        df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", PLACE_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # one row per partition
    ranked = placed.withColumn("_part", part).join(F.broadcast(parts), "_part").withColumn(
        "_at", F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
    keys = ranked.groupBy(F.col(key).alias("_key")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias(size_col))
    return (ranked.join(keys, F.col(key).eqNullSafe(F.col("_key")))
            .withColumn(row_col, F.col("_at") - F.col("_first") + 1)
            .select(*df.columns, row_col, size_col))


def dense_numbers(df: DataFrame, by: str | Sequence[str | Column], number: str = "number") -> DataFrame:
    """The rows of ``df`` numbered from 0 in the order ``by``, which no two rows
    share. Rows are range-partitioned and written with their place; only the
    sizes of the partitions come to the driver, and no window is needed."""
    order = [F.col(c) if isinstance(c, str) else c for c in ([by] if isinstance(by, str) else by)]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = reliable_checkpoint(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", PLACE_BITS).cast("int")
    sizes = dict(placed.groupBy(part.alias("p")).count().collect())  # one row per partition
    starts, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    before = F.get(F.array(*[F.lit(s).cast("long") for s in starts or [0]]), part)
    return placed.select(*df.columns, (before + F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).alias(number))
