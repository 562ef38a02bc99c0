"""Dense numbering in a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adgrove.operators.scratch import Scratch


def number_rows(
    df: DataFrame, order: Sequence[str], name: str, scratch: Scratch, within: Sequence[str] = ()
) -> DataFrame:
    """Adds ``name``: 0, 1, 2, … by ``order`` inside each ``within`` group.

    Rows are range-partitioned by (within, order), so a group with a third of all rows is spread like any
    other; each task numbers its own sorted range. The range sizes (one row per partition, a number the
    session bounds) give the offsets, and a group's first number is subtracted at the end.
    ``order`` must be unique inside a group; NULL is a group like any other. ``df`` should be cheap to read twice (a
    cut table): its ranges are found by sampling it.
    """
    keys = [*within, *order]
    ranged, _ = scratch.cut(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1
    numbered = (
        ranged.withColumn("_local", local)
        .join(offsets, "_range")
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_local", "_offset")
    )
    if not within:
        return numbered.drop("_range")
    # First number of each group, first by range: a group's rows meet it through their range, so none is a hot key.
    parts = numbered.groupBy("_range", *within).agg(F.min(name).alias("_part"))
    first = parts.groupBy(*[F.col(c).alias(f"_of_{c}") for c in within]).agg(F.min("_part").alias("_first"))
    group = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in within]
    starts = parts.join(first, group).select(F.col("_range").alias("_at"), *[f"_of_{c}" for c in within], "_first")
    here = [F.col("_range") == F.col("_at"), *group]
    return (
        numbered.join(starts, here).withColumn(name, F.col(name) - F.col("_first"))
        .drop("_range", "_at", "_first", *[f"_of_{c}" for c in within])
    )
