"""Writers. Report tables are idempotent per day; relational tables are optional and configured from outside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adgrove.sources.schemas import CLUSTER_COLUMNS, conform


#: Tasks that write one day, so that a large day is no single task's; a small day gets as many small files at most.
DAY_TASKS = 8


def write_days(df: DataFrame, path: str, column: str = "partition_date", tasks: int = DAY_TASKS) -> None:
    """Replaces exactly the days present in ``df``; rerunning a day leaves one copy of it.

    A day's rows are dealt over ``tasks`` tasks; raise it with the size of a day.
    """
    share = F.pmod(F.xxhash64(*[c for c in df.columns if c != column]), F.lit(tasks)) if len(df.columns) > 1 else F.lit(0)
    (
        df.repartition(F.col(column), share)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    )


def append_report(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Report rows in table order, appended."""
    conform(df, schema).write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, schema: T.StructType, properties: dict[str, str]) -> None:
    """Report rows appended to a relational table; rates and money become 32-bit floats as its DDL has them.

    URL and credentials come from the caller's configuration.
    """
    rows = conform(df, schema)
    floats = [F.col(f.name).cast("float").alias(f.name) if f.dataType == T.DoubleType() else F.col(f.name) for f in schema]
    rows.select(*floats).write.jdbc(url, table, mode="append", properties=properties)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_day(spark: SparkSession, path: str, day: int, column: str = "partition_date") -> None:
    """Removes one day partition of a table written by :func:`write_days`."""
    _delete(spark, f"{path}/{column}={day}")


def truncate(spark: SparkSession, path: str, column: str | None = None) -> None:
    """Empties a table; ``column`` names its day partition, if it has one.

    A table without partitions keeps its schema in an empty file. One with partitions has no directory left, so it is
    read with its schema given until the next day is written.
    """
    schema = spark.read.parquet(path).schema
    empty = spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (empty.partitionBy(column) if column else empty).parquet(path)


def write_debug(df: DataFrame, path: str, sub_brands: Sequence[str]) -> None:
    """Joined ads of some sub-brands as CSV without header."""
    df.where(F.col("sub_brand").isin(*sub_brands)).write.mode("overwrite").csv(path, header=False)


def _lines(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))


def write_clusters(df: DataFrame, path: str) -> None:
    """Cluster file, one range-sorted part after the other when ``df`` carries ``idx``."""
    ordered = df.repartitionByRange("idx").sortWithinPartitions("idx") if "idx" in df.columns else df
    _lines(ordered, CLUSTER_COLUMNS).write.mode("overwrite").text(path)


def write_short_clusters(df: DataFrame, path: str) -> None:
    """aid, url, cluster_id lines."""
    _lines(df, ("aid", "url", "cluster_id")).write.mode("overwrite").text(path)


def write_embeddings(df: DataFrame, path: str) -> None:
    """aid, url, comma-joined vector lines."""
    text = F.concat_ws(",", F.col("vector").cast("array<string>"))
    _lines(df.withColumn("vector", text), ("aid", "url", "vector")).write.mode("overwrite").text(path)


def write_word_values(df: DataFrame, path: str) -> None:
    _lines(df, ("word", "value")).write.mode("overwrite").text(path)
