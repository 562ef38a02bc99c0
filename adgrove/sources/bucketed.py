"""Day tables bucketed by account, so that fact and account snapshot meet without a shuffle.

Both tables are partitioned by day and bucketed by one column: account, day and part as text. The join needs that column
alone, so Spark reads bucket k of either table in one task, adds the fact up and joins it where it lies. An account
that holds a large share of a day is stored in several parts: its ads are dealt over them, its snapshot rows
are repeated, and every part is a key of its own, so no bucket is one account's. All records of an ad share a part.

A table's day is replaced as a whole. Bucket counts are fixed when a table is made: choose about 128 MB of a day's fact
for a bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.operators.ad_totals import STORED_KEYS
from adgrove.operators.scratch import Scratch

#: Records of an account and day that are always left together.
PART_ROWS = 100_000
#: An account with more than this share of a day is stored in parts, so at most so many accounts of a day are.
SHARES = 1000


def _key(day: Column, account: Column, part: Column) -> Column:
    """NULL where day or account is, like the keys it stands for."""
    return F.concat(account.cast("string"), F.lit("/"), day.cast("string"), F.lit("/"), part.cast("string"))


def hot_accounts(fact: DataFrame, day: str, part_rows: int = PART_ROWS, shares: int = SHARES) -> DataFrame:
    """(day, account, parts) of accounts stored in parts: at most ``shares`` for each day, whatever the records."""
    each = fact.groupBy(F.col(day).alias("_day"), F.col("advertiser_id").alias("_account")).agg(F.count(F.lit(1)).alias("_rows"))
    days = each.groupBy("_day").agg(F.sum("_rows").alias("_all"))  # one row a day
    limit = F.greatest(F.lit(max(1, part_rows)), F.expr(f"_all div {shares}"))
    rows = each.join(F.broadcast(days), "_day").where(F.col("_rows") > limit)
    return rows.select("_day", "_account", F.ceil(F.col("_rows") / limit).cast("int").alias("_parts"))


class DayTables(NamedTuple):
    """Names of a stored fact and its account snapshot, bucketed for joins on ``day``."""

    fact: str
    accounts: str
    day: str
    buckets: int

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """Inputs of the reports; filters on the day leave out directories of both tables."""
        return spark.table(self.fact), spark.table(self.accounts)


def _with_keys(
    fact: DataFrame, accounts: DataFrame, day: str, part_rows: int, shares: int
) -> tuple[DataFrame, DataFrame]:
    # Found once for both sides; a table that the fact's size doesn't touch.
    hot, _ = Scratch(fact.sparkSession).cut(hot_accounts(fact, day, part_rows, shares))
    parts = F.coalesce("_parts", F.lit(1))
    spread = F.when(parts > 1, F.pmod(F.xxhash64("adgroup_id"), parts)).otherwise(0)

    def met(df: DataFrame, on_day: str, account: str) -> DataFrame:
        on = (F.col(on_day) == F.col("_day")) & (F.col(account) == F.col("_account"))
        # ``SHARES`` rows for each day of the call.
        return df.join(F.broadcast(hot), on, "left")

    drop = ("_day", "_account", "_parts")
    keyed = met(fact, day, "advertiser_id").withColumn("_part", spread.cast("int")).drop(*drop)
    each = met(accounts, "imp_date", "account_id").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return keyed, each.drop(*drop)


def _dealt(
    df: DataFrame, key: str, day: str, account: str, buckets: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """One task, so one file of a day, for each bucket: the tasks deal rows as buckets do.

    The stored key and ``columns`` are made after that, so only what they are made from travels.
    """
    value = _key(F.col(day), F.col(account), F.col("_part"))
    dealt = df.repartition(buckets, value)
    made = dealt if columns is None else dealt.selectExpr(*columns, "_part")
    return made.withColumn(key, value).drop("_part").sortWithinPartitions(key)


def create_day_tables(
    fact: DataFrame, accounts: DataFrame, folder: str, buckets: int, day: str = "partition_date", name: str | None = None,
    part_rows: int = PART_ROWS, shares: int = SHARES, columns: Sequence[str] | None = None,
) -> DayTables:
    """New tables under ``folder`` with all days of ``fact`` and ``accounts``.

    ``columns`` are SQL expressions for the stored fact where ``fact`` holds what they are made from: wide facts are then moved
    narrow. ``fact`` has its day, advertiser_id and adgroup_id in any case.

    ``day`` is the fact's column that meets the snapshot's day: the report day, or the cohort day for retrospective reports.
    A record without a day or account is kept and meets nothing.
    """
    if day not in STORED_KEYS:
        raise ValueError(f"no stored key for {day}")
    name = name or f"day_{uuid.uuid4().hex}"
    tables = DayTables(f"{name}_fact", f"{name}_accounts", day, buckets)
    sides = _with_keys(fact, accounts, day, part_rows, shares)
    for df, table, column, account, made in zip(
        sides, (tables.fact, tables.accounts), (day, "imp_date"), ("advertiser_id", "account_id"), (columns, None)
    ):
        (
            _dealt(df, STORED_KEYS[day], column, account, buckets, made).write.partitionBy(column)
            .bucketBy(buckets, STORED_KEYS[day]).option("compression", "zstd").option("path", f"{folder}/{table}").saveAsTable(table)
        )
    return tables


def replace_day(
    tables: DayTables, fact: DataFrame, accounts: DataFrame, value: int, part_rows: int = PART_ROWS, shares: int = SHARES,
    columns: Sequence[str] | None = None,
) -> None:
    """One day of both tables anew, in two static overwrites; other days stay as they are.

    Both change when an account goes over the limit for parts, so they are replaced together, the snapshot first.
    """
    spark, key = fact.sparkSession, STORED_KEYS[tables.day]
    sides = _with_keys(
        fact.where(F.col(tables.day) == value), accounts.where(F.col("imp_date") == value), tables.day, part_rows, shares
    )
    for df, table, column, account, made in [*zip(
        sides, (tables.fact, tables.accounts), (tables.day, "imp_date"), ("advertiser_id", "account_id"), (columns, None)
    )][::-1]:
        view = f"_{uuid.uuid4().hex}"
        stored = [c for c in spark.table(table).columns if c != column]
        _dealt(df, key, column, account, tables.buckets, made).select(*stored).createOrReplaceTempView(view)
        spark.sql(f"insert overwrite table {table} partition ({column} = {int(value)}) select * from {view}")
        spark.catalog.dropTempView(view)


def drop_day_tables(spark: SparkSession, tables: DayTables) -> None:
    """Names leave the catalog; the files stay in their folder, as with every table of its own path."""
    spark.sql(f"drop table if exists {tables.fact}")
    spark.sql(f"drop table if exists {tables.accounts}")
