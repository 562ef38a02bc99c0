"""History reports from a stored state of ad totals, so that no run reads a delivery record twice.

The state holds, for each accrual day, cohort day, account, ad and goal, the integer sums and maxima that the history
reports need. They merge by sum and maximum, so a cohort's totals up to any day are the merge of its days' shares.
A share is replaced as a whole when its accrual day is delivered again or late; a run adds one day's share and merges
the three shares that a retrospective report spans. The account snapshot is met after merging, so a corrected
snapshot needs no new share.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.functions import dates
from adgrove.functions import predicates as p
from adgrove.plans import history
from adgrove.sources import writers

KEYS = ("partition_date", "process_date", "advertiser_id", "adgroup_id", "second_goal")


class State(NamedTuple):
    """Folder of the shares of one fact generation and channel."""

    path: str
    generation: int = 1
    channel: str = "gdt"

    def read(self, spark: SparkSession) -> DataFrame:
        """All shares; an empty table before the first update."""
        schema = self._schema()
        return spark.read.schema(schema).parquet(self.path) if _files(spark, self.path) else spark.createDataFrame([], schema)

    def _schema(self) -> str:
        _, sums, maxes, _ = history.generation_terms(self.generation, self.channel)
        return ", ".join(f"{n} bigint" for n in (*KEYS, *sums, *maxes))


def shares(fact: DataFrame, state: State, first_day: int | None, last_day: int | None) -> DataFrame:
    """Partial totals of the accrual days of a range, for records that can enter a history report."""
    keep, sums, maxes, _ = history.generation_terms(state.generation, state.channel)
    rows = fact.where(keep & p.between_days("partition_date", first_day, last_day))
    found = rows.groupBy(*KEYS).agg(*[F.sum(c).alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in maxes.items()])
    return found.select(*[F.col(n).cast("bigint").alias(n) for n in found.columns])


def _files(spark: SparkSession, path: str) -> set[str]:
    """Names in a folder; none if it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in system.listStatus(folder)} if system.exists(folder) else set()


def _days(spark: SparkSession, path: str) -> list[int]:
    """Accrual days that have a share, from the folder's directories."""
    names = [n.partition("=")[2] for n in _files(spark, path) if n.startswith("partition_date=")]
    return sorted(int(n) for n in names if n.isdigit())


def update(state: State, fact: DataFrame, first_day: int, last_day: int, tasks: int = writers.DAY_TASKS) -> None:
    """Replaces the shares of every accrual day from ``first_day`` to ``last_day`` by what ``fact`` has for them.

    One call serves a daily run, a late or repeated day and a backfill. A day of the range without records loses its
    share. Shares of other days are not read. If a run fails between its steps, running it again puts things right.
    """
    spark = fact.sparkSession
    known = [d for d in _days(spark, state.path) if first_day <= d <= last_day]
    before = {d: _files(spark, f"{state.path}/partition_date={d}") for d in known}
    writers.write_days(shares(fact, state, first_day, last_day), state.path, "partition_date", tasks)
    for day, files in before.items():
        # The write left this day's old files alone, so it has no records any more.
        if _files(spark, f"{state.path}/partition_date={day}") & files:
            writers.drop_day(spark, state.path, day)


def same_day(
    spark: SparkSession, state: State, accounts: DataFrame, first_day: int | None = None, last_day: int | None = None
) -> DataFrame:
    """Same-day history of a range of days from their shares alone."""
    return history.same_day_history(state.read(spark), accounts, state.generation, state.channel, first_day, last_day, merged=True)


def retro(
    spark: SparkSession, state: State, accounts: DataFrame, first_day: int | None = None, last_day: int | None = None
) -> DataFrame:
    """Retrospective history of a range of run days; each run merges the shares of its cohorts' accrual days."""
    return history.retro_history(state.read(spark), accounts, state.generation, state.channel, first_day, last_day, merged=True)


def compact(spark: SparkSession, state: State, before: int) -> int:
    """Drops shares that no run from day ``before`` on can read; the number of dropped days."""
    oldest = dates.shift_day(before, -history.MAX_LAG)
    gone = [d for d in _days(spark, state.path) if d < oldest]
    for day in gone:
        writers.drop_day(spark, state.path, day)
    return len(gone)
