"""Reports over stored tables: bucketed by account, and merged from the shares of accrual days."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.operators.scratch import Scratch, wide_tasks
from adgrove.plans import accrual, history
from adgrove.sources import bucketed
from workload import report_sql as s
from workload.report_queries import rounded
from workload.views import FOLDED, accounts, ad_fact, ad_sources, table

#: Fewest buckets, and stored bytes of delivery records for each.
BUCKETS, BUCKET_BYTES = 8, 16 << 20


def _buckets(spark: SparkSession, d: str) -> int:
    """Buckets grow with the records, so that none does."""
    return max(BUCKETS, wide_tasks(table(spark, d, "lineitem"), BUCKET_BYTES) or 0)


def _stored(spark: SparkSession, d: str):
    """Same-day reach from day tables, one day written anew."""
    (fact, columns), snapshot = ad_sources(spark, d, FOLDED), accounts(spark, d, FOLDED)
    tables = bucketed.create_day_tables(fact, snapshot, Scratch(spark).folder, _buckets(spark, d), columns=columns)
    bucketed.replace_day(tables, fact, snapshot, AGAIN, columns=columns)
    return rounded(history.same_day_history(*tables.read(spark)))


def _stored_cohorts(spark: SparkSession, d: str):
    """Retrospective reach from tables bucketed by cohort day and account."""
    (fact, columns), snapshot = ad_sources(spark, d, FOLDED), accounts(spark, d, FOLDED, "process_date")
    tables = bucketed.create_day_tables(fact, snapshot, Scratch(spark).folder, _buckets(spark, d), "process_date", columns=columns)
    return rounded(history.retro_history(*tables.read(spark)))


#: Days of the first update, of a second one that overlaps it, and the day that comes a third time.
FIRST, SECOND, AGAIN = (20210801, 20210815), (20210811, 20210831), 20210813


def _state(spark: SparkSession, d: str) -> accrual.State:
    """Shares of three updates; the first one sees each record of its last days twice."""
    state, fact = accrual.State(f"{Scratch(spark).folder}/state"), ad_fact(spark, d, FOLDED)
    # Repeated where they lie: a union would join the fact twice and deal its rows out again.
    times = F.when(F.col("partition_date") >= SECOND[0], F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    early = fact.withColumn("_again", F.explode(times)).drop("_again")
    accrual.update(state, early, *FIRST)
    accrual.update(state, fact, *SECOND)
    accrual.update(state, fact, AGAIN, AGAIN)
    return state


def _retro_state(spark, d):
    return rounded(accrual.retro(spark, _state(spark, d), accounts(spark, d, FOLDED, "process_date")))


def _same_day_state(spark, d):
    return rounded(accrual.same_day(spark, _state(spark, d), accounts(spark, d, FOLDED)))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "stored_same_day": (_stored, s.same_day(1, "gdt", FOLDED)),
    "stored_retro": (_stored_cohorts, s.retro(1, "gdt", FOLDED)),
    "state_retro": (_retro_state, s.retro(1, "gdt", FOLDED)),
    "state_same_day": (_same_day_state, s.same_day(1, "gdt", FOLDED)),
}
