"""Classic-definition reports: same-day and retrospective history, buckets, medicine, bulk goods, housing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adgrove.functions import buckets as b
from adgrove.functions import dates
from adgrove.functions import predicates as p
from adgrove.operators import ad_totals as t
from adgrove.operators.classic import CLASSIC_METRICS, classic_rollup, has_valid_target, with_classic_flags

SAME_DAY, RETRO = 2, 1
MAX_LAG = 2
HISTORY_COLUMNS = ("partition_date", "process_date", "table_id", "op_industry", *CLASSIC_METRICS)


def generation_terms(generation: int, channel: str) -> tuple[Column, dict, dict, int]:
    """Row filter, sums, maxima and GMV scale of a fact generation; generation 1 serves GDT only."""
    keep = p.on_channel(channel) & p.uncompensated() & p.not_retention()
    if generation == 1:
        if channel != "gdt":
            raise ValueError("generation 1 facts hold the gdt channel only")
        return keep, {**t.delivery_sums(), **t.gmv_by_goal()}, {**t.volume_first(), **t.second_phase()}, 100
    keep = keep & (F.col("first_goal") > 0) & (F.col("first_goal") != 7) & p.regular_delivery()
    return keep, {**t.delivery_sums(), **t.gmv_delivered()}, t.volume_first(), 1_000_000


def _merge_terms(generation: int, channel: str) -> tuple[Column, dict, dict, int]:
    """The same for partial totals, which carry the sums and maxima under their names and passed the filter before."""
    _, sums, maxes, scale = generation_terms(generation, channel)
    return F.lit(True), {n: F.col(n) for n in sums}, {n: F.col(n) for n in maxes}, scale


def _lag() -> Column:
    """Days by which the run comes after the day of ``table_id``'s rows."""
    return F.when(F.col("table_id") == RETRO, p.industry_lag(F.col("industry"))).otherwise(F.lit(0))


def _publish(ads: DataFrame, generation: int, gmv_scale: int, table_id: int | None = None) -> DataFrame:
    """Rows of one table, or of those that the ads name in ``table_id``."""
    if generation == 1:
        ads = ads.where(has_valid_target())
    flagged = with_classic_flags(ads if table_id is None else ads.withColumn("table_id", F.lit(table_id)))
    keys = ["table_id", "run_date", "industry"]
    out = classic_rollup(flagged, keys, gmv_scale, count_spending_only=generation == 2)
    return out.select(
        F.col("run_date").alias("partition_date"),
        dates.add_days(F.col("run_date"), -_lag()).alias("process_date"),
        "table_id",
        p.lookup(F.col("industry"), p.INDUSTRY_CODES).alias("op_industry"),
        *CLASSIC_METRICS,
    )


def same_day_history(
    fact: DataFrame, accounts: DataFrame, generation: int = 1, channel: str = "gdt",
    first_day: int | None = None, last_day: int | None = None, merged: bool = False,
) -> DataFrame:
    """Reach history with accrual day = report day, for one day or any range of days in one job.

    With ``merged`` the fact is partial totals of it (:mod:`adgrove.plans.accrual`).
    """
    keep, sums, maxes, scale = (_merge_terms if merged else generation_terms)(generation, channel)
    ads = t.ad_totals(
        fact, accounts,
        keep=keep & p.between_days("partition_date", first_day, last_day),
        accounts_keep=p.in_industries(p.INDUSTRY_CODES) & p.between_days("imp_date", first_day, last_day),
        fact_keys=["partition_date", "adgroup_id", "second_goal"], account_keys=["industry"],
        sums=sums, maxes=maxes,
    ).withColumnRenamed("partition_date", "run_date")
    return _publish(ads, generation, scale, SAME_DAY)


def retro_history(
    fact: DataFrame, accounts: DataFrame, generation: int = 1, channel: str = "gdt",
    first_day: int | None = None, last_day: int | None = None, merged: bool = False,
) -> DataFrame:
    """Reach history of cohorts that have finished accruing.

    A run on day ``r`` reports the cohort ``r - lag`` (finance 2 days, others 1) with everything accrued up to
    ``r``. Every record belongs to exactly one run day, ``cohort + lag``, so a backfill of many run days is a
    single pass that groups by that day. With ``merged`` the fact is partial totals of it.
    """
    keep, sums, maxes, scale = (_merge_terms if merged else generation_terms)(generation, channel)
    lag = p.industry_lag(F.col("industry"))
    accrual = dates.days_between(F.col("partition_date"), F.col("process_date"))
    window = (accrual >= 0) & (accrual <= MAX_LAG)
    cohort_first = None if first_day is None else dates.shift_day(first_day, -MAX_LAG)
    window = (
        window
        & p.between_days("partition_date", cohort_first, last_day)
        & p.between_days("process_date", cohort_first, last_day)
    )

    def to_runs(df: DataFrame) -> DataFrame:
        run = dates.add_days(F.col("process_date"), lag)
        df = df.where(F.col("accrual_days") <= lag).withColumn("run_date", run)
        return df.where(p.between_days("run_date", first_day, last_day))

    ads = t.ad_totals(
        fact.withColumn("accrual_days", accrual), accounts,
        keep=keep & window,
        accounts_keep=p.in_industries(p.INDUSTRY_CODES) & p.between_days("imp_date", cohort_first, last_day),
        fact_keys=["process_date", "accrual_days", "adgroup_id", "second_goal"], account_keys=["industry"],
        sums=sums, maxes=maxes, day="process_date", reshape=to_runs,
        extra_keys=["run_date"], drop_keys=["process_date", "accrual_days"],
    )
    return _publish(ads, generation, scale, RETRO)


def both_histories(
    fact: DataFrame, accounts: DataFrame, generation: int = 1, channel: str = "gdt",
    first_day: int | None = None, last_day: int | None = None,
) -> DataFrame:
    """The rows of :func:`retro_history` and :func:`same_day_history` from one pass over both inputs.

    A record stands once under its cohort's day and once under its report day. Bucketed day tables hold the key of one of
    the two days and are read for each table on its own.
    """
    if any(k in fact.columns and k in accounts.columns for k in t.STORED_KEYS.values()):
        args = (fact, accounts, generation, channel, first_day, last_day)
        return retro_history(*args).unionByName(same_day_history(*args))
    keep, sums, maxes, scale = generation_terms(generation, channel)
    cohort_first = None if first_day is None else dates.shift_day(first_day, -MAX_LAG)
    accrual = dates.days_between(F.col("partition_date"), F.col("process_date"))
    accrued = (accrual >= 0) & (accrual <= MAX_LAG) & p.between_days("process_date", cohort_first, last_day)
    no_days = F.lit(0).cast("int")

    def use(table_id: int, on_day: str, days: Column) -> Column:
        return F.struct(F.lit(table_id).alias("table_id"), F.col(on_day).alias("history_day"), days.alias("accrual_days"))

    uses = F.array(
        F.when(accrued, use(RETRO, "process_date", accrual)),
        F.when(p.between_days("partition_date", first_day, last_day), use(SAME_DAY, "partition_date", no_days)),
    )
    records = fact.where(keep & p.between_days("partition_date", cohort_first, last_day)).select(
        "*", F.inline(F.filter(uses, lambda u: u.isNotNull()))
    )

    def to_runs(df: DataFrame) -> DataFrame:
        run = F.when(F.col("table_id") == RETRO, dates.add_days(F.col("history_day"), _lag())).otherwise(F.col("history_day"))
        return df.where(F.col("accrual_days") <= _lag()).withColumn("run_date", run).where(p.between_days("run_date", first_day, last_day))

    ads = t.ad_totals(
        records, accounts,
        keep=F.lit(True),
        accounts_keep=p.in_industries(p.INDUSTRY_CODES) & p.between_days("imp_date", cohort_first, last_day),
        fact_keys=["table_id", "history_day", "accrual_days", "adgroup_id", "second_goal"], account_keys=["industry"],
        sums=sums, maxes=maxes, day="history_day", reshape=to_runs,
        extra_keys=["run_date"], drop_keys=["history_day", "accrual_days"],
    )
    return _publish(ads, generation, scale)


def named_history(history: DataFrame, day: int | None = None) -> DataFrame:
    """History rows with industry codes turned back into display names; an unknown code becomes NULL."""
    names = {code: name for name, code in p.INDUSTRY_CODES.items()}
    rows = history if day is None else history.where(F.col("partition_date") == day)
    return rows.withColumn("op_industry", p.lookup(F.col("op_industry"), names))


def multi_trace(
    fact: DataFrame, accounts_same_day: DataFrame, generation: int = 1, channel: str = "gdt",
    first_day: int | None = None, last_day: int | None = None,
) -> DataFrame:
    """Same-day and retrospective rows of a range of days, published under industry names."""
    return named_history(both_histories(fact, accounts_same_day, generation, channel, first_day, last_day))


def sub_industry_buckets(
    fact: DataFrame, accounts: DataFrame, first_day: int | None = None, last_day: int | None = None
) -> DataFrame:
    """Sub-industry x conversion bucket (10 / 2), generation 2 fact, GDT channel.

    GMV is the delivered GMV as it stands; the original text of this report names a column it never produces.
    """
    c = F.col
    ads = t.ad_totals(
        fact, accounts,
        keep=p.on_channel("gdt") & p.uncompensated() & p.not_retention()
        & p.between_days("partition_date", first_day, last_day),
        accounts_keep=p.in_industries(p.BUCKET_INDUSTRIES) & p.between_days("imp_date", first_day, last_day),
        fact_keys=["partition_date", "adgroup_id", "second_goal"], account_keys=["industry", "sub_industry"],
        sums={**t.delivery_sums(), **t.gmv_delivered()}, maxes=t.volume_first(),
    ).where((c("cost_micros") > 0) & (c("click") > 0))
    bucketed = with_classic_flags(ads).withColumn("active_bucket", _active_bucket(10, 2))
    return _named(
        classic_rollup(bucketed, ["partition_date", "industry", "sub_industry", "active_bucket"], 1_000_000)
    )


def _active_bucket(high: int, low: int) -> Column:
    c = F.col
    return b.conversion_bucket(
        c("second_goal"), (c("conv1"), c("conv2")), c("cost_micros").cast("double") / 10000,
        (c("target1"), c("target2")), c("click"), high, low,
    )


def _named(report: DataFrame) -> DataFrame:
    return report.withColumnsRenamed({"industry": "op_industry", "sub_industry": "op_industry2"})


def bucket_publication(buckets: DataFrame, industry: str | None = None, day: int | None = None) -> DataFrame:
    """Published slice of the bucket history: all of it, one industry, one day."""
    out = buckets if industry is None else buckets.where(F.col("op_industry") == industry)
    return out if day is None else out.where(F.col("partition_date") == day)


def medicine_sub_industries(
    fact: DataFrame, accounts: DataFrame, first_day: int | None = None, last_day: int | None = None
) -> DataFrame:
    """Medicine by sub-industry, same day, generation 1 fact."""
    keep, sums, maxes, scale = generation_terms(1, "gdt")
    ads = t.ad_totals(
        fact, accounts,
        keep=keep & p.between_days("partition_date", first_day, last_day),
        accounts_keep=p.in_industries([p.MEDICINE]) & p.between_days("imp_date", first_day, last_day),
        fact_keys=["partition_date", "adgroup_id", "second_goal"], account_keys=["sub_industry"],
        sums=sums, maxes=maxes,
    ).where(has_valid_target())
    return _named(classic_rollup(with_classic_flags(ads), ["partition_date", "sub_industry"], scale))


def bulk_buckets(
    fact: DataFrame, accounts: DataFrame, first_day: int | None = None, last_day: int | None = None
) -> DataFrame:
    """Bulk goods: industry x sub-industry x conversion bucket (30 / 6) x goal x prediction-bias bucket.

    The days of the range are pooled per ad; compensated records stay in, as in the original analysis.
    """
    c = F.col
    ads = t.ad_totals(
        fact, accounts,
        keep=p.on_channel("gdt") & p.between_days("partition_date", first_day, last_day),
        accounts_keep=p.in_industries(p.BULK_INDUSTRIES) & p.between_days("imp_date", first_day, last_day),
        fact_keys=["adgroup_id", "first_goal", "second_goal"], account_keys=["industry", "sub_industry"],
        sums={**t.delivery_sums(), **t.gmv_by_goal()}, maxes=t.volume_first(),
    ).where(c("cost_micros") > 0)
    pred1, pred2 = (c(n).cast("double") / 1_000_000 for n in ("pcvr1", "pcvr2"))
    bias = b.bias_bucket([
        (c("second_goal") == 0, pred1, c("conv1")),
        (c("second_goal") > 0, pred2, c("conv2")),
    ])
    goal = F.when(c("second_goal") == 0, c("first_goal")).otherwise(c("second_goal"))
    bucketed = with_classic_flags(ads).withColumns(
        {"active_bucket": _active_bucket(30, 6), "og": goal, "bias_bucket": bias}
    )
    return _named(
        classic_rollup(bucketed, ["industry", "sub_industry", "active_bucket", "og", "bias_bucket"], 100)
    )


def housing_bias(
    fact: DataFrame, accounts: DataFrame, first_day: int | None = None, last_day: int | None = None,
    industries: Sequence[str] | None = None,
) -> DataFrame:
    """Prediction bias of ads that optimise goal 104 towards next-day retention, by bias bucket.

    All industries by default (the industry filter of the original is commented out); nothing is filtered
    after the ad totals.
    """
    c = F.col
    ads = t.ad_totals(
        fact, accounts,
        keep=p.on_channel("gdt") & (c("first_goal") == 104) & (c("second_goal") == p.RETENTION_GOAL)
        & p.between_days("partition_date", first_day, last_day),
        accounts_keep=(F.lit(True) if industries is None else p.in_industries(industries))
        & p.between_days("imp_date", first_day, last_day),
        fact_keys=["partition_date", "adgroup_id", "second_goal"], account_keys=[],
        sums={**t.delivery_sums(), **t.gmv_by_goal()}, maxes=t.volume_first(),
    )
    bias = b.bias_bucket([(F.lit(True), c("pcvr2").cast("double") / 1_000_000, c("conv2"))])
    return classic_rollup(with_classic_flags(ads).withColumn("bias_bucket", bias), ["bias_bucket"], 100)
