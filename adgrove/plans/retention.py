"""Next-day retention summary of bulk-goods ads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adgrove.functions import dates
from adgrove.functions import metrics as m
from adgrove.functions import predicates as p
from adgrove.functions.arith import flag, ratio, total
from adgrove.operators.ad_totals import ad_totals, volume_first

DEEP_ACTIONS = (104, 105)
RETAIN_ACTION = 106


def retention_ads(
    fact: DataFrame, accounts: DataFrame, first_cohort: int | None = None, last_cohort: int | None = None
) -> DataFrame:
    """Ad-level retention measures per cohort day, with the next day's accrual included."""
    c = F.col
    accrual = dates.days_between(c("partition_date"), c("process_date"))
    first_day = accrual == 0
    deep = F.when(c("action_type").isin(*DEEP_ACTIONS), c("vt_smart_deep_pcvr")).otherwise(0)
    by_click_or_exposure = F.when(c("bid_type") == 1, c("valid_click_cnt")).otherwise(c("valid_exposure_cnt"))
    automatic = c("auto_acquisition_status") == 1
    sums = {
        "cost_micros": c("real_cost_micros"),
        "cost_v0_micros": F.when(c("auto_acquisition_status") != 1, c("real_cost_micros")).otherwise(0),
        "cost_v1_micros": F.when(automatic, c("real_cost_micros")).otherwise(0),
        "exposure_cnt": c("valid_exposure_cnt"),
        "click_cnt": c("valid_click_cnt"),
        "active_num": c("conv1"),
        "first_day_active_num": F.when(first_day, c("conv1")).otherwise(0),
        "retain_num": c("conv2"),
        "target1": c("target1_click"),
        "target_v2": c("target_cpa_v2"),
        "second_target": c("ocpa_second_target_cpa"),
        "second_base": by_click_or_exposure,
        "traced": F.when(c("action_type") == RETAIN_ACTION, c("trace_cnt")).otherwise(0),
        "pcvr1_micros": c("valid_click_smart_pcvr"),
        "pcvr2_sum": c("vc_ltv_info_smart_pcvr2"),
        "deep_micros": deep,
        "first_day_deep_micros": F.when(first_day, deep).otherwise(0),
    }
    # A cohort accrues on its own day and the next: both sides read those days only.
    last_day = None if last_cohort is None else dates.shift_day(last_cohort, 1)
    cohort = p.between_days("process_date", first_cohort, last_cohort) & p.between_days("partition_date", first_cohort, last_day)
    ads = ad_totals(
        fact, accounts,
        keep=p.on_channel("gdt") & p.uncompensated() & (c("second_goal") == p.RETENTION_GOAL)
        & accrual.between(0, 1) & cohort,
        accounts_keep=p.in_industries(p.BULK_INDUSTRIES) & p.between_days("imp_date", first_cohort, last_day),
        fact_keys=[
            "partition_date", "process_date", "adgroup_id", "advertiser_id", "first_goal", "second_goal",
            "bid_strategy", "auto_acquisition_status",
        ],
        account_keys=["industry", "sub_industry"], sums=sums, maxes=volume_first(), drop_keys=["partition_date"],
    )
    micros = lambda name: c(name).cast("double") / m.MICROS
    delivered = c("click_cnt") + c("exposure_cnt")
    first_bias = m.cpa_bias(c("cost_micros"), c("active_num"), c("target1"), c("click_cnt"))
    # The two sides below are scaled differently; the original evaluates left to right and this keeps it so.
    retained_per_predicted = ratio(c("retain_num"), c("first_day_deep_micros")) / m.MICROS
    target_quotient = (
        ratio(ratio(c("target_v2"), delivered) / 100, c("second_target")) / F.nullif(100.0 * c("second_base"), F.lit(0.0))
    )
    return ads.withColumns(
        {
            "first_cpa_bias": first_bias,
            "cpa1": ratio(c("cost_micros"), m.MICROS * c("active_num")),
            "target_cpa1": ratio(c("target_v2"), delivered) / 100,
            "cpa2": ratio(c("cost_micros"), m.MICROS * c("traced")),
            "valid_tcpa2": ratio(c("second_target"), 100 * c("second_base")),
            "pcvr1_sum": micros("pcvr1_micros"),
            "pdcvr_retain_num": micros("deep_micros"),
            "first_day_pdcvr_retain_num": micros("first_day_deep_micros"),
            "div_pcvr_retain_num": ratio(
                c("active_num") * c("pcvr2_sum").cast("double") * m.MICROS, c("pcvr1_micros")
            ),
            "below_rate_target": m.below(first_bias, c("use_amount_first")),
            "dcvr_reached": flag(retained_per_predicted >= target_quotient),
        }
    )


def retention_summary(
    fact: DataFrame, accounts: DataFrame, first_cohort: int | None = None, last_cohort: int | None = None
) -> DataFrame:
    """Retention totals and cost-weighted shares per cohort day and industry."""
    c = F.col
    v0 = c("cost_v0_micros")
    ads = retention_ads(fact, accounts, first_cohort, last_cohort)
    totals = ads.groupBy("process_date", F.col("industry").alias("advertiser_industry")).agg(
        total(v0).alias("v0"),
        total(c("cost_v1_micros")).alias("v1"),
        *[F.sum(n).alias(n) for n in ("exposure_cnt", "click_cnt", "active_num", "first_day_active_num", "retain_num")],
        total(c("deep_micros")).alias("deep"),
        total(c("first_day_deep_micros")).alias("first_deep"),
        total(c("below_rate_target") * v0).alias("below_v0"),
        total(c("dcvr_reached") * c("below_rate_target") * v0).alias("dcvr_v0"),
    )
    micros = lambda name: c(name).cast("double") / m.MICROS
    return totals.select(
        "process_date", "advertiser_industry",
        ((c("v0") + c("v1")).cast("double") / m.MICROS).alias("total_cost"),
        micros("v0").alias("sum_cost_v0"), micros("v1").alias("sum_cost_v1"),
        "exposure_cnt", "click_cnt", "active_num", "first_day_active_num", "retain_num",
        micros("deep").alias("pdcvr_retain_num"), micros("first_deep").alias("first_day_pdcvr_retain_num"),
        micros("below_v0").alias("below_rate_cost"), ratio(c("below_v0"), c("v0")).alias("below_rate"),
        micros("dcvr_v0").alias("dcvr_reached_cost"), ratio(c("dcvr_v0"), c("v0")).alias("dcvr_reach_rate"),
    )
