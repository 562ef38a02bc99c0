"""Classic cost-weighted rates: flags per ad, then one roll-up for any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adgrove.functions import metrics as m
from adgrove.functions.arith import flag, ratio, total

CLASSIC_METRICS = (
    "ad_num", "achieve_rate", "below_rate", "ec_rate_0", "ec_rate_2", "cost", "GMV", "click_num",
    "conversion_num", "pcvr", "cvr", "pcvr_bias", "pctr", "ctr", "pctr_bias", "gsp_factor", "real_gsp_factor",
)


def with_classic_flags(ads: DataFrame) -> DataFrame:
    """Adds conversions, predicted conversions, pricing factors and the reach / below / empty-spend flags per ad."""
    c, goal = F.col, F.col("second_goal")
    bias = m.by_goal(
        goal,
        m.cpa_bias(c("cost_micros"), c("conv1"), c("target1"), c("click")),
        m.cpa_bias(c("cost_micros"), c("conv2"), c("target2"), c("click")),
    )
    gmv = c("gmv_micros") if "gmv_micros" in ads.columns else m.by_goal(goal, c("gmv1"), c("gmv2"))
    staged = ads.select(
        "*",
        bias.alias("bias"),
        m.by_goal(goal, c("conv1"), c("conv2")).alias("conv"),
        m.by_goal(goal, c("pcvr1"), c("pcvr2")).alias("pcvr_micros"),
        gmv.alias("gmv_units"),
        ratio(c("gsp"), c("gsp_base")).alias("gsp_factor"),
        ratio(c("gsp_exposure"), c("gsp_exposure_cnt")).alias("real_gsp_factor"),
    )
    return staged.withColumns(
        {
            "reach": m.reached(c("bias"), c("use_amount_first")),
            "below": m.below(c("bias"), c("use_amount_first")),
            "empty_0": flag(c("conv") == 0),
            "empty_2": flag(c("conv") <= 2),
        }
    )


def has_valid_target() -> Column:
    """Cost, clicks and a target for the phase the ad is in."""
    c = F.col
    return (
        (c("cost_micros") > 0)
        & (c("click") > 0)
        & (((c("double_phase") == 1) & (c("target2") > 0)) | (c("target1") > 0))
    )


def classic_rollup(ads: DataFrame, keys: Sequence[str], gmv_scale: int, count_spending_only: bool = False) -> DataFrame:
    """Cost-weighted rates and volume ratios per ``keys``.

    ``gmv_scale`` turns GMV units into currency (100 for cents, 1,000,000 for micros). The predicted click
    rate is divided by a million twice, as the published reports do.
    """
    c = F.col
    ad_num = F.sum(F.when(c("cost_micros") > 0, 1).otherwise(0)) if count_spending_only else F.count(F.lit(1))
    totals = ads.groupBy(*keys).agg(
        ad_num.cast("long").alias("ad_num"),
        *[
            m.weighted(c(f), c("cost_micros")).alias(n)
            for f, n in (("reach", "achieve_rate"), ("below", "below_rate"), ("empty_0", "ec_rate_0"), ("empty_2", "ec_rate_2"))
        ],
        total(c("cost_micros")).alias("cost_micros"),
        total(c("gmv_units")).alias("gmv_units"),
        F.sum("click").alias("click_num"),
        F.sum("conv").alias("conversion_num"),
        total(c("pcvr_micros")).alias("pcvr_micros"),
        total(c("pctr")).alias("pctr_micros"),
        F.sum("exposure").alias("exposure"),
        m.weighted_quotient(c("gsp_factor"), c("click")).alias("gsp_factor"),
        m.weighted_quotient(c("real_gsp_factor"), c("click")).alias("real_gsp_factor"),
    )
    pcvr = ratio(c("pcvr_micros").cast("double") / m.MICROS, c("click_num"))
    cvr = ratio(c("conversion_num"), c("click_num"))
    pctr = ratio(c("pctr_micros").cast("double") / m.MICROS / m.MICROS, c("exposure"))
    ctr = ratio(c("click_num"), c("exposure"))
    return totals.select(
        *keys,
        "ad_num", "achieve_rate", "below_rate", "ec_rate_0", "ec_rate_2",
        (c("cost_micros").cast("double") / m.MICROS).alias("cost"),
        (c("gmv_units").cast("double") / gmv_scale).alias("GMV"),
        "click_num", "conversion_num",
        pcvr.alias("pcvr"), cvr.alias("cvr"), (ratio(pcvr, cvr) - 1).alias("pcvr_bias"),
        pctr.alias("pctr"), ctr.alias("ctr"), (ratio(pctr, ctr) - 1).alias("pctr_bias"),
        "gsp_factor", "real_gsp_factor",
    )
