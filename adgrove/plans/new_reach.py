"""New-definition reach reports: ad detail with account bias, and its roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adgrove.functions import buckets as b
from adgrove.functions import metrics as m
from adgrove.functions import predicates as p
from adgrove.functions.arith import flag, ratio, total
from adgrove.operators import ad_totals as t
from adgrove.operators.ad_bitmaps import ad_bitmaps, distinct_ads
from adgrove.operators.scratch import Scratch

COMMON_METRICS = (
    "ad_num", "achieve_rate", "ad_reach_rate", "ac_reach_rate", "cost", "gmv", "click_num", "conversion_num",
    "pcvr", "cvr", "pcvr_bias", "pctr", "ctr", "pctr_bias",
)


def _currency(micros: str) -> Column:
    return F.col(micros).cast("double") / m.MICROS


def _predicted_clicks(generation: int) -> Column:
    """Predicted clicks; the generation 1 report scales them down twice."""
    clicks = _currency("pctr_micros")
    return clicks / m.MICROS if generation == 1 else clicks


def ad_rows_gen1(
    fact: DataFrame, accounts: DataFrame, first_day: int | None = None, last_day: int | None = None
) -> DataFrame:
    """One row per ad and goal pair, generation 1 fact (GDT).

    The grouping keys determine every later key, so the second aggregation of the original is a projection here.
    """
    c = F.col
    click, exposure = c("valid_click_cnt"), c("valid_exposure_cnt")
    goal = m.effective_goal(c("first_goal"), c("second_goal"))
    sums = {
        "cost_micros": c("real_cost_micros"), "click": click, "exposure": exposure, "gmv_cents": c("gmv"),
        "conv1": c("conv1"), "conv2": c("conv2"), "target1": c("target1_click"), "target2": c("target2_click"),
        "conversions": F.when(c("second_goal") > 0, c("conv2")).otherwise(c("conv1")),
        "target_v2": c("target_cpa_v2"), "delivered": exposure + click,
        "second_target": c("ocpa_second_target_cpa"),
        "second_base": F.when(c("bid_type") == 1, click).when(c("bid_type") == 4, exposure).otherwise(0),
        "pcvr1": c("pcvr1"), "pcvr2": c("pcvr2"), "pctr_micros": c("pctr"),
    }
    ads = t.ad_totals(
        fact, accounts,
        keep=p.on_channel("gdt") & p.uncompensated() & (c("first_goal") > 0) & p.not_retention(goal)
        & p.between_days("partition_date", first_day, last_day),
        accounts_keep=p.in_industries(p.INDUSTRY_CODES) & p.between_days("imp_date", first_day, last_day),
        fact_keys=["partition_date", "advertiser_id", "product_id", "adgroup_id", "first_goal", "second_goal"],
        account_keys=["industry", "sub_industry", "sub_brand"],
        sums=sums, maxes={**t.volume_first(), **t.second_phase()},
    )
    ads = ads.withColumns(
        {
            "optimization_goal": goal,
            "target_cpa1": ratio(c("target_v2").cast("double") / 100, c("delivered")),
            "target_cpa2": ratio(c("second_target").cast("double") / 100, c("second_base")),
            "bias": m.by_goal(
                c("second_goal"),
                m.cpa_bias(c("cost_micros"), c("conv1"), c("target1"), c("click")),
                m.cpa_bias(c("cost_micros"), c("conv2"), c("target2"), c("click")),
            ),
        }
    ).where(
        (c("cost_micros") > 0) & (c("click") > 0)
        & (((c("double_phase") == 1) & (c("target_cpa2") > 0)) | (c("target_cpa1") > 0))
    )
    target = m.by_goal_strict(c("second_goal"), c("target_cpa1"), c("target_cpa2"))
    pcvr = F.when(c("second_goal") == 0, c("pcvr1")).when(c("second_goal") > 1, c("pcvr2")).otherwise(F.lit(0))
    return _keyed(ads).select(
        *_ID_COLUMNS, "first_goal", "second_goal", "optimization_goal", "t_advertiser", "cost_micros",
        _currency("cost_micros").alias("costs"), F.lit(1).cast("long").alias("ad_cnt"), "click", "exposure",
        "conversions", target.alias("target_cpa"), (c("conversions") * target).alias("gmvc"),
        pcvr.alias("pcvr_micros"), "pctr_micros",
        m.reached(c("bias"), c("use_amount_first")).alias("reach_rate_target"),
        m.below(c("bias"), c("use_amount_first")).alias("below_rate_target"),
    )


_ID_COLUMNS = ("partition_date", "op_industry", "op_industry2", "advertiser_id", "sub_brand", "product_id", "adgroup_id")


def _keyed(ads: DataFrame) -> DataFrame:
    """Report names for the account columns, rows without an essential key dropped, composite advertiser key."""
    c = F.col
    return (
        ads.withColumnsRenamed({"industry": "op_industry", "sub_industry": "op_industry2"})
        .na.drop(subset=["op_industry", "product_id", "optimization_goal"])
        .withColumn("t_advertiser", F.concat_ws("_", c("advertiser_id"), c("product_id"), c("optimization_goal")))
    )


def ad_rows_gen2(
    fact: DataFrame, accounts: DataFrame, channel: str = "gdt",
    first_day: int | None = None, last_day: int | None = None,
) -> DataFrame:
    """One row per ad, generation 2 fact, either channel.

    Rows of different strategies or first goals merge when their derived keys and both bias values coincide;
    the biases are quotients of integer sums, so equal inputs give equal keys.
    """
    c = F.col
    deep = c("second_goal") > 0

    def chosen(first: str, second: str) -> Column:
        return F.when(deep, c(second)).otherwise(c(first))

    sums = {
        "cost_micros": c("real_cost_micros"), "click": c("valid_click_cnt"), "exposure": c("valid_exposure_cnt"),
        "gmv_micros": c("gmv_exp_d"), "conv1": c("conv1"), "conv2": c("conv2"),
        "target1": c("target1_click"), "target2": c("target2_click"),
        "conversions": chosen("conv1", "conv2"), "target_cents": chosen("target1_click", "target2_click"),
        "pcvr_micros": chosen("pcvr1", "pcvr2"), "pctr_micros": c("pctr"),
    }
    inner = t.ad_totals(
        fact, accounts,
        keep=p.on_channel(channel) & p.uncompensated() & p.not_retention() & ~c("first_goal").isin(0, 7)
        & p.regular_delivery() & p.between_days("partition_date", first_day, last_day),
        accounts_keep=p.in_industries(p.INDUSTRY_CODES) & p.between_days("imp_date", first_day, last_day),
        fact_keys=[
            "partition_date", "advertiser_id", "product_id", "adgroup_id", "bid_strategy", "first_goal", "second_goal",
        ],
        account_keys=["industry", "sub_industry", "sub_brand"], sums=sums, maxes=t.volume_first(),
    )
    derived = inner.select(
        "*",
        flag(deep).alias("use_deep"),
        m.effective_goal(c("first_goal"), c("second_goal")).alias("optimization_goal"),
        m.cpa_bias(c("cost_micros"), c("conv1"), c("target1"), c("click")).alias("bias1"),
        m.cpa_bias(c("cost_micros"), c("conv2"), c("target2"), c("click")).alias("bias2"),
    )
    merged = derived.groupBy(
        "partition_date", "industry", "sub_industry", "sub_brand", "advertiser_id", "product_id", "adgroup_id",
        "use_deep", "second_goal", "optimization_goal", "use_amount_first", "bias1", "bias2",
    ).agg(*[
        F.sum(n).alias(n)
        for n in ("cost_micros", "click", "exposure", "gmv_micros", "conversions", "target_cents", "pcvr_micros", "pctr_micros")
    ])
    bias = F.when(c("use_deep") == 0, c("bias1")).otherwise(c("bias2"))
    target = ratio(c("target_cents").cast("double") / 100, c("click"))
    return _keyed(merged).select(
        *_ID_COLUMNS, "use_deep", "second_goal", "optimization_goal", "t_advertiser", "cost_micros",
        _currency("cost_micros").alias("costs"),
        F.when(c("cost_micros") > 0, c("adgroup_id")).otherwise(F.lit(0)).alias("ad_cnt"),
        F.coalesce("click", F.lit(0)).alias("click"), "exposure", "conversions",
        F.coalesce(target, F.lit(0.0)).alias("target_cpa"), _currency("gmv_micros").alias("gmvc"),
        "pcvr_micros", "pctr_micros",
        m.reached(bias, c("use_amount_first")).alias("reach_rate_target"),
        m.below(bias, c("use_amount_first")).alias("below_rate_target"),
    )


def ad_detail(
    ads: DataFrame, generation: int,
    sub_brands: Sequence[str] | None = None,
    threshold_overrides: dict[str, dict[int, float]] | None = None,
) -> DataFrame:
    """Ads with intervals, thresholds, ad and account bias, success flags and weighted costs.

    The account bias is computed per (day, industry, sub-industry, advertiser key) but joined on day and
    advertiser key alone, so an advertiser listed in two industries on one day fans out, as in the original
    report. Generation 2 counts a missing bias as 0.

    Ads come dealt out by day and advertiser, and an advertiser key has one advertiser, so the biases are found by windows where
    the ads lie: the fact is read once, and no ad is written or moved for them.
    """
    c = F.col
    own = ["partition_date", "advertiser_id", "t_advertiser"]
    each = Window.partitionBy(*own, "op_industry", "op_industry2")
    costs = total(c("cost_micros")).over(each)
    gmvc = F.sum(c("gmvc").cast("decimal(28,6)")).over(each).cast("double")
    staged = ads.withColumns({"_costs": costs, "_gmvc": gmvc})
    bias = b.cost_bias(c("_gmvc"), c("_costs").cast("double") / m.MICROS)
    named = F.struct("op_industry", "op_industry2", bias.alias("ac_cpa_bias"))
    # As many as the advertiser has industries that day; a key with NULL meets nothing.
    met = F.when(c("partition_date").isNotNull() & c("t_advertiser").isNotNull(), F.collect_set(named).over(Window.partitionBy(*own)))
    staged = staged.withColumn("_biases", met).drop("_costs", "_gmvc")
    wanted = staged if sub_brands is None else staged.where(c("sub_brand").isin(*sub_brands))
    fanned = wanted.withColumn("_bias", F.explode_outer("_biases")).withColumn("ac_cpa_bias", c("_bias.ac_cpa_bias")).drop("_biases", "_bias")
    joined = fanned.withColumns(
        {
            "active_interval": b.conversion_interval(c("costs"), c("target_cpa"), c("click")),
            "ad_cpa_bias": b.cost_bias(c("gmvc"), c("costs")),
        }
    )
    if generation == 2:
        joined = joined.fillna(0, subset=["ad_cpa_bias", "ac_cpa_bias"])
    staged = joined.withColumns(
        {
            "ad_achieve_interval": b.interval_threshold(
                c("active_interval"), b.AD_THRESHOLDS, c("op_industry"), threshold_overrides
            ),
            "ac_achieve_interval": b.interval_threshold(c("active_interval"), b.ADVERTISER_THRESHOLDS),
        }
    )
    flagged = staged.withColumns(
        {
            "success_adgroup_id": b.success(c("ad_achieve_interval"), c("ad_cpa_bias")),
            "success_t_advertiser": b.success(c("ac_achieve_interval"), c("ac_cpa_bias")),
            "success_account": b.success(F.lit(b.ACCOUNT_THRESHOLD), c("ac_cpa_bias")),
            "active_bucket": b.over_ten_bucket(c("conversions"), c("costs"), c("target_cpa")),
        }
    )
    achieve = c("success_adgroup_id") * c("success_t_advertiser")
    share = lambda f: (c("cost_micros") * f).cast("double") / m.MICROS
    return flagged.withColumns(
        {
            "pcvr": _currency("pcvr_micros"),
            "pctr": _predicted_clicks(generation),
            "achieve": achieve,
            "achieve_cost": share(achieve),
            "ad_reach_cost": share(c("success_adgroup_id")),
            "ac_reach_cost": share(c("success_account")),
            "reach_cost": share(c("reach_rate_target")),
            "below_cost": share(c("below_rate_target")),
        }
    )


def rollup(detail: DataFrame, keys: Sequence[str], columns: Sequence[str], generation: int) -> DataFrame:
    """Report metrics per ``keys``; flags weigh integer micros, so rates do not depend on summation order."""
    c = F.col
    weights = {
        "achieve": c("achieve"), "ad_reach": c("success_adgroup_id"), "ac_reach": c("success_account"),
        "reach": c("reach_rate_target"), "below": c("below_rate_target"),
    }
    totals = detail.groupBy(*keys).agg(
        *[total(c("cost_micros") * f).alias(n) for n, f in weights.items()],
        total(c("cost_micros")).alias("cost_micros"),
        F.sum("click").alias("click_num"),
        F.sum("exposure").alias("exposure"),
        F.sum("conversions").alias("conversion_num"),
        F.sum(c("gmvc").cast("decimal(28,6)")).cast("double").alias("gmv"),
        total(c("pcvr_micros")).alias("pcvr_micros"),
        total(c("pctr_micros")).alias("pctr_micros"),
        (F.sum("ad_cnt") if generation == 1 else F.count_distinct("ad_cnt")).alias("ad_num"),
    )
    cost = _currency("cost_micros")
    predicted, predicted_clicks = _currency("pcvr_micros"), _predicted_clicks(generation)
    metrics = {
        "achieve_rate": ratio(c("achieve"), c("cost_micros")),
        "ad_reach_rate": ratio(c("ad_reach"), c("cost_micros")),
        "ac_reach_rate": ratio(c("ac_reach"), c("cost_micros")),
        "reach_rate": ratio(c("reach"), c("cost_micros")),
        "below_rate": ratio(c("below"), c("cost_micros")),
        "cost": cost,
        "pcvr": ratio(predicted, c("click_num")),
        "cvr": ratio(c("conversion_num"), c("click_num")),
        "pcvr_bias": ratio(predicted, c("conversion_num")) - 1,
        "pctr": ratio(predicted_clicks, c("exposure")),
        "ctr": ratio(c("click_num"), c("exposure")),
        "pctr_bias": ratio(predicted_clicks, c("click_num")) - 1,
        "gmv_to_cost": ratio(c("gmv"), cost),
    }
    return totals.withColumns(metrics).select(*keys, *columns)


def _with_pseudo_industry(detail: DataFrame) -> DataFrame:
    """Loan ads count in their own industry and once more under the pseudo-industry, in a single pass."""
    own = F.col("op_industry")
    labels = F.when(F.col("op_industry2") == p.LOAN, F.array(own, F.lit(p.LOAN))).otherwise(F.array(own))
    return detail.withColumn("op_industry", F.explode(labels))


def industry_report(detail: DataFrame, generation: int) -> DataFrame:
    """Per day and industry, with the loan pseudo-industry row."""
    return rollup(_with_pseudo_industry(detail), ["partition_date", "op_industry"], COMMON_METRICS, generation)


def bucket_report(detail: DataFrame, generation: int) -> DataFrame:
    """Per day, industry and conversion bucket. The published ``ad_reach_rate`` is the classic reach rate."""
    columns = [n for n in COMMON_METRICS if n != "ad_reach_rate"] + ["reach_rate"]
    out = rollup(
        _with_pseudo_industry(detail), ["partition_date", "op_industry", "active_bucket"], columns, generation
    )
    return out.withColumnRenamed("reach_rate", "ad_reach_rate")


def brand_list(text: str) -> list[str]:
    """Comma-separated brand argument; an empty argument matches only the empty brand."""
    return text.split(",")


def sub_brand_report(
    detail: DataFrame, generation: int, sub_brands: Sequence[str] | None = None, by_bucket: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Per day, sub-industry and sub-brand (optionally x conversion bucket), for a list of brands.

    The brand filter sits on a grouping key, so Spark applies it before the aggregation.
    """
    keys = ["partition_date", "op_industry2", "sub_brand"] + (["active_bucket"] if by_bucket else [])
    columns = [*COMMON_METRICS, "reach_rate", "below_rate"] + (["gmv_to_cost"] if by_bucket else [])
    out = rollup(detail, keys, columns, generation)
    if sub_brands is not None:
        out = out.where(F.col("sub_brand").isin(*sub_brands))
    return out.orderBy(F.desc("cost")) if ordered else out


#: Finest groups of the reports, and the keys of each report's roll-up.
BITMAP_KEYS = ("partition_date", "op_industry", "op_industry2", "sub_brand", "active_bucket")
ROLLUPS = {
    "industry": ("partition_date", "op_industry"),
    "industry_bucket": ("partition_date", "op_industry", "active_bucket"),
    "sub_brand": ("partition_date", "op_industry2", "sub_brand"),
    "sub_brand_bucket": ("partition_date", "op_industry2", "sub_brand", "active_bucket"),
}


def stored_ad_counts(detail: DataFrame, scratch: Scratch) -> DataFrame:
    """Bitmaps of the ads of a generation 2 detail, from which all ad counts of the reports follow, for any range of days."""
    return ad_bitmaps(detail, BITMAP_KEYS, "ad_cnt", "sub_brand", scratch)


def ad_counts(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``ad_num`` of a report's groups; by industry the loan pseudo-industry has its own rows."""
    return distinct_ads(_with_pseudo_industry(bitmaps) if "op_industry" in keys else bitmaps, keys)


def achieve_cost_by_key(detail: DataFrame) -> DataFrame:
    """Achieved cost per advertiser, sub-brand, product and goal."""
    return detail.groupBy(
        "advertiser_id", "sub_brand", F.col("product_id").alias("sku"), F.col("optimization_goal").alias("og")
    ).agg((total(F.col("cost_micros") * F.col("achieve")).cast("double") / m.MICROS).alias("achieve_cost"))


def key_advertisers(detail: DataFrame) -> DataFrame:
    """Advertisers per ``sku,sub_brand`` and per ``sub_brand`` as (kind, key, advertiser_id) rows.

    The original is an unfinished fragment; this is its evident result. Both mappings come from one pass.
    """
    c = F.col
    kinds = F.array(
        F.struct(F.lit("sku").alias("kind"), F.concat_ws(",", c("product_id"), c("sub_brand")).alias("key")),
        F.struct(F.lit("sub_brand").alias("kind"), c("sub_brand").alias("key")),
    )
    return (
        detail.select("advertiser_id", F.explode(kinds).alias("k"))
        .select("k.kind", "k.key", "advertiser_id")
        .distinct()
    )
