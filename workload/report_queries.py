"""Report queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.functions import predicates as p
from adgrove.functions.buckets import EDUCATION_AD_THRESHOLDS
from adgrove.operators.scratch import Scratch
from adgrove.plans import history, jobs, new_reach, retention
from adgrove.sources import schemas
from workload import report_sql as s
from workload.views import accounts, ad_fact

BRANDS = ["NATION_3", "NATION_8", "NATION_12", "NATION_17", "NATION_21"]
MONEY = {
    "cost", "GMV", "gmv", "costs", "gmvc", "total_cost", "sum_cost_v0", "sum_cost_v1", "below_rate_cost",
    "dcvr_reached_cost", "achieve_cost",
}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at report precision: money 2 decimals, rates 6 (the published tables hold 32-bit floats)."""
    def at(name: str) -> Column:
        unit = 1e2 if name in MONEY else 1e6
        return (F.floor(F.col(name) * unit + 0.5) / unit).alias(name)

    return df.select(*[at(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def _inputs(spark: SparkSession, d: str, monthly: bool = True, day: str = "partition_date"):
    return ad_fact(spark, d, monthly), accounts(spark, d, monthly, day)


def _both_days(spark: SparkSession, d: str) -> DataFrame:
    """Account days by either day of the fact."""
    return accounts(spark, d, False, "partition_date", "process_date")


def _same_day(gen: int, channel: str):
    return lambda spark, d: rounded(history.same_day_history(*_inputs(spark, d), gen, channel))


def _retro(gen: int, channel: str):
    return lambda spark, d: rounded(history.retro_history(*_inputs(spark, d, False, "process_date"), gen, channel))


def _multi_trace(spark, d):
    both_days = _both_days(spark, d)
    return rounded(history.multi_trace(ad_fact(spark, d, False), both_days))


def detail(spark: SparkSession, d: str, which: str = "gen1") -> DataFrame:
    if which == "gen1":
        return new_reach.ad_detail(new_reach.ad_rows_gen1(*_inputs(spark, d)), 1)
    return new_reach.ad_detail(new_reach.ad_rows_gen2(*_inputs(spark, d), which), 2)


def _gen(which: str) -> int:
    return 1 if which == "gen1" else 2


def _industry(which: str):
    return lambda spark, d: rounded(new_reach.industry_report(detail(spark, d, which), _gen(which)))


def _bucket(which: str):
    return lambda spark, d: rounded(new_reach.bucket_report(detail(spark, d, which), _gen(which)))


def _sub_brand(which: str, by_bucket: bool = False):
    return lambda spark, d: rounded(
        new_reach.sub_brand_report(detail(spark, d, which), _gen(which), BRANDS, by_bucket)
    )


def _detail_extract(spark, d, overrides=None):
    names = {"reach_rate_target": "reach", "below_rate_target": "below"}
    ads = new_reach.ad_detail(new_reach.ad_rows_gen1(*_inputs(spark, d)), 1, threshold_overrides=overrides)
    return rounded(ads.withColumnsRenamed(names).select(*s.DETAIL_KEEP, *s.DETAIL_RATES, "costs", "gmvc"))


def _detail_education(spark, d):
    """Ads with the education thresholds, which the reports leave off."""
    return _detail_extract(spark, d, {s.EDUCATION: EDUCATION_AD_THRESHOLDS})


RETENTION_KEYS = ("process_date", "industry", "sub_industry", "advertiser_id", "adgroup_id", "first_goal", "second_goal",
                  "bid_strategy", "auto_acquisition_status")
RETENTION_RATES = ("cpa1", "cpa2", "valid_tcpa2", "pcvr1_sum", "pdcvr_retain_num", "div_pcvr_retain_num")


def _retention_detail(spark, d):
    return rounded(retention.retention_ads(*_inputs(spark, d, False)).select(*RETENTION_KEYS, *RETENTION_RATES))


def _daily(spark, d):
    """Reports chosen by name from one daily job; the sub-brand report comes sorted by cost."""
    made = jobs.new_reach_day(*_inputs(spark, d), 1, reports=("sub_brand",), sub_brands=BRANDS)
    return rounded(made["sub_brand"])


def _history_job(spark, d):
    both_days = _both_days(spark, d)
    return rounded(history.named_history(jobs.history_day(ad_fact(spark, d, False), both_days)))


def _canonical(generation: int):
    """Same-day report from a fact under the column names of its generation."""
    names = {1: schemas.GENERATION_1, 2: schemas.GENERATION_2}[generation]

    def run(spark, d):
        fact, snapshot = _inputs(spark, d)
        raw = fact.withColumnsRenamed({new: old for new, old in names.items() if new != old})
        return rounded(history.same_day_history(schemas.canonical_fact(raw, generation), snapshot, generation, "gdt"))

    return run


def _ad_counts(spark, d):
    """Ad counts of the four reports, and of all days together, from one stored aggregate."""
    bitmaps = new_reach.stored_ad_counts(detail(spark, d, "gdt"), Scratch(spark))
    out = None
    for name, keys in {**new_reach.ROLLUPS, "industry_all_days": ("op_industry",)}.items():
        texts = [F.coalesce(F.col(k), F.lit("-")) for k in keys if k != "partition_date"]
        day = F.col("partition_date") if "partition_date" in keys else F.lit(0)
        some = new_reach.ad_counts(bitmaps, keys).select(
            F.lit(name).alias("report"), day.alias("day"), F.concat_ws("/", *texts).alias("of"), "ad_num"
        )
        out = some if out is None else out.unionByName(some)
    return out


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "reach_same_day_gen1": (_same_day(1, "gdt"), s.same_day(1, "gdt")),
    "reach_same_day_gdt": (_same_day(2, "gdt"), s.same_day(2, "gdt")),
    "reach_same_day_mp": (_same_day(2, "mp"), s.same_day(2, "mp")),
    "reach_retro_gen1": (_retro(1, "gdt"), s.retro(1, "gdt")),
    "reach_retro_gdt": (_retro(2, "gdt"), s.retro(2, "gdt")),
    "reach_retro_mp": (_retro(2, "mp"), s.retro(2, "mp")),
    "reach_multi_trace": (_multi_trace, s.multi_trace()),
    "reach_bucket_subindustry": (
        lambda spark, d: rounded(history.sub_industry_buckets(*_inputs(spark, d))), s.sub_industry_buckets()),
    "reach_bucket_medicine": (
        lambda spark, d: rounded(history.bucket_publication(history.sub_industry_buckets(*_inputs(spark, d)), p.MEDICINE)),
        s.sub_industry_buckets("医药")),
    "reach_medicine_subindustry": (
        lambda spark, d: rounded(history.medicine_sub_industries(*_inputs(spark, d))), s.medicine()),
    "bulk_bucket_analysis": (lambda spark, d: rounded(history.bulk_buckets(*_inputs(spark, d))), s.bulk()),
    "housing_bias_analysis": (lambda spark, d: rounded(history.housing_bias(*_inputs(spark, d))), s.housing()),
    "retention_summary": (
        lambda spark, d: rounded(retention.retention_summary(*_inputs(spark, d, False))), s.retention()),
    "new_reach_industry_gen1": (_industry("gen1"), s.industry("gen1")),
    "new_reach_industry_gdt": (_industry("gdt"), s.industry("gdt")),
    "new_reach_industry_mp": (_industry("mp"), s.industry("mp")),
    "new_reach_bucket_gen1": (_bucket("gen1"), s.bucket("gen1")),
    "new_reach_bucket_gdt": (_bucket("gdt"), s.bucket("gdt")),
    "new_reach_bucket_mp": (_bucket("mp"), s.bucket("mp")),
    "new_reach_sub_brand_gen1": (_sub_brand("gen1"), s.sub_brand("gen1", BRANDS)),
    "new_reach_sub_brand_gdt": (_sub_brand("gdt"), s.sub_brand("gdt", BRANDS)),
    "new_reach_sub_brand_mp": (_sub_brand("mp"), s.sub_brand("mp", BRANDS)),
    "new_reach_sub_brand_bucket_gen1": (_sub_brand("gen1", True), s.sub_brand("gen1", BRANDS, True)),
    "new_reach_sub_brand_bucket_mp": (_sub_brand("mp", True), s.sub_brand("mp", BRANDS, True)),
    "new_reach_sub_brand_bucket_gdt": (_sub_brand("gdt", True), s.sub_brand("gdt", BRANDS, True)),
    "daily_job_sub_brand": (_daily, s.sub_brand("gen1", BRANDS)),
    "daily_job_history": (_history_job, s.multi_trace()),
    "canonical_fact_gen1": (_canonical(1), s.same_day(1, "gdt")),
    "canonical_fact_gen2": (_canonical(2), s.same_day(2, "gdt")),
    "retention_detail": (_retention_detail, s.retention_detail()),
    "ad_count_bitmaps": (_ad_counts, s.ad_counts()),
    "ad_detail": (_detail_extract, s.detail()),
    "ad_detail_education": (_detail_education, s.detail(education=True)),
    "key_advertiser_mapping": (
        lambda spark, d: new_reach.key_advertisers(detail(spark, d)), s.key_mapping()),
    "achieve_cost_by_key": (
        lambda spark, d: rounded(new_reach.achieve_cost_by_key(detail(spark, d))), s.achieve_cost()),
}
