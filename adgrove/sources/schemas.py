"""Schemas of inputs, report tables and cluster files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adgrove.operators.classic import CLASSIC_METRICS

_LONG = {"partition_date", "process_date", "table_id", "ad_num", "click_num", "conversion_num"}
_TEXT = {"op_industry", "op_industry2", "sub_brand", "active_bucket"}


def _report(columns: str) -> T.StructType:
    def kind(name: str) -> T.DataType:
        return T.LongType() if name in _LONG else T.StringType() if name in _TEXT else T.DoubleType()

    return T.StructType([T.StructField(n, kind(n)) for n in columns.split()])


# Columns of the published tables, in their order.
_NEW = "cost gmv click_num conversion_num pcvr cvr pcvr_bias pctr ctr pctr_bias"
_CLASSIC = " ".join(CLASSIC_METRICS)
MULTI_TRACE = _report(f"partition_date process_date table_id op_industry {_CLASSIC}")
SUB_INDUSTRY_BUCKET = _report(f"partition_date op_industry op_industry2 active_bucket {_CLASSIC}")
INDUSTRY_BUCKET = _report(f"partition_date op_industry active_bucket ad_num achieve_rate ad_reach_rate ac_reach_rate {_NEW}")
INDUSTRY = _report(f"partition_date process_date op_industry ad_num achieve_rate ad_reach_rate ac_reach_rate {_NEW}")
SUB_BRAND = _report(
    f"partition_date op_industry2 sub_brand ad_num achieve_rate ad_reach_rate ac_reach_rate reach_rate below_rate {_NEW}"
)
SUB_BRAND_BUCKET = _report(
    "partition_date op_industry2 sub_brand active_bucket ad_num achieve_rate ad_reach_rate ac_reach_rate reach_rate "
    f"below_rate {_NEW} gmv_to_cost"
)
MEDICINE = _report(f"partition_date op_industry2 {_CLASSIC}")
REPORT_TABLES = {
    "multi_trace": MULTI_TRACE,
    "sub_industry_bucket": SUB_INDUSTRY_BUCKET,
    "industry_bucket": INDUSTRY_BUCKET,
    "industry": INDUSTRY,
    "sub_brand": SUB_BRAND,
    "sub_brand_bucket": SUB_BRAND_BUCKET,
    "medicine": MEDICINE,
}

CLUSTER_COLUMNS = (
    "aid", "uid", "uname", "rho", "delta", "cluster_id", "neighbor", "wordlist", "url", "simhash_emb", "city",
)
AD_JSON = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("aid", "uid", "uname", "coname", "url")]
    + [T.StructField("hash", T.LongType()), T.StructField("wordlist", T.ArrayType(T.StringType()))]
    + [T.StructField("city", T.StringType()), T.StructField("industry_type", T.ArrayType(T.StringType()))]
)

# Input column names of the two fact generations, by canonical name.
GENERATION_1 = {
    "partition_date": "partition_date", "process_date": "process_date", "first_goal": "smart_optimization_goal",
    "second_goal": "second_goal", "bid_strategy": "bid_strategy", "conv1": "active_num", "conv2": "second_active_num",
    "target1_click": "valid_click_target_cpa", "target2_click": "vc_second_bid", "gmv": "gmv", "second_gmv": "second_gmv",
    "pcvr1": "adjusted_smart_pcvr", "pcvr2": "vc_adjusted_smart_pcvr2", "pctr": "valid_exposure_pctr",
    "gsp_factor_sum": "ocpa_gsp_factor", "gsp_exposure_factor": "valid_gsp_exposure_gsp_factor",
    "gsp_exposure_cnt": "valid_gsp_exposure_cnt",
}
GENERATION_2 = {
    "partition_date": "partition_time", "process_date": "process_time", "first_goal": "optimization_goal",
    "second_goal": "second_optimization_goal", "bid_strategy": "ocpa_bid_strategy", "conv1": "ocpx_conversion_cnt",
    "conv2": "second_conversion_cnt", "target1_click": "vc_target_cpa", "target2_click": "vc_second_target_cpa",
    "gmv_exp_d": "gmv_exp_d", "pcvr1": "vc_adjusted_smart_pcvr", "pcvr2": "vc_adjusted_smart_pcvr2", "pctr": "ve_pctr",
    "gsp_factor_sum": "ve_or_vc_gsp_factor", "gsp_exposure_factor": "valid_gsp_exposure_gsp_factor",
    "gsp_exposure_cnt": "valid_gsp_exposure_cnt",
}


def canonical_fact(raw: DataFrame, generation: int) -> DataFrame:
    """Raw fact under canonical column names; columns shared by both generations keep theirs."""
    names = {1: GENERATION_1, 2: GENERATION_2}[generation]
    return raw.withColumnsRenamed({old: new for new, old in names.items() if old != new})


def conform(report: DataFrame, schema: T.StructType) -> DataFrame:
    """Report columns in table order and type; a declared column the report does not produce is NULL."""
    have = {c.lower(): c for c in report.columns}
    return report.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])
