"""Fixtures: the reporting and clustering inputs derived from the driver tables.

Expressions shared by Spark and DuckDB are kept once, as text; only date arithmetic differs by dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.operators.scratch import wide_tasks

INDUSTRY_ROLE = """case c_mktsegment when 'FURNITURE' then '金融' when 'HOUSEHOLD' then '教育'
    when 'MACHINERY' then '医药' when 'BUILDING' then '房产' else '大交通' end"""
SUB_INDUSTRY = "case when r_name = 'ASIA' then '贷款' else r_name end"

#: ``monthly`` of the views below: records dated on the first of their month, on their day, or on their day of one month.
FOLDED = "folded"


def record_date(dialect: str, which: str, monthly: bool | str) -> str:
    """Date of a record's delivery (``ship``) or of its cohort, up to two days earlier."""
    ship = "cast(l_shipdate as date)"
    if monthly == FOLDED:
        ship = {"spark": f"date_add(date'2021-08-01', day({ship}) - 1)", "duckdb": f"(date '2021-08-01' + cast(day({ship}) - 1 as int))"}[dialect]
    if which == "ship":
        return ship
    return {"spark": f"date_sub({ship}, cast(l_orderkey % 3 as int))", "duckdb": f"({ship} - cast(l_orderkey % 3 as int))"}[dialect]


def day_int(dialect: str, which: str, monthly: bool | str) -> str:
    date = record_date(dialect, which, monthly)
    day = "1" if monthly is True else f"day({date})"
    return f"cast(year({date}) * 10000 + month({date}) * 100 + {day} as int)"


CLICK = "cast(l_quantity as bigint)"
EXPOSURE = f"({CLICK} * (10 + l_linenumber))"
CONV1 = "cast(round(l_discount * 100) as bigint)"
CONV2 = "cast(round(l_tax * 100) as bigint)"
UNIT1 = "cast(round(p_retailprice * 1100) as bigint)"
UNIT2 = "cast(round(p_retailprice * 1300) as bigint)"
SECOND_GOAL = "case l_returnflag when 'A' then 0 when 'N' then 5 else 106 end"

FACT_COLUMNS = {
    "advertiser_id": "o_custkey",
    "product_id": "l_suppkey",
    "adgroup_id": "l_partkey",
    "site_set": "l_linenumber * 3",
    "no_compensation_type": "case l_linenumber when 1 then null when 2 then 1 else 0 end",
    "second_goal": SECOND_GOAL,
    "first_goal": "case l_linestatus when 'O' then 104 else 7 end",
    "bid_strategy": "1 + l_linenumber % 2",
    "deep_stage_status": "1 + l_suppkey % 2",
    "bid_type": "case when l_linenumber % 2 = 1 then 1 else 4 end",
    "is_rta_dpa_ad": "l_suppkey % 11 = 0",
    "is_ocpx": "l_suppkey % 13 <> 0",
    "auto_acquisition_status": "cast(l_suppkey % 5 = 0 as int)",
    "action_type": "104 + l_linenumber % 3",
    "real_cost_micros": "cast(round(l_extendedprice * 100) as bigint) * 10000",
    "valid_click_cnt": CLICK,
    "valid_exposure_cnt": EXPOSURE,
    "conv1": CONV1,
    "conv2": CONV2,
    "target1_click": f"{CLICK} * {UNIT1}",
    "target2_click": f"{CLICK} * {UNIT2}",
    "target_cpa_v2": f"({CLICK} + {EXPOSURE}) * {UNIT1}",
    "ocpa_second_target_cpa": f"case when l_linenumber % 2 = 1 then {CLICK} else {EXPOSURE} end * {UNIT2}",
    "gmv": f"{CONV1} * {UNIT1}",
    "second_gmv": f"{CONV2} * {UNIT2}",
    "gmv_exp_d": f"case when {SECOND_GOAL} > 0 then {CONV2} * {UNIT2} else {CONV1} * {UNIT1} end * 10000",
    "pcvr1": f"{CONV1} * (900000 + 10000 * (l_partkey % 30))",
    "pcvr2": f"{CONV2} * (900000 + 10000 * (l_partkey % 30))",
    "pctr": f"{CLICK} * (950000 + 10000 * (l_partkey % 10))",
    "gsp_factor_sum": f"{CLICK} * 80",
    "gsp_exposure_factor": f"{EXPOSURE} * 75",
    "gsp_exposure_cnt": EXPOSURE,
    "trace_cnt": CONV2,
    "vt_smart_deep_pcvr": f"{CONV2} * 1000000",
    "valid_click_smart_pcvr": f"{CONV1} * (900000 + 10000 * (l_partkey % 30))",
    "vc_ltv_info_smart_pcvr2": CONV2,
}


def fact_projection(dialect: str, monthly: bool) -> list[str]:
    days = [f"{day_int(dialect, 'ship', monthly)} as partition_date", f"{day_int(dialect, 'cohort', monthly)} as process_date"]
    return days + [f"{e} as {n}" for n, e in FACT_COLUMNS.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order and part."""
    lines, orders, parts = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part"))
    tasks = wide_tasks(lines)
    if tasks:
        lines = lines.repartition(tasks, "l_orderkey")
    ordered = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if tasks:
        ordered = ordered.repartition(tasks, "l_partkey")
    return ordered.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def ad_fact(spark: SparkSession, sf_dir: str, monthly: bool = True) -> DataFrame:
    """Delivery fact: one row per line item. ``monthly`` dates records on the first of their month."""
    return _ad_lines(spark, sf_dir).selectExpr(*fact_projection("spark", monthly))


def ad_sources(spark: SparkSession, sf_dir: str, monthly: bool = True) -> tuple[DataFrame, list[str]]:
    """The same fact as what its columns are made from, with days, advertiser and ad group, and the expressions of its columns."""
    rows, columns = _ad_lines(spark, sf_dir), fact_projection("spark", monthly)
    keys = [e for e in columns if e.rpartition(" as ")[2] in ("partition_date", "process_date", "advertiser_id", "adgroup_id")]
    return rows.selectExpr("*", *keys), columns


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "c_custkey as account_id", f"{INDUSTRY_ROLE} as industry_group",
            f"{SUB_INDUSTRY} as industry_team_level2", "n_name as op_sub_brand",
        )
    )


def accounts(spark: SparkSession, sf_dir: str, monthly: bool = True, *days: str) -> DataFrame:
    """Daily account snapshot: each account on the days it has records, by one of the fact's ``days`` (its report day) or several.

    Dealt by account once, for the distinct days and the account's attributes alike.
    """
    lines = table(spark, sf_dir, "lineitem")
    of = ", ".join(day_int("spark", "ship" if day == "partition_date" else "cohort", monthly) for day in days or ("partition_date",))
    tasks = wide_tasks(lines)
    records = (
        lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr("o_custkey as account_id", f"explode(array_distinct(array({of}))) as imp_date" if len(days) > 1 else f"{of} as imp_date")
    )
    each = records.repartition(*([tasks] if tasks else []), "account_id").distinct()
    known = customers(spark, sf_dir)
    return each.join(known.distinct() if len(days) > 1 else known, "account_id")


def fact_sql(monthly: bool) -> str:
    cols = ",\n  ".join(fact_projection("duckdb", monthly))
    return (
        f"select {cols} from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey"
    )


def accounts_sql(monthly: bool, day: str = "partition_date") -> str:
    imp_date = day_int("duckdb", "ship" if day == "partition_date" else "cohort", monthly)
    return f"""select imp_date, account_id, {INDUSTRY_ROLE} as industry_group,
    {SUB_INDUSTRY} as industry_team_level2, n_name as op_sub_brand
  from (select distinct o_custkey as account_id, {imp_date} as imp_date
        from lineitem join orders on l_orderkey = o_orderkey) d
  join customer on c_custkey = account_id
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


# --- creatives ------------------------------------------------------------------------------------

HASH_BITS = 60
# Majority vote over the bits of the word hashes; stands in for the hash column that arrives with real ads.
# Three 20-bit counters share one sum: bits k, k + 20 and k + 40 of a word hash add up in the same integer.
LANES, LANE = 20, 20
LANE_MASK = sum(1 << (LANE * j) for j in range(HASH_BITS // LANES))
VOTES = ["count(*) as n", *[f"sum((h >> {k}) & {LANE_MASK}) as s{k}" for k in range(LANES)]]
HASH_VALUE = " + ".join(
    f"(case when 2 * ((s{i % LANES} >> {LANE * (i // LANES)}) & {(1 << LANE) - 1}) > n then cast({1 << i} as bigint) else 0 end)"
    for i in range(HASH_BITS)
)
# The oracle counts each bit on its own.
SQL_VOTES = ", ".join(f"sum(((h >> {i}) & 1) * 2 - 1) as s{i}" for i in range(HASH_BITS))
SQL_HASH = " + ".join(f"(case when s{i} > 0 then cast({1 << i} as bigint) else 0 end)" for i in range(HASH_BITS))


CREATIVE = {
    "idx": "doc_id",
    "aid": "concat('a', cast(doc_id as {text}))",
    "uid": "source",
    "uname": "concat(lang, '-', source)",
    "coname": "concat('co-', lang)",
    "url": "concat('https://', source, '.example.com/', lang, '/', cast(n_chars % 40 as {text}), '/x')",
    "city": "concat('c', cast(n_chars % 5 as {text}), ',c', cast(n_chars % 3 as {text}))",
}


def creative_projection(dialect: str) -> list[str]:
    kind = "string" if dialect == "spark" else "varchar"
    return [f"{e.format(text=kind)} as {n}" for n, e in CREATIVE.items()]


def text_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").selectExpr("doc_id", "explode(split(text, ' ')) as w")
    hashed = words.selectExpr("doc_id", "cast(conv(substr(md5(w), 1, 15), 16, 10) as bigint) as h")
    return hashed.groupBy("doc_id").agg(*[F.expr(v) for v in VOTES]).selectExpr("doc_id", f"{HASH_VALUE} as hash")


def creatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads from documents: identity, user, company, URL, cities, text hash, word list, industry levels."""
    docs = table(spark, sf_dir, "documents")
    base = docs.selectExpr(
        "doc_id", *creative_projection("spark"), "split(text, ' ') as wordlist",
        "array('ads', lang, source, concat(lang, '-', source)) as industry_type",
    )
    return base.join(text_hashes(spark, sf_dir), "doc_id").drop("doc_id")


def creatives_sql() -> str:
    return f"""select {', '.join(creative_projection('duckdb'))}, hash, lang from documents join (
    select doc_id, {SQL_HASH} as hash from (select doc_id, {SQL_VOTES} from (
      select doc_id, cast('0x' || substr(md5(w), 1, 15) as bigint) as h
      from (select doc_id, unnest(string_split(text, ' ')) as w from documents) t) u group by doc_id) v) hashes
    using (doc_id)"""


DIM = 64
# Embeddings are FLOAT; both engines widen them before scaling, so ties round alike.
WHOLE = "cast(round(cast(x as double) * 10000) as bigint)"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as integers (exact in every engine), with an ad and a URL each."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id as idx", "concat('a', vec_id) as aid", "concat('https://example.com/', label, '/', vec_id) as url",
        f"transform(embedding, x -> {WHOLE}) as vector",
    )


def vectors_sql() -> str:
    return (f"select vec_id as idx, 'a' || vec_id as aid, 'https://example.com/' || label || '/' || vec_id as url, "
            f"[{WHOLE} for x in embedding] as vector from embeddings")


def page_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads from pages with the sign code of the page's embedding as hash."""
    sign = " + ".join(f"(case when embedding[{i}] >= 0 then {1 << i}L else 0L end)" for i in range(62))
    return table(spark, sf_dir, "pages").join(
        table(spark, sf_dir, "embeddings"), F.col("page_id") == F.col("vec_id")
    ).selectExpr(
        "page_id as aid", "url", f"{sign} as hash", "split(url, '/')[2] as uname", "concat('co', page_id % 7) as coname",
        "concat('c', page_id % 5, ',c', page_id % 3) as city",
    )


def page_ads_sql() -> str:
    sign = " + ".join(f"(case when embedding[{i + 1}] >= 0 then {1 << i}::bigint else 0 end)" for i in range(62))
    return f"""select page_id as aid, url, {sign} as hash, split_part(url, '/', 3) as uname, 'co' || page_id % 7 as coname,
    'c' || page_id % 5 || ',c' || page_id % 3 as city from pages join embeddings on page_id = vec_id"""
