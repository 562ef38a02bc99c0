import datetime

import pytest
from pyspark.sql import functions as F

from adgrove.functions import predicates as p
from adgrove.plans import history, jobs, new_reach, retention
from adgrove.sources import schemas, writers
from workload.views import FACT_COLUMNS

TYPES = ", ".join(
    f"{n} {'boolean' if n.startswith('is_') else 'bigint'}" for n in ("partition_date", "process_date", *FACT_COLUMNS)
)


def fact(spark, *rows):
    base = dict.fromkeys(("partition_date", "process_date", *FACT_COLUMNS), 0)
    base.update(
        partition_date=20210910, process_date=20210910, advertiser_id=1, product_id=1, adgroup_id=1, site_set=3,
        first_goal=104, is_rta_dpa_ad=False, is_ocpx=True, real_cost_micros=10_000_000, valid_click_cnt=10,
        valid_exposure_cnt=100, conv1=2, target1_click=5000, target_cpa_v2=55000, gmv=1000, bid_type=1,
        gsp_factor_sum=8, gsp_exposure_factor=50, gsp_exposure_cnt=100, pcvr1=2_000_000, pctr=10_000_000,
    )
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], TYPES)


def accounts(spark, *rows):
    return spark.createDataFrame(
        list(rows), "imp_date bigint, account_id bigint, industry_group string, industry_team_level2 string, op_sub_brand string"
    )


EDU = (20210910, 1, "教育", "k12", "b")


def test_same_day_rates_weigh_by_cost(spark):
    f = fact(
        spark, {}, {"adgroup_id": 2, "real_cost_micros": 30_000_000}, {"adgroup_id": 3, "site_set": 21},
        {"adgroup_id": 4, "no_compensation_type": 1}, {"adgroup_id": 5, "no_compensation_type": None, "conv1": 0},
        {"adgroup_id": 6, "advertiser_id": 9}, {"adgroup_id": 7, "second_goal": 106}, {"adgroup_id": 8, "second_goal": None},
    )
    r = history.same_day_history(f, accounts(spark, EDU)).first()
    assert (r.op_industry, r.ad_num, r.cost) == ("education", 3, 50.0)
    assert r.achieve_rate == pytest.approx(10 / 50)  # only ad 1 is on target; ad 5 has no conversions
    assert r.below_rate == pytest.approx(10 / 50)
    assert (r.ec_rate_0, r.ec_rate_2) == (pytest.approx(0.2), 1.0)
    assert r.gsp_factor == pytest.approx(0.8)
    assert r.pctr == pytest.approx(10.0 / 1e6 / 100)


def test_generation_two_counts_spending_ads_only(spark):
    f = fact(spark, {}, {"adgroup_id": 2, "real_cost_micros": 0}, {"adgroup_id": 3, "is_ocpx": False}, {"first_goal": 7})
    r = history.same_day_history(f, accounts(spark, EDU), 2).first()
    assert (r.ad_num, r.cost, r.click_num) == (1, 10.0, 20)


def test_retro_cohorts_by_industry_lag(spark):
    f = fact(
        spark,
        {"process_date": 20210831, "partition_date": 20210831},
        {"process_date": 20210831, "partition_date": 20210901},
        {"process_date": 20210831, "partition_date": 20210902},
        {"process_date": 20210831, "partition_date": 20210902, "advertiser_id": 2, "adgroup_id": 2},
        {"process_date": 20210831, "partition_date": 20210903, "advertiser_id": 2, "adgroup_id": 2},
    )
    a = accounts(spark, (20210831, 1, "教育", "k", "b"), (20210831, 2, "金融", "k", "b"))
    rows = {r.op_industry: r for r in history.retro_history(f, a).collect()}
    edu, fin = rows["education"], rows["finance"]
    assert (edu.partition_date, edu.process_date, edu.cost) == (20210901, 20210831, 20.0)
    assert (fin.partition_date, fin.process_date, fin.cost) == (20210902, 20210831, 10.0)


def test_backfill_equals_day_by_day(spark):
    days = [20210830, 20210831, 20210901]
    f = fact(spark, *[
        {"process_date": d, "partition_date": d, "adgroup_id": k, "advertiser_id": 1 + k % 2, "real_cost_micros": 1_000_000 * k}
        for d in days for k in range(1, 6)
    ])
    a = accounts(spark, *[(d, k, "教育" if k == 1 else "金融", "k", "b") for d in days for k in (1, 2)])
    for report in (history.same_day_history, history.retro_history):
        whole = sorted(map(tuple, report(f, a).collect()), key=str)
        runs = sorted({r[0] for r in whole})
        single = [tuple(r) for d in runs for r in report(f, a, first_day=d, last_day=d).collect()]
        assert sorted(single, key=str) == whole and len(runs) >= 3


def test_hot_account_is_summed_before_the_join(spark):
    f = fact(spark, *[{"adgroup_id": k % 3} for k in range(300)])
    report = history.same_day_history(f, accounts(spark, EDU))
    assert report.first().cost == 3000.0
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.rindex("Aggregate")


def detail(spark, f, a, generation=1):
    rows = new_reach.ad_rows_gen1(f, a) if generation == 1 else new_reach.ad_rows_gen2(f, a)
    return new_reach.ad_detail(rows, generation)


def test_advertiser_in_two_industries_fans_out(spark):
    a = accounts(spark, EDU, (20210910, 1, "医药", "贷款", "b"))
    rows = detail(spark, fact(spark, {}), a).collect()
    assert len(rows) == 4  # two ad rows, each meeting both account biases
    d = detail(spark, fact(spark, {}), a)
    report = {r.op_industry: r for r in new_reach.industry_report(d, 1).collect()}
    assert set(report) == {"教育", "医药", "贷款"}
    assert report["医药"].cost == report["贷款"].cost == 20.0


def test_missing_product_drops_the_ad(spark):
    assert detail(spark, fact(spark, {"product_id": None}), accounts(spark, EDU)).count() == 0


def test_goal_one_has_no_target(spark):
    r = detail(spark, fact(spark, {"second_goal": 1, "conv2": 1, "target2_click": 9}), accounts(spark, EDU)).first()
    assert (r.optimization_goal, r.target_cpa, r.gmvc, r.active_interval) == (1, 0.0, 0.0, 0)


def test_zero_cost_ad_counts_once_as_zero(spark):
    f = fact(spark, {}, {"adgroup_id": 2, "real_cost_micros": 0}, {"adgroup_id": 3, "real_cost_micros": 0})
    d = detail(spark, f, accounts(spark, EDU), 2)
    assert new_reach.industry_report(d, 2).first().ad_num == 2
    zero = d.where("costs = 0").first()
    assert (zero.ad_cpa_bias, zero.ad_cnt) == (0.0, 0)


def test_generation_two_merges_rows_with_equal_bias(spark):
    f = fact(
        spark, {"second_goal": 5, "first_goal": 104, "conv1": 0}, {"second_goal": 5, "first_goal": 105, "conv1": 0},
        {"second_goal": 5, "first_goal": 106, "conv1": 3},
    )
    rows = new_reach.ad_rows_gen2(f, accounts(spark, EDU)).collect()
    assert sorted(r.costs for r in rows) == [10.0, 20.0]


def test_sub_brand_filter_and_table_shape(spark):
    a = accounts(spark, EDU, (20210910, 2, "教育", "k12", "c"))
    d = detail(spark, fact(spark, {}, {"advertiser_id": 2, "adgroup_id": 2}), a)
    out = new_reach.sub_brand_report(d, 1, new_reach.brand_list("b,x"), ordered=True)
    assert [r.sub_brand for r in out.collect()] == ["b"]
    assert new_reach.sub_brand_report(d, 1, new_reach.brand_list("")).count() == 0
    shaped = schemas.conform(out, schemas.SUB_BRAND)
    assert shaped.schema.fieldNames() == schemas.SUB_BRAND.fieldNames()


def test_totals_are_additive_over_industries(spark):
    a = accounts(spark, EDU, (20210910, 2, "金融", "x", "c"))
    f = fact(spark, *[{"adgroup_id": k, "advertiser_id": 1 + k % 2} for k in range(10)])
    d = detail(spark, f, a)
    total = d.agg(F.sum("costs")).first()[0]
    assert sum(r.cost for r in new_reach.industry_report(d, 1).collect()) == total


@pytest.mark.parametrize("generation,days", [(1, {}), (2, {}), (1, {"first_day": 20210910, "last_day": 20210911})])
def test_both_histories_come_from_one_pass(spark, generation, days):
    f = fact(spark, *[
        {"partition_date": 20210909 + n % 4, "process_date": 20210909 + n % 4 - n % 5, "advertiser_id": n % 5 or None, "adgroup_id": n % 7,
         "second_goal": 5 * (n % 2), "real_cost_micros": 1_000_000 * n} for n in range(1, 120)
    ], {"process_date": None, "adgroup_id": 70}, {"partition_date": None, "adgroup_id": 71})
    names = ("金融", "教育", "医药", "other")
    a = accounts(spark, *[(20210900 + d, k, names[k - 1], "s", "b") for d in range(1, 15) for k in range(1, 5)], (20210910, 2, "旅游", "s", "b"))
    args = (f, a, generation, "gdt")
    want = history.retro_history(*args, **days).unionByName(history.same_day_history(*args, **days))
    for got in (history.both_histories(*args, **days), jobs.history_day(*args, **days)):
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
    assert {r.table_id for r in want.collect()} == {history.SAME_DAY, history.RETRO}


def test_account_days_are_found_in_one_pass(spark, tmp_path):
    from workload import views

    tables = {
        "lineitem": ("l_orderkey bigint, l_shipdate date", [(k, datetime.date(2021, 9, 1 + k % 3)) for k in range(12)] + [(3, None), (None, None)]),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(k, k % 4 or None) for k in range(12)] + [(5, 1)]),
        "customer": ("c_custkey bigint, c_mktsegment string, c_nationkey int", [(k, "BUILDING", 1) for k in (1, 2, 2, 3)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "n", 1)]),
        "region": ("r_regionkey int, r_name string", [(1, "ASIA")]),
    }
    for name, (schema, some) in tables.items():
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    ship, cohort = (views.accounts(spark, str(tmp_path), False, day) for day in ("partition_date", "process_date"))
    both = views.accounts(spark, str(tmp_path), False, "partition_date", "process_date")
    assert sorted(map(str, both.collect())) == sorted(map(str, ship.union(cohort).distinct().collect()))
    assert len({r.imp_date for r in both.collect()}) > 3
    assert both._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 5  # each table once


def test_named_history_blanks_unknown_codes(spark):
    df = spark.createDataFrame([(1, "finance"), (1, "nope")], "partition_date int, op_industry string")
    assert [r.op_industry for r in history.named_history(df).collect()] == ["金融", None]


def test_canonical_names(spark):
    raw = spark.createDataFrame([(1, 2)], "partition_time int, ocpx_conversion_cnt int")
    assert schemas.canonical_fact(raw, 2).columns == ["partition_date", "conv1"]


def test_rerun_of_a_day_replaces_it(spark, tmp_path):
    path = str(tmp_path / "hist")
    df = spark.createDataFrame([(20210901, 1), (20210902, 2)], "partition_date int, x int")
    writers.write_days(df, path)
    writers.write_days(df.where("partition_date = 20210902").withColumn("x", F.lit(7)), path)
    read = lambda: sorted((r.partition_date, r.x) for r in spark.read.parquet(path).collect())
    assert read() == [(20210901, 1), (20210902, 7)]
    writers.drop_day(spark, path, 20210901)
    assert read() == [(20210902, 7)]


def test_daily_job_shares_one_detail(spark):
    out = jobs.new_reach_day(fact(spark, {}), accounts(spark, EDU), sub_brands=["b"])
    assert set(out) == {"detail", "industry", "industry_bucket", "sub_brand"}
    assert out["industry"].first().cost == out["sub_brand"].first().cost == out["detail"].first().costs == 10.0
    assert "active_bucket" in out["industry_bucket"].columns
    rows = jobs.history_day(fact(spark, {"process_date": 20210909}, {}), accounts(spark, EDU, (20210909, 1, "教育", "k", "b")))
    assert sorted(r.table_id for r in rows.collect()) == [1, 1, 2]


def test_roll_ups_beyond_bigint(spark):
    """Ads of 4e18 micros each: their sum does not fit 64 bits."""
    f = fact(spark, *[{"adgroup_id": i, "real_cost_micros": 4 * 10**18, "pcvr1": 10**18, "gmv": 10**18} for i in range(5)])
    a = accounts(spark, EDU)
    row = history.same_day_history(f, a).first()
    assert row.cost == 2e13 and row.ad_num == 5
    row = new_reach.industry_report(detail(spark, f, a), 1).first()
    assert row.cost == 2e13
    spend = fact(spark, *[{"adgroup_id": i, "second_goal": 106, "real_cost_micros": 4 * 10**18} for i in range(5)])
    bulk = accounts(spark, (20210910, 1, p.BULK_INDUSTRIES[0], "k12", "b"))
    assert retention.retention_summary(spend, bulk).first().total_cost == 2e13


def test_retention_and_multi_trace_prune_days(spark, tmp_path):
    f = fact(spark, *[{"partition_date": d, "process_date": d} for d in (20210908, 20210909, 20210910, 20210911)])
    writers.write_days(f, f"{tmp_path}/fact")
    a = accounts(spark, EDU)
    writers.write_days(a, f"{tmp_path}/acc", "imp_date")
    f, a = spark.read.parquet(f"{tmp_path}/fact"), spark.read.parquet(f"{tmp_path}/acc")
    for df in (retention.retention_summary(f, a, 20210909, 20210909),
               history.multi_trace(f, a, first_day=20210910, last_day=20210910)):
        scans = [line for line in df._jdf.queryExecution().toString().split("\n") if "FileScan parquet" in line]
        assert scans and all("PartitionFilters: [isnotnull(" in line and ">= 202109" in line for line in scans)


def test_a_day_is_written_by_several_tasks(spark, tmp_path):
    f = fact(spark, *[{"adgroup_id": i} for i in range(200)])
    # Small shuffles are merged at run time; a real day is not small.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_days(f, f"{tmp_path}/fact", tasks=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [p for p in (tmp_path / "fact" / "partition_date=20210910").iterdir() if p.suffix == ".parquet"]
    assert 2 <= len(files) <= 4
    assert spark.read.parquet(f"{tmp_path}/fact").count() == 200


def test_account_bias_is_found_where_the_ads_lie(spark, monkeypatch):
    from adgrove.operators.scratch import Scratch

    rows = new_reach.ad_rows_gen1(fact(spark, {}, {"adgroup_id": 2, "conv1": 0}), accounts(spark, EDU, (20210910, 1, "医药", "贷款", "b")))
    joins = rows._jdf.queryExecution().optimizedPlan().toString().count("Join")
    monkeypatch.setattr(Scratch, "cut", None)  # nothing is written
    found = new_reach.ad_detail(rows, 1)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == joins
    assert found.count() == 8 and len({r.ac_cpa_bias for r in found.collect()}) == 1


def test_large_inputs_are_dealt_over_more_tasks(spark, monkeypatch, tmp_path):
    from adgrove.operators import scratch

    f = fact(spark, *[{"adgroup_id": k, "advertiser_id": k % 5} for k in range(50)])
    f.write.parquet(f"{tmp_path}/fact")
    stored, a = spark.read.parquet(f"{tmp_path}/fact"), accounts(spark, *[(20210910, k, "教育", "k", "b") for k in range(5)])
    want = history.same_day_history(f, a).collect()
    assert scratch.wide_tasks(stored) is None
    monkeypatch.setattr(scratch.wide_tasks, "__defaults__", (64,))
    tasks = scratch.wide_tasks(stored)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = history.same_day_history(stored, a)
    assert f", {tasks})" in dealt._jdf.queryExecution().toString()
    assert dealt.collect() == want
