import pytest
from pyspark.sql import functions as F
from test_reports import accounts, fact

from adgrove.functions import dates
from adgrove.operators.ad_totals import STORED_KEYS
from adgrove.operators.scratch import Scratch
from adgrove.plans import accrual, history, new_reach, retention
from adgrove.sources import bucketed

DAYS = (20210830, 20210831, 20210901, 20210902)


@pytest.fixture(scope="module")
def inputs(spark):
    """Facts of four cohort days with accrual up to two days later; account 1 holds most of them."""
    rows = []
    for n in range(240):
        cohort = DAYS[n % 4]
        rows.append({
            "process_date": cohort, "partition_date": dates.shift_day(cohort, n % 3), "advertiser_id": 1 if n % 3 else n % 7 + 1,
            "adgroup_id": n % 11, "second_goal": 0 if n % 2 else 5, "conv1": n % 5, "conv2": n % 4, "target2_click": 700,
            "real_cost_micros": 1_000_000 * (n % 9), "site_set": 21 if n % 13 == 0 else 3, "bid_type": 1 + 3 * (n % 2),
        })
    rows += [{"advertiser_id": None}, {"adgroup_id": None, "partition_date": 20210901, "process_date": 20210901}]
    days = sorted({*DAYS, *(dates.shift_day(d, k) for d in DAYS for k in (1, 2))})
    names = ("金融", "教育", "医药", "房产", "家居", "大交通", "旅游")
    known = [(d, a, names[a - 1], f"s{a % 2}", f"b{a}") for d in days for a in range(1, 8)]
    known += [(20210901, 2, "医药", "twice", "b"), (20210901, None, "教育", "none", "b")]
    return fact(spark, *rows).cache(), accounts(spark, *known).cache()


def rows(df):
    return sorted(map(repr, df.collect()))


def tables(inputs, spark, day="partition_date", **options):
    return bucketed.create_day_tables(*inputs, Scratch(spark).folder, 4, day, **options)


@pytest.mark.parametrize("options", [{}, {"part_rows": 5, "shares": 4}, {"part_rows": 0, "shares": 1000}])
def test_reports_over_day_tables(spark, inputs, options):
    t = tables(inputs, spark, **options)
    stored = t.read(spark)
    assert rows(history.same_day_history(*stored)) == rows(history.same_day_history(*inputs))
    assert rows(history.same_day_history(*stored, first_day=20210901, last_day=20210901)) == rows(
        history.same_day_history(*inputs, first_day=20210901, last_day=20210901))
    assert rows(retention.retention_ads(*stored)) == rows(retention.retention_ads(*inputs))
    assert rows(new_reach.ad_rows_gen1(*stored)) == rows(new_reach.ad_rows_gen1(*inputs))
    assert stored[0].count() == inputs[0].count()
    bucketed.drop_day_tables(spark, t)


def test_retrospective_reports_over_cohort_tables(spark, inputs):
    t = tables(inputs, spark, "process_date", part_rows=10, shares=5)
    assert rows(history.retro_history(*t.read(spark))) == rows(history.retro_history(*inputs))
    bucketed.drop_day_tables(spark, t)
    with pytest.raises(ValueError):
        tables(inputs, spark, "other")


def test_large_accounts_are_stored_in_parts(spark, inputs):
    hot = bucketed.hot_accounts(inputs[0], "partition_date", part_rows=5, shares=4).collect()
    assert {r._account for r in hot} == {1}
    t = tables(inputs, spark, part_rows=5, shares=4)
    stored, snapshot = t.read(spark)
    parts = stored.where("advertiser_id = 1 and partition_date = 20210901").groupBy("account_day").agg(F.countDistinct("adgroup_id").alias("ads"))
    assert parts.count() > 1
    ads = stored.groupBy("partition_date", "advertiser_id", "adgroup_id").agg(F.countDistinct("account_day").alias("n"))
    assert ads.agg(F.max("n")).first()[0] == 1  # an ad's records stay together
    one = snapshot.where("account_id = 1 and imp_date = 20210901").count()
    assert one == next(r._parts for r in hot if r._day == 20210901)
    bucketed.drop_day_tables(spark, t)


def test_report_moves_no_row_before_the_join(spark, inputs):
    t = tables(inputs, spark)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stored in (True, False):
            df = history.same_day_history(*(t.read(spark) if stored else inputs), first_day=20210901, last_day=20210902)
            plan = df._jdf.queryExecution().executedPlan().toString()
            below = plan[plan.index("SortMergeJoin"):]
            assert ("Exchange" in below) != stored
            if stored:
                assert "SelectedBucketsCount: 4 out of 4" in below and "partition_date#" in below.split("PartitionFilters")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        bucketed.drop_day_tables(spark, t)


def test_wide_columns_are_made_after_rows_are_dealt(spark, inputs, monkeypatch):
    f, a = inputs
    columns = ["conv1 * 1000 as gmv", "conv2 * 1000 as second_gmv", *(c for c in f.columns if c not in ("gmv", "second_gmv"))]
    dealt, real = [], bucketed._dealt
    monkeypatch.setattr(bucketed, "_dealt", lambda *args: dealt.append(real(*args)) or dealt[-1])
    t = bucketed.create_day_tables(f.drop("gmv", "second_gmv"), a, Scratch(spark).folder, 4, part_rows=5, shares=4, columns=columns)
    plan = dealt[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS gmv#") < plan.index("RepartitionByExpression")
    want = f.selectExpr(*columns)
    assert rows(t.read(spark)[0].select(*f.columns)) == rows(want.select(*f.columns))
    newer = f.drop("gmv", "second_gmv").withColumn("conv1", F.col("conv1") + 1)
    bucketed.replace_day(t, newer, a, 20210901, part_rows=5, shares=4, columns=columns)
    again = want.where("not partition_date <=> 20210901").union(newer.selectExpr(*columns).where("partition_date = 20210901"))
    assert rows(t.read(spark)[0].select(*f.columns)) == rows(again.select(*f.columns))
    bucketed.drop_day_tables(spark, t)


def test_a_day_is_replaced_in_both_tables(spark, inputs):
    t = tables(inputs, spark)
    newer = inputs[0].withColumn("real_cost_micros", F.col("real_cost_micros") * 3)
    bucketed.replace_day(t, newer, inputs[1], 20210901, part_rows=5, shares=4)
    mixed = newer.where("partition_date = 20210901").unionByName(inputs[0].where("partition_date <> 20210901"))
    assert rows(history.same_day_history(*t.read(spark))) == rows(history.same_day_history(mixed, inputs[1]))
    bucketed.replace_day(t, inputs[0].limit(0), inputs[1], 20210901)
    assert t.read(spark)[0].where("partition_date = 20210901").count() == 0
    bucketed.drop_day_tables(spark, t)


# Mergeable totals


@pytest.mark.parametrize("generation, channel", [(1, "gdt"), (2, "gdt"), (2, "mp")])
def test_daily_runs_equal_a_backfill(spark, inputs, generation, channel):
    f, a = inputs
    f = f.withColumns({"auto_acquisition_status": F.lit(0), "gmv_exp_d": F.col("gmv")})
    folder = Scratch(spark).folder
    daily, whole = accrual.State(f"{folder}/daily", generation, channel), accrual.State(f"{folder}/whole", generation, channel)
    days = sorted(r[0] for r in f.select("partition_date").distinct().collect())
    for day in days:
        accrual.update(daily, f.where(F.col("partition_date") == day), day, day)
    accrual.update(whole, f, days[0], days[-1])
    args = (generation, channel)
    for state in (daily, whole):
        assert rows(accrual.retro(spark, state, a)) == rows(history.retro_history(f, a, *args))
        assert rows(accrual.same_day(spark, state, a)) == rows(history.same_day_history(f, a, *args))
        one = dict(first_day=20210902, last_day=20210902)
        assert rows(accrual.retro(spark, state, a, **one)) == rows(history.retro_history(f, a, *args, **one))


def test_late_repeated_and_emptied_days_replace_their_share(spark, inputs):
    f, a = inputs
    state = accrual.State(f"{Scratch(spark).folder}/state")
    assert accrual.retro(spark, state, a).count() == 0
    twice = f.unionByName(f.where("partition_date = 20210901"))
    accrual.update(state, twice, 20210830, 20210904)
    assert rows(accrual.retro(spark, state, a)) == rows(history.retro_history(twice, a))
    accrual.update(state, f, 20210901, 20210901)
    accrual.update(state, f, 20210901, 20210901)
    assert rows(accrual.retro(spark, state, a)) == rows(history.retro_history(f, a))
    accrual.update(state, f.where("partition_date <> 20210902"), 20210902, 20210903)
    kept = f.where("partition_date <> 20210902")
    assert rows(accrual.retro(spark, state, a)) == rows(history.retro_history(kept, a))
    assert rows(accrual.same_day(spark, state, a)) == rows(history.same_day_history(kept, a))


def test_a_run_reads_three_shares(spark, inputs):
    f, a = inputs
    state = accrual.State(f"{Scratch(spark).folder}/state")
    accrual.update(state, f, 20210830, 20210904)
    held = state.read(spark)
    assert held.count() < f.count()
    read = accrual.retro(spark, state, a, 20210902, 20210902).inputFiles()
    assert {f.split("partition_date=")[1][:8] for f in read if "partition_date" in f} >= {"20210831", "20210902"}
    plan = accrual.retro(spark, state, a, 20210902, 20210902)._jdf.queryExecution().optimizedPlan().toString()
    assert "partition_date" in plan and ">= 20210831" in plan and "<= 20210902" in plan
    want = rows(accrual.retro(spark, state, a, 20210902, 20210904))
    assert accrual.compact(spark, state, 20210902) == 1
    assert rows(accrual.retro(spark, state, a, 20210902, 20210904)) == want


def test_keys_name_the_day_they_hold():
    assert set(STORED_KEYS) == {"partition_date", "process_date"}
