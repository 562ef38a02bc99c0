import pytest
from pyspark.sql import functions as F

from adgrove.functions import buckets as b
from adgrove.functions import dates
from adgrove.functions import metrics as m
from adgrove.functions import predicates as p
from adgrove.functions.arith import ratio

C = F.col


def one(spark, expr, types, *row):
    return spark.createDataFrame([row], types).select(expr.alias("v")).first()["v"]


def test_division_by_zero_is_null(spark):
    assert one(spark, ratio(C("x"), C("y")), "x bigint, y bigint", 5, 0) is None
    assert one(spark, ratio(C("x"), C("y")), "x bigint, y bigint", 5, None) is None
    assert one(spark, ratio(C("x"), C("y")), "x bigint, y bigint", 5, 2) == 2.5


@pytest.mark.parametrize("bias,use,reached,below", [
    (0.2, 0, 1, 1), (-0.2, 0, 1, 1), (0.2000001, 0, 0, 0), (-0.21, 0, 0, 1), (0.3, 1, 1, 1), (-0.3, 1, 1, 1),
    (0.3000001, 1, 0, 0), (None, 1, 0, 0),
])
def test_reach_thresholds_are_inclusive_and_exact(spark, bias, use, reached, below):
    t = "bias double, use int"
    assert one(spark, m.reached(C("bias"), C("use")), t, bias, use) == reached
    assert one(spark, m.below(C("bias"), C("use")), t, bias, use) == below


def test_cpa_bias(spark):
    t = "cost bigint, conv bigint, target bigint, click bigint"
    bias = m.cpa_bias(C("cost"), C("conv"), C("target"), C("click"))
    assert one(spark, bias, t, 12_000_000, 2, 5000, 10) == pytest.approx(0.2)
    for row in [(1, 0, 5, 5), (1, 1, 0, 5), (1, 1, 5, 0), (1, None, 5, 5)]:
        assert one(spark, bias, t, *row) is None


@pytest.mark.parametrize("goal,plain,strict", [(0, 1.0, 1.0), (1, 2.0, 0.0), (5, 2.0, 2.0), (106, 2.0, 2.0), (None, 2.0, 0.0)])
def test_goal_selection(spark, goal, plain, strict):
    t = "g int, a double, b double"
    assert one(spark, m.by_goal(C("g"), C("a"), C("b")), t, goal, 1.0, 2.0) == plain
    assert one(spark, m.by_goal_strict(C("g"), C("a"), C("b")), t, goal, 1.0, 2.0) == strict


def test_effective_goal(spark):
    goal = m.effective_goal(C("first"), C("second"))
    for second, want in ((0, 9), (None, 9), (5, 5)):
        assert one(spark, goal, "first int, second int", 9, second) == want


@pytest.mark.parametrize("cost,target,click,want", [
    (0.0, 2.0, 1, 1), (1.9, 2.0, 1, 1), (2.0, 2.0, 1, 2), (6.0, 2.0, 1, 3), (10.0, 2.0, 1, 4), (20.0, 2.0, 1, 5),
    (5.0, 0.0, 1, 0), (5.0, -1.0, 1, 0), (5.0, 2.0, 0, 0), (-1.0, 2.0, 1, 0),
])
def test_conversion_interval_is_left_closed(spark, cost, target, click, want):
    t = "cost double, target double, click bigint"
    assert one(spark, b.conversion_interval(C("cost"), C("target"), C("click")), t, cost, target, click) == want


def test_interval_thresholds(spark):
    def at(i, table, **kw):
        return one(spark, b.interval_threshold(C("i"), table, C("ind"), **kw), "i int, ind string", i, "education")

    assert [at(i, b.AD_THRESHOLDS) for i in range(7)] == [0.0, 999999.99, 1.0, 0.6, 0.2, 0.1, 0.0]
    assert [at(i, b.ADVERTISER_THRESHOLDS) for i in (1, 5)] == [0.1, 999999.99]
    assert at(2, b.AD_THRESHOLDS, overrides={"education": b.EDUCATION_AD_THRESHOLDS}) == 999999.99


@pytest.mark.parametrize("bias,want", [(0.2, 0), (0.19, 1), (0.0, 1), (-0.1, 0), (None, None)])
def test_success_is_strict(spark, bias, want):
    assert one(spark, b.success(F.lit(0.2), C("x")), "x double", bias) == want


def test_cost_bias_without_cost_is_null(spark):
    t = "g double, c double"
    assert one(spark, b.cost_bias(C("g"), C("c")), t, 5.0, 0.0) is None
    assert one(spark, b.cost_bias(C("g"), C("c")), t, 5.0, 10.0) == 0.5


@pytest.mark.parametrize("conv,cost,target,want", [
    (10, 1.0, 1.0, "below_10_conv"), (11, 1.0, 1.0, "over_10_conv"), (0, 10.0, 1.0, "below_10_conv"), (0, 10.1, 1.0, "over_10_conv"),
])
def test_over_ten_bucket(spark, conv, cost, target, want):
    t = "conv bigint, cost double, target double"
    assert one(spark, b.over_ten_bucket(C("conv"), C("cost"), C("target")), t, conv, cost, target) == want


@pytest.mark.parametrize("goal,c1,c2,cost,want", [
    (0, 10, 99, 0.0, "转化大于2小于等于10"), (0, 11, 0, 0.0, "转化大于10"), (0, 2, 0, 0.0, "转化小于等于2"),
    (0, 0, 0, 21.0, "转化大于2小于等于10"), (0, 0, 0, 101.0, "转化大于10"), (5, 99, 3, 0.0, "转化大于2小于等于10"),
    (None, 99, 99, 0.0, "转化小于等于2"),
])
def test_sql_conversion_bucket(spark, goal, c1, c2, cost, want):
    bucket = b.conversion_bucket(C("g"), (C("c1"), C("c2")), C("cost"), (C("t1"), C("t2")), C("click"), 10, 2)
    t = "g int, c1 bigint, c2 bigint, cost double, t1 bigint, t2 bigint, click bigint"
    assert one(spark, bucket, t, goal, c1, c2, cost, 100, 100, 10) == want


@pytest.mark.parametrize("pred,conv,want", [
    (5.0, 0, "偏差大于20"), (13.0, 10, "偏差大于20"), (11.5, 10, "偏差大于10小于等于20"), (10.5, 10, "偏差小于等于10"),
    (None, 10, "偏差小于等于10"),
])
def test_bias_bucket(spark, pred, conv, want):
    assert one(spark, b.bias_bucket([(F.lit(True), C("p"), C("c"))]), "p double, c bigint", pred, conv) == want


@pytest.mark.parametrize("value,kept", [(0, True), (None, True), (1, False)])
def test_compensation_filter(spark, value, kept):
    df = spark.createDataFrame([(value,)], "no_compensation_type int")
    assert (df.where(p.uncompensated()).count() == 1) is kept


def test_channels(spark):
    df = spark.createDataFrame([(21,), (3,)], "site_set int")
    assert [r[0] for r in df.where(p.on_channel("mp")).collect()] == [21]
    assert [r[0] for r in df.where(p.on_channel("gdt")).collect()] == [3]
    with pytest.raises(ValueError):
        p.on_channel("other")


@pytest.mark.parametrize("day,n,want", [(20210301, -1, 20210228), (20211231, 1, 20220101), (20200228, 1, 20200229)])
def test_days_cross_months_and_years(spark, day, n, want):
    assert one(spark, dates.add_days(C("d"), n), "d int", day) == want


def test_partition_names(spark):
    t = "s string"
    assert one(spark, dates.next_partition_time(C("s"), 1), t, "20211231") == "20220101"
    assert one(spark, dates.next_partition_time(C("s"), 2), t, "2021123123") == "2022010101"
    with pytest.raises(Exception, match="not supported"):
        one(spark, dates.next_partition_time(C("s"), 1), t, "2021")
