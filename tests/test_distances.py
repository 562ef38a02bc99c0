from pyspark.sql import functions as F

import pytest

from adgrove.functions import distance as d
from adgrove.functions import text as tx


def value(spark, expr, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()]).select(expr.alias("v")).first()["v"]


A, B = F.col("a"), F.col("b")


@pytest.mark.parametrize("a,b,want", [(5, 5, 0.0), (4, 5, 1.0), (4, 6, 0.5), (0, 0b1011, 0.75)])
def test_hash_distance_divides_by_length_of_the_xor(spark, a, b, want):
    assert value(spark, d.hash_distance(A, B), a=a, b=b) == want


U = "http://h.com/p/q/r"


@pytest.mark.parametrize("a,b,want", [
    (U, U, -1), (U, "http://h.com/p/q/x", -1), (U, "http://h.com/p/x/y", 1), (U, "http://g.com/p/q/r", 1),
    (U, "plain", 0), ("http://mp.weixin.qq.com/a", "http://mp.weixin.qq.com/b", 0),
])
def test_url_similarity(spark, a, b, want):
    assert value(spark, d.url_similarity(A, B, near=-1), a=a, b=b) == want


@pytest.mark.parametrize("a,b,scale,want", [
    (U, U, 2, -1.0), (U, "http://h.com/p", 2, -1.0), (U, "http://h.com/x/q/r", 2, 0.5), (U, "plain", 2, 0.0),
    (U, "plain", 1, 1.0), (U, "http://g.com", 1, 1.0), (U, "http://h.com/x/q/r", 1, 0.75),
])
def test_url_prefix(spark, a, b, scale, want):
    assert value(spark, d.url_prefix_distance(A, B, scale), a=a, b=b) == want


def test_user_distance_is_one_sided_unless_asked(spark):
    assert value(spark, d.user_distance(A, B), a="0", b="x") == 0
    assert value(spark, d.user_distance(A, B), a="x", b="0") == 1
    assert value(spark, d.user_distance(A, B, symmetric=True), a="x", b="0") == 0
    assert value(spark, d.user_distance(A, B, near=-1), a="x", b="x") == -1


@pytest.mark.parametrize("a,b,want", [("x,y,x", "y,x", 0.0), ("x,y", "y,z", 1 - 1 / 3), ("", "x", 0.0), ("x", "y", 1.0)])
def test_city_distance(spark, a, b, want):
    assert value(spark, d.city_distance(A, B), a=a, b=b) == want


def test_vector_distances(spark):
    v = dict(a=[3.0, -4.0], b=[0.0, 4.0])
    assert value(spark, d.l1_twelfth(A, B), **v) == 11 / 12
    assert value(spark, d.l1_mean(A, B), **v) == 5.5
    assert value(spark, d.l2(A, B), **v) == 73**0.5
    assert value(spark, d.l2_scaled(A, B), **v) == 73**0.5 / 128
    assert value(spark, d.l2_mean_square(A, B), **v) == 36.5
    assert value(spark, d.l2_relative(A, B), **v) == pytest.approx(2 * 73**0.5 / 9)
    assert value(spark, d.cosine_distance(A, B), **v) == pytest.approx(1.8)
    assert value(spark, d.sign_agreement(A, B), **v) == 0.5


def test_cjk_words(spark):
    words = ["贷款", "好", "ab", "贷a", "人工智能"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r.w for r in df.where(F.col("w").rlike(tx.CJK_WORD)).collect()] == ["贷款", "人工智能"]


def test_token_words(spark):
    assert value(spark, tx.token_words(A), a="x,1 y z,2,3 w,", b="") == ["x", "w"]


@pytest.mark.parametrize("labels,want", [
    (["1", "12", "123", "1234"], "1234"), (["1", "12", "123", "0"], "123"), (["1", "12", "123", ""], "123"),
    (["1", "12", "123", "1200"], "123"), (["1", "12", "100", "0"], None), (["1", "12", "", ""], None),
])
def test_label_fallback(spark, labels, want):
    assert value(spark, tx.choose_label(A, 3), a=labels, b="") == want


def test_category_levels(spark):
    base = tx.CATEGORY_OFFSET
    assert value(spark, tx.category_level_one(A), a=base + 21, b=0) == 21
    assert value(spark, tx.category_level_one(A), a=base + 2150, b=0) == 21
    assert value(spark, tx.category_level_one(A, whole=False), a=base + 2150, b=0) == 21.5
    assert value(spark, tx.category_level_two(A), a=base + 2150, b=0) == 2150
