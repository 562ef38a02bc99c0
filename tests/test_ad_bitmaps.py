import random

from pyspark.sql import functions as F

from adgrove.operators import skew
from adgrove.operators.ad_bitmaps import ad_bitmaps, distinct_ads
from adgrove.operators.scratch import Scratch
from adgrove.plans import new_reach


def rows(spark, n=1500, seed=2):
    rng = random.Random(seed)
    ads = [rng.getrandbits(50) for _ in range(200)] + [0] * 60
    return spark.createDataFrame(
        [(rng.randrange(3), rng.choice(["x", "y", None]), rng.choice("pq"), rng.choice(ads) if rng.random() > .05 else None) for _ in range(n)],
        "day int, brand string, bucket string, ad bigint",
    )


def test_any_roll_up_equals_its_distinct_count(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 10)
    df = rows(spark).unionByName(spark.createDataFrame([(9, "only", "p", None)], "day int, brand string, bucket string, ad bigint"))
    stored = ad_bitmaps(df, ["day", "brand", "bucket"], "ad", "brand", Scratch(spark))
    for keys in (["day", "brand", "bucket"], ["day"], ["brand"], ["bucket", "day"], ["brand", "bucket"]):
        want = df.groupBy(*keys).agg(F.count_distinct("ad").alias("ad_num"))
        assert sorted(map(repr, distinct_ads(stored, keys).collect())) == sorted(map(repr, want.collect()))


def test_ads_beyond_one_bitmap(spark):
    df = spark.range(100_000).selectExpr("cast(id % 4 as int) as day", "cast(id % 50 as string) as brand", "id * 7919 as ad")
    stored = ad_bitmaps(df, ["day", "brand"], "ad", "brand", Scratch(spark))
    assert stored.select("block").distinct().count() == 4
    assert {r.ad_num for r in distinct_ads(stored, ["day"]).collect()} == {25_000}
    # Ads of a brand lie together: a brand is in one bitmap or two.
    assert stored.groupBy("brand").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] <= 2


def test_days_are_added_to_the_same_counts(spark):
    df = rows(spark)
    stored = ad_bitmaps(df, ["day", "brand", "bucket"], "ad", "brand", Scratch(spark))
    some = stored.where("day < 2")
    want = df.where("day < 2").agg(F.count_distinct("ad")).first()[0]
    assert distinct_ads(some, []).first().ad_num == want


def test_no_rows_and_report_keys(spark):
    empty = rows(spark).limit(0)
    assert distinct_ads(ad_bitmaps(empty, ["day"], "ad", "brand", Scratch(spark)), ["day"]).count() == 0
    assert all(set(k) <= set(new_reach.BITMAP_KEYS) for k in new_reach.ROLLUPS.values())
