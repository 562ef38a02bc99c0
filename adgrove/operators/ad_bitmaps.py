"""Distinct ads as bitmaps: one stored aggregate whose counts merge over days, industries, brands and buckets.

Ads get dense numbers, those of one brand next to each other, so the ads of a group fill few bitmaps of 32,768 bits. A
roll-up joins bitmaps by OR and counts bits; it never sees an ad again. The stand-in 0 of all ads without cost is a
number like any other, so it adds one to a group's count, as a distinct count does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adgrove.operators.numbering import number_rows
from adgrove.operators.scratch import Scratch
from adgrove.operators.skew import join_spread


def ad_bitmaps(rows: DataFrame, keys: Sequence[str], ad: str, near: str, scratch: Scratch) -> DataFrame:
    """(keys, block, bits) of the distinct values of ``ad`` in each finest group, written once.

    ``near`` is the column by which ads are numbered, together with the ad itself. NULL ads are not counted; a group that has
    no others keeps a row without bits.
    """
    slim, seen = scratch.cut(rows.select(*keys, F.col(ad).alias("_ad"), F.col(near).alias("_near")), rows=F.count(F.lit(1)))
    each = slim.where("_ad is not null").groupBy("_ad").agg(F.min("_near").alias("_first"), F.count(F.lit(1)).alias("weight"))
    each, _ = scratch.cut(each)
    numbers = number_rows(each, ["_first", "_ad"], "_n", scratch).select("_ad", "weight", (F.col("_n") + 1).alias("_n"))
    placed = join_spread(slim.where("_ad is not null").drop("_near"), numbers, ["_ad"], "weight", max(1, seen["rows"]))
    filled = placed.groupBy(*keys, F.bitmap_bucket_number("_n").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits")
    )
    without = slim.groupBy(*keys).agg(F.count("_ad").alias("_known")).where("_known = 0").drop("_known")
    none = without.withColumns({"block": F.lit(None).cast("bigint"), "bits": F.lit(None).cast("binary")})
    stored, _ = scratch.cut(filled.unionByName(none))
    return stored


def distinct_ads(bitmaps: DataFrame, keys: Sequence[str], name: str = "ad_num") -> DataFrame:
    """Distinct ads for each combination of ``keys``, which are any of the aggregate's."""
    joined = bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg(F.coalesce("bits", F.lit(bytes(4096)))).alias("bits"))
    return joined.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
