"""Interval, threshold and bucket rules as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adgrove.functions.arith import ratio

# Success thresholds per target-conversion interval 1..5.
UNBOUNDED = 999999.99
AD_THRESHOLDS = {1: UNBOUNDED, 2: 1.0, 3: 0.6, 4: 0.2, 5: 0.1}
ADVERTISER_THRESHOLDS = {1: 0.1, 2: 0.1, 3: 0.1, 4: 0.1, 5: UNBOUNDED}
EDUCATION_AD_THRESHOLDS = {1: UNBOUNDED, 2: UNBOUNDED, 3: UNBOUNDED, 4: UNBOUNDED, 5: 0.1}
ACCOUNT_THRESHOLD = 0.1


def conversion_interval(cost: Column, target_cpa: Column, click: Column) -> Column:
    """Left-closed interval number of cost / target: [0,1) 1, [1,3) 2, [3,5) 3, [5,10) 4, from 10 on 5.

    No target, no clicks or a negative quotient give 0.
    """
    r = cost / F.nullif(target_cpa, F.lit(0.0))
    usable = (target_cpa > 0) & (click > 0) & (r >= 0)
    return (
        F.when(~usable, 0)
        .when(r < 1, 1)
        .when(r < 3, 2)
        .when(r < 5, 3)
        .when(r < 10, 4)
        .when(r >= 10, 5)
        .otherwise(0)
    )


def interval_threshold(
    interval: Column,
    thresholds: dict[int, float],
    industry: Column | None = None,
    overrides: dict[str, dict[int, float]] | None = None,
) -> Column:
    """Threshold of an interval, 0.0 for an unknown one.

    ``overrides`` gives single industries their own table. By default there is none: the education
    table exists but the industry name it is keyed by never occurs in the data.
    """

    def lookup(table: dict[int, float]) -> Column:
        out = F.lit(0.0)
        for k, v in table.items():
            out = F.when(interval == k, F.lit(v)).otherwise(out)
        return out

    result = lookup(thresholds)
    for name, table in (overrides or {}).items():
        result = F.when(industry == name, lookup(table)).otherwise(result)
    return result


def cost_bias(gmv: Column, cost: Column) -> Column:
    """|gmv / cost - 1|; NULL without cost."""
    return F.when(cost > 0, F.abs(gmv / F.nullif(cost, F.lit(0.0)) - 1))


def success(threshold: Column, bias: Column) -> Column:
    """1 when 0 <= bias < threshold, else 0 (strict on the right)."""
    return F.when((bias >= 0) & (bias < threshold), 1).when(bias.isNotNull(), 0)


def over_ten_bucket(conversions: Column, cost: Column, target_cpa: Column) -> Column:
    """``over_10_conv`` above 10 conversions or 10 targets of cost, else ``below_10_conv``."""
    return F.when((conversions > 10) | (cost > 10 * target_cpa), "over_10_conv").otherwise("below_10_conv")


def conversion_bucket(
    second_goal: Column,
    conv: tuple[Column, Column],
    cost_cents: Column,
    target: tuple[Column, Column],
    click: Column,
    high: int,
    low: int,
) -> Column:
    """Three labels by conversions of the chosen goal, or by cost against ``k`` targets; high is tested first."""

    def beyond(k: int) -> Column:
        def one(c: Column, t: Column) -> Column:
            return (c > k) | (cost_cents > ratio(k * t, click))

        return ((second_goal == 0) & one(conv[0], target[0])) | ((second_goal > 0) & one(conv[1], target[1]))

    return (
        F.when(beyond(high), f"转化大于{high}")
        .when(beyond(low), f"转化大于{low}小于等于{high}")
        .otherwise(f"转化小于等于{low}")
    )


def bias_bucket(pairs: list[tuple[Column, Column, Column]]) -> Column:
    """Prediction-bias label. ``pairs`` holds (applies, predicted, conversions); no conversions is the worst label."""
    worst, middle, best = "偏差大于20", "偏差大于10小于等于20", "偏差小于等于10"

    def any_of(test) -> Column:
        out = F.lit(False)
        for applies, pred, conv in pairs:
            out = out | (applies & test(pred, conv))
        return out

    def off_by(limit: float):
        return lambda pred, conv: F.abs(ratio(pred, conv) - 1) > limit

    return (
        F.when(any_of(lambda pred, conv: conv == 0), worst)
        .when(any_of(off_by(0.2)), worst)
        .when(any_of(off_by(0.1)), middle)
        .otherwise(best)
    )
