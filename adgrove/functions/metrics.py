"""Per-ad and rolled-up metric formulas. Inputs are integer sums; each metric divides once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adgrove.functions.arith import flag, ratio, total

MICROS = 1_000_000


def by_goal(second_goal: Column, first: Column, second: Column) -> Column:
    """First-goal value when there is no second goal; a NULL goal takes the second."""
    return F.when(second_goal == 0, first).otherwise(second)


def by_goal_strict(second_goal: Column, first: Column, second: Column) -> Column:
    """Goal 0 first value, goal > 1 second value, anything else (1, NULL) zero."""
    return F.when(second_goal == 0, first).when(second_goal > 1, second).otherwise(F.lit(0.0))


def effective_goal(first_goal: Column, second_goal: Column) -> Column:
    return F.when(second_goal > 0, second_goal).otherwise(first_goal)


def cpa_bias(cost_micros: Column, conv: Column, target: Column, click: Column) -> Column:
    """Actual cost per conversion against the click-weighted target, both in cents, minus 1."""
    actual = ratio(cost_micros.cast("double") / 10000, conv)
    return actual / F.nullif(ratio(target, click), F.lit(0.0)) - 1


def tolerance(use_amount_first: Column) -> Column:
    """0.2, or 0.3 for volume-first bidding (exact values, not 0.2 + 0.1 in binary)."""
    return F.when(use_amount_first == 1, F.lit(0.3)).otherwise(F.lit(0.2))


def reached(bias: Column, use_amount_first: Column) -> Column:
    t = tolerance(use_amount_first)
    return flag((bias >= -t) & (bias <= t))


def below(bias: Column, use_amount_first: Column) -> Column:
    return flag(bias <= tolerance(use_amount_first))


def weighted(value: Column, weight: Column) -> Column:
    """Weighted mean as an aggregate of an integer value; value and weight stay per row."""
    return ratio(total(value * weight), total(weight))


def weighted_quotient(value: Column, weight: Column) -> Column:
    """Weighted mean of a fractional value, summed as decimals so the result does not depend on row order."""
    return ratio(F.sum((value * weight).cast("decimal(28,9)")), total(weight))
