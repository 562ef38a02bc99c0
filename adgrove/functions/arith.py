"""NULL-safe arithmetic shared by every metric."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` in DOUBLE; NULL where the divisor is 0 or NULL (ANSI mode would raise)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def total(value: Column) -> Column:
    """Sum of integers as DECIMAL(38, 0): a group of any size neither overflows nor depends on row order."""
    return F.sum(value.cast("decimal(28,0)"))


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
