"""Dates are kept as yyyymmdd integers at the edges and become DATE for arithmetic."""

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_to_date(day: Column) -> Column:
    """yyyymmdd integer -> DATE, by integer arithmetic only."""
    d = day.cast("int")
    return F.make_date(
        F.floor(d / 10000).cast("int"), (F.floor(d / 100) % 100).cast("int"), (d % 100).cast("int")
    )


def date_to_day(date: Column) -> Column:
    """DATE -> yyyymmdd integer."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def add_days(day: Column, n: Column | int) -> Column:
    """yyyymmdd integer shifted by n days (crosses months and years)."""
    return date_to_day(F.date_add(day_to_date(day), n))


def shift_day(day: int, n: int) -> int:
    """yyyymmdd integer shifted by n days, for bounds of a run."""
    return int((datetime.strptime(str(day), "%Y%m%d") + timedelta(days=n)).strftime("%Y%m%d"))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, both yyyymmdd integers."""
    return F.datediff(day_to_date(later), day_to_date(earlier))


def next_partition_time(text: Column, gap: int) -> Column:
    """Partition name shifted by ``gap``: days for yyyymmdd, hours for yyyymmddHH, error otherwise."""
    daily = F.date_format(F.date_add(F.to_date(text, "yyyyMMdd"), gap), "yyyyMMdd")
    hourly = F.date_format(
        F.to_timestamp(text, "yyyyMMddHH") + F.make_dt_interval(hours=F.lit(gap)), "yyyyMMddHH"
    )
    return (
        F.when(F.length(text) == 8, daily)
        .when(F.length(text) == 10, hourly)
        .otherwise(F.raise_error(F.concat(F.lit("time format not supported: "), text)).cast("string"))
    )
