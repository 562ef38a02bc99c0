"""Row filters of the fact and the account snapshot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MP_SITE_SET = 21
RETENTION_GOAL = 106

# Industries as the account snapshot spells them, with their report codes.
INDUSTRY_CODES = {
    "金融": "finance",
    "教育": "education",
    "房产": "property",
    "家居": "furnishing",
    "医药": "medicine",
    "大交通": "car",
    "运营商": "yys",
    "商务服务": "zsfw",
    "招商加盟": "zsjm",
    "旅游": "ly",
    "本地生活": "bdsh",
}
FINANCE = "金融"
MEDICINE = "医药"
LOAN = "贷款"
BUCKET_INDUSTRIES = ("金融", "教育", "家居", "房产", "大交通", "医药")
BULK_INDUSTRIES = ("家居", "房产", "大交通", "医药")


def on_channel(channel: str) -> Column:
    """``mp`` keeps the MP site set, ``gdt`` everything else."""
    if channel not in ("mp", "gdt"):
        raise ValueError(f"channel must be 'mp' or 'gdt', got {channel!r}")
    site = F.col("site_set")
    return site == MP_SITE_SET if channel == "mp" else site != MP_SITE_SET


def uncompensated() -> Column:
    """No compensation: zero or NULL."""
    return F.coalesce(F.col("no_compensation_type"), F.lit(0)) == 0


def not_retention(goal: Column | None = None) -> Column:
    """Second goal other than next-day retention; drops a NULL goal as well."""
    return (F.col("second_goal") if goal is None else goal) != RETENTION_GOAL


def regular_delivery() -> Column:
    """Generation 2 flags: bid-optimised, not a dynamic-product ad, no automatic acquisition."""
    return ~F.col("is_rta_dpa_ad") & F.col("is_ocpx") & (F.col("auto_acquisition_status") == 0)


def in_industries(names: Iterable[str]) -> Column:
    return F.col("industry_group").isin(*names)


def between_days(column: str, first: int | None, last: int | None) -> Column:
    """Inclusive day range on a partition column; open where a bound is None."""
    cond = F.lit(True)
    if first is not None:
        cond = cond & (F.col(column) >= first)
    if last is not None:
        cond = cond & (F.col(column) <= last)
    return cond


def lookup(column: Column, table: dict) -> Column:
    """Small fixed dictionary as a CASE chain; unknown keys give NULL."""
    chain = F
    for key, value in table.items():
        chain = chain.when(column == key, F.lit(value))
    return chain


def industry_lag(industry: Column) -> Column:
    """Days a cohort may still accrue: 2 for finance, 1 for the others, NULL off the list."""
    return lookup(industry, {name: 2 if name == FINANCE else 1 for name in INDUSTRY_CODES})
