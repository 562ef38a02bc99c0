"""Daily jobs: everything a day's run publishes, from one shared ad detail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from adgrove.operators.scratch import Scratch
from adgrove.plans import history, new_reach

REPORTS = ("industry", "industry_bucket", "sub_brand")


def new_reach_day(
    fact: DataFrame, accounts: DataFrame, generation: int = 1, channel: str = "gdt",
    first_day: int | None = None, last_day: int | None = None,
    reports: Sequence[str] = REPORTS, sub_brands: Sequence[str] = ("",),
) -> dict[str, DataFrame]:
    """Chosen new-definition reports by table name (and ``detail``), for one day or a backfill of many.

    The ad detail is written once to the shared folder and every report reads it from there.
    """
    if generation == 1:
        ads = new_reach.ad_rows_gen1(fact, accounts, first_day, last_day)
    else:
        ads = new_reach.ad_rows_gen2(fact, accounts, channel, first_day, last_day)
    detail, _ = Scratch(fact.sparkSession).cut(new_reach.ad_detail(ads, generation))
    build = {
        "industry": lambda: new_reach.industry_report(detail, generation),
        "industry_bucket": lambda: new_reach.bucket_report(detail, generation),
        "sub_brand": lambda: new_reach.sub_brand_report(detail, generation, sub_brands, ordered=True),
        "sub_brand_bucket": lambda: new_reach.sub_brand_report(detail, generation, sub_brands, by_bucket=True, ordered=True),
    }
    return {"detail": detail, **{name: build[name]() for name in reports}}


def history_day(
    fact: DataFrame, accounts: DataFrame, generation: int = 1, channel: str = "gdt",
    first_day: int | None = None, last_day: int | None = None,
) -> DataFrame:
    """Both history tables (retrospective and same day) of a day or range, in publication column order."""
    both = history.both_histories(fact, accounts, generation, channel, first_day, last_day)
    return both.select(*history.HISTORY_COLUMNS)
