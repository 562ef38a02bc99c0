"""Ad-level totals: fact joined with the daily account snapshot, in two aggregation steps.

The fact is summed per (account, day, fact keys) *before* it meets the accounts, so the shuffle and the
join move one row per ad instead of one per delivery record, and an account with a third of all records
shrinks to its ads on the map side. All sums are integers, hence independent of order and of the split.
The join carries no broadcast hint: Spark broadcasts the snapshot only when its measured size allows and
otherwise sort-merges with skew splitting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adgrove.operators.scratch import wide_tasks

#: Column that day tables are bucketed by, for each day column that can meet the snapshot's.
STORED_KEYS = {"partition_date": "account_day", "process_date": "account_cohort"}
ACCOUNT_COLUMNS = {"industry": "industry_group", "sub_industry": "industry_team_level2", "sub_brand": "op_sub_brand"}


def ad_totals(
    fact: DataFrame,
    accounts: DataFrame,
    keep: Column,
    accounts_keep: Column,
    fact_keys: Sequence[str],
    account_keys: Sequence[str],
    sums: dict[str, Column],
    maxes: dict[str, Column] | None = None,
    day: str = "partition_date",
    reshape: Callable[[DataFrame], DataFrame] | None = None,
    extra_keys: Sequence[str] = (),
    drop_keys: Sequence[str] = (),
) -> DataFrame:
    """Sums and maxima per ``fact_keys`` + ``account_keys`` (+ ``extra_keys`` that ``reshape`` adds after the join,
    - ``drop_keys`` that only ``reshape`` needs).

    Where both sides carry the stored key of ``day`` (bucketed day tables), it stands for day and account: aggregation and
    join then take rows where their bucket lies.
    """
    maxes = maxes or {}
    stored = STORED_KEYS.get(day)
    join_keys = [stored] if stored in fact.columns and stored in accounts.columns else [day, "advertiser_id"]
    pre_keys = list(dict.fromkeys([*join_keys, *fact_keys]))
    per_account = (
        fact.where(keep)
        .groupBy(*pre_keys)
        .agg(*[F.sum(c).alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in maxes.items()])
    )
    snapshot = accounts.where(accounts_keep).select(
        *(join_keys if len(join_keys) == 1 else [F.col("imp_date").alias(day), F.col("account_id").alias("advertiser_id")]),
        *[F.col(ACCOUNT_COLUMNS[k]).alias(k) for k in account_keys],
    )
    # Large inputs are dealt over more tasks than the session has for a shuffle. Day tables stay where they lie.
    tasks = None if join_keys == [stored] else wide_tasks(fact)
    if tasks:
        per_account, snapshot = per_account.repartition(tasks, *join_keys), snapshot.repartition(tasks, *join_keys)
    joined = per_account.join(snapshot, join_keys, "inner")
    if reshape is not None:
        joined = reshape(joined)
    keys = [k for k in [*extra_keys, *fact_keys, *account_keys] if k not in drop_keys]
    if tasks and not set(join_keys) <= set(keys):
        joined = joined.repartition(tasks, *keys)
    return joined.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxes]
    )


def delivery_sums() -> dict[str, Column]:
    """Integer measures every classic report needs, by canonical fact column."""
    c = F.col
    return {
        "exposure": c("valid_exposure_cnt"),
        "click": c("valid_click_cnt"),
        "cost_micros": c("real_cost_micros"),
        "conv1": c("conv1"),
        "conv2": c("conv2"),
        "target1": c("target1_click"),
        "target2": c("target2_click"),
        "pcvr1": c("pcvr1"),
        "pcvr2": c("pcvr2"),
        "pctr": c("pctr"),
        "gsp": c("gsp_factor_sum"),
        "gsp_base": F.when(c("bid_type") == 4, c("valid_exposure_cnt")).otherwise(c("valid_click_cnt")),
        "gsp_exposure": c("gsp_exposure_factor"),
        "gsp_exposure_cnt": c("gsp_exposure_cnt"),
    }


def gmv_by_goal() -> dict[str, Column]:
    """Generation 1 GMV in cents, per goal."""
    return {"gmv1": F.col("gmv"), "gmv2": F.col("second_gmv")}


def gmv_delivered() -> dict[str, Column]:
    """Generation 2 GMV in micros, already of the chosen goal."""
    return {"gmv_micros": F.col("gmv_exp_d")}


def volume_first() -> dict[str, Column]:
    return {"use_amount_first": F.when(F.col("bid_strategy") == 2, 1).otherwise(0)}


def second_phase() -> dict[str, Column]:
    return {"double_phase": F.when(F.col("deep_stage_status") == 2, 1).otherwise(0)}
