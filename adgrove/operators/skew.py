"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000


def join_spread(big: DataFrame, small: DataFrame, on: Sequence[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``big`` with the unique-key table ``small``, whose ``weight`` counts the key's rows in ``big``.

    The weights add up to ``total``, so at most ``HOT_KEYS`` keys hold more than total / HOT_KEYS rows each.
    Those few rows of ``small`` are broadcast, which leaves their rows of ``big`` where they are; all other
    keys are shuffled and none of them is large. ``weight`` is dropped. There is one path for every size.
    """
    on = list(on)
    is_hot = F.col(weight) > total / HOT_KEYS
    hot, cold = small.where(is_hot).drop(weight), small.where(~is_hot).drop(weight)
    kept = big.join(F.broadcast(hot), on)
    moved = big.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return kept.unionByName(moved)
