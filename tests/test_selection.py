import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from adgrove.operators.scratch import Scratch
from adgrove.operators.selection import ordered, restored, select_ranks, smallest


@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=20))
def test_keys_keep_the_order_of_doubles(values):
    keys = ordered(np.array(values, np.float64))
    assert [v for _, v in sorted(zip(keys.tolist(), values), key=lambda p: p[0])] == sorted(values)
    assert [restored(k, False) for k in keys.tolist()] == values


@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1), min_size=2, max_size=20))
def test_keys_keep_the_order_of_integers(values):
    keys = ordered(np.array(values, np.int64))
    assert [restored(k, True) for k in sorted(keys.tolist())] == sorted(values)


@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_ranks_and_heads(spark, kind):
    rng = random.Random(3)
    draw = (lambda: rng.choice([rng.gauss(0, 1e9), rng.random(), 0.25, -0.0])) if kind == "double" else (
        lambda: rng.choice([rng.getrandbits(63), -rng.getrandbits(40), 7]))
    rows = [(rng.randrange(3), draw(), i) for i in range(600)] + [(0, None, 900)]
    df = spark.createDataFrame(rows, f"g int, v {kind}, i bigint").repartition(5)
    targets = [(g, r) for g in (0, 1, 2, 9) for r in (0, 1, 50, 149, 5000)]
    found = select_ranks(df, "g", "v", targets)
    for (g, r), v in found.items():
        own = sorted(x for k, x, _ in rows if k == g and x is not None)
        assert v == (own[r] if r < len(own) else None)
    head = {r.g: [(x.v, x.i) for x in r.rows] for r in smallest(df.where("v is not null"), "g", ["v", "i"], 20).collect()}
    for g in range(3):
        assert head[g] == sorted((x, i) for k, x, i in rows if k == g and x is not None)[:20]


def test_counts_move_and_no_row_does(spark):
    df, _ = Scratch(spark).cut(spark.range(1000).selectExpr("0 as g", "id as v"))
    assert select_ranks(df, "g", "v", [(0, 999), (0, 500)]) == {(0, 999): 999, (0, 500): 500}
    assert select_ranks(df.limit(0), "g", "v", [(0, 0)]) == {(0, 0): None}
