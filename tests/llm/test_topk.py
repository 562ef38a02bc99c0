import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adgrove.llm import topk


def brute(rows, k, every):
    ok = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ok.setdefault(i, set()).add(tuple(int(np.floor(64 * np.float64(np.float32(x)))) for x in v))
    out = []
    flat = [(i, v) for i, vs in ok.items() for v in vs]
    for q in sorted({i for i, _ in flat if i % every == 0}):
        found = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for a in ok[q] for i, b in flat if i != q and len(a) == len(b)
        )
        out += [(q, r, i, -s if abs(s) < 1 << 63 else None) for r, (s, i) in enumerate(found[:k], 1)]
    return out


def search(spark, rows, k=4, every=3, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int, score string")
    got = topk.top_k(df, F.col("vec_id") % every == 0, k=k, **options)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("seed,block", [(0, 1000), (1, 7)])
def test_same_as_all_pairs(spark, seed, block):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 0.3, 8).tolist(), 0, "") for i in range(150)]
    hot = rng.normal(0, 0.4, 8).tolist()
    rows += [(i, hot, 1, "") for i in range(150, 260)]
    rows += [(300, None, 0, ""), (303, [0.1, None] * 4, 0, ""), (306, [float("nan")] + [0.1] * 7, 0, ""),
             (309, [float("inf")] * 8, 0, ""), (312, [], 0, ""), (None, hot, 0, ""), (315, [0.5, -0.5], 0, ""),
             (318, [0.25, 0.5], 0, ""), (321, hot, 0, ""), (321, hot, 0, "")]
    random.Random(seed).shuffle(rows)
    assert search(spark, rows, block=block) == brute(rows, 4, 3)


def test_fewer_candidates_than_asked_and_ties(spark):
    rows = [(3, [0.5, 0.5], 0, ""), (6, [0.5, 0.5], 0, ""), (1, [0.5, 0.5], 0, "")]
    assert search(spark, rows, k=5) == brute(rows, 5, 3) == [(3, 1, 1, 2048), (3, 2, 6, 2048), (6, 1, 1, 2048), (6, 2, 3, 2048)]


def test_no_vectors_and_no_queries(spark):
    assert search(spark, []) == []
    assert search(spark, [(1, [0.5], 0, "")]) == []
    assert search(spark, [(3, [0.5], 0, "")]) == []


def test_bounds_hold():
    rng = np.random.default_rng(5)
    v, q = rng.integers(-40, 40, (500, 16)), rng.integers(-40, 40, (20, 16))
    for bits in (2, 6):
        cells = topk.Cells(v.min(0), v.max(0), bits)
        s, slack, exact = cells.centres(cells.codes(v)) @ q.T, cells.slack(q), v @ q.T
        assert (np.abs(s - exact) <= slack + 1e-9).all()


def test_bounds_hold_where_doubles_round():
    rng = np.random.default_rng(6)
    for most in (1 << 24, 1 << 40, topk.LARGEST):
        v, q = rng.integers(most - 20, most + 1, (300, 64)), rng.integers(most - 20, most + 1, (20, 64))
        q *= rng.choice([-1, 1], q.shape)
        cells = topk.Cells(v.min(0), v.max(0))
        s, slack = cells.centres(cells.codes(v)) @ q.T.astype(float), cells.slack(q.astype(float))
        exact = v.astype(object) @ q.T.astype(object)
        for i in range(len(v)):
            for j in range(len(q)):
                assert int(s[i, j] - slack[j]) <= exact[i, j] <= int(s[i, j] + slack[j]) + 1


@pytest.mark.parametrize("size", [1e6, 3e8, 4e12])
def test_large_components(spark, size):
    rng = np.random.default_rng(7)
    rows = [(i, (size + rng.integers(-5, 6, 6) * size / 1024).tolist(), 0, "") for i in range(60)]
    rows += [(100 + i, rng.normal(0, 1, 6).tolist(), 0, "") for i in range(20)]
    assert search(spark, rows) == brute(rows, 4, 3)


def test_components_beyond_the_limit_are_held(spark):
    rows = [(3, [1e30, 1.0], 0, ""), (1, [3e38, 0.0], 0, ""), (2, [-1e30, 0.0], 0, ""), (4, [0.5, 0.5], 0, "")]
    assert search(spark, rows) == [(3, 1, 1, None), (3, 2, 4, 32 * topk.LARGEST + 32 * 64), (3, 3, 2, None)]


def test_an_id_with_several_vectors_is_one_query_and_no_candidate_of_its_own(spark):
    rows = [(20, [1.0, 0.0], 0, ""), (20, [0.0, 1.0], 0, ""), (1, [0.5, 0.25], 0, ""), (2, [0.25, 0.75], 0, ""),
            (2, [0.5, 0.25], 0, ""), (40, [0.1, 0.1], 0, ""), (40, [0.1, 0.1], 0, "")]
    for block in (1, 1000):
        assert search(spark, rows, k=5, every=20, block=block) == brute(rows, 5, 20)


def test_every_vector_a_candidate(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (1 + rng.normal(0, 1e-3, 4)).tolist(), 0, "") for i in range(400)] + [(401, [1e6, -1e6, 1e6, -1e6], 0, "")]
    assert search(spark, rows, every=50) == brute(rows, 4, 50)
