import random

import numpy as np
import pytest
from brute import components as brute

from adgrove.llm import neardup


def found(spark, rows, ddl="doc_id bigint, text string, component_id string, kept int", **options):
    got = neardup.components(spark.createDataFrame(rows, ddl).repartition(3), **options).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str)


def corpus(seed, groups, most, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, words))]
        for _ in range(rng.randint(1, most)):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            text = rng.choice((" ", "\n", "\t ")).join(copy)
            rows.append(text.upper() if rng.random() < 0.1 else text)
    ids = rng.sample(range(10 * len(rows)), len(rows))
    return [(i, t, "x", 0) for i, t in zip(ids, rows)]


@pytest.mark.parametrize("seed,words,limit", [(0, 4, 1 << 18), (1, 5, 1 << 18), (2, 4, 600)])
def test_same_as_all_pairs(spark, seed, words, limit):
    rows = corpus(seed, 25, 14)
    want = brute([r[:2] for r in rows], words)
    assert found(spark, rows, words=words, limit=limit) == sorted(((d, *w) for d, w in want.items()), key=str)


def test_a_group_above_the_limit_is_cut_and_stays_whole(spark):
    rows = corpus(7, 1, 1) + [(100_000 + i, t, "", 0) for i, (_, t, _, _) in enumerate(corpus(8, 2, 160))]
    want = brute([r[:2] for r in rows], 4)
    assert found(spark, rows, words=4, limit=2000) == sorted(((d, *w) for d, w in want.items()), key=str)


def test_edge_cases(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, None, "", 0), (2, "", "", 0), (3, " \n", "", 0), (4, "one two", "", 0), (5, "ONE\ttwo", "", 0), (6, text, "", 0),
            (7, text, "", 0), (7, text, "", 0), (None, text, "", 0), (None, None, "", 0), (8, "x " * 50_000, "", 0),
            (9, "two one", "", 0)]
    got = found(spark, rows, words=5)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 6, 6, True),
                          (7, 6, 6, False), (7, 6, 6, False), (None, 6, None, True), (None, 0, None, True), (8, 1, 8, True),
                          (9, 1, 9, True)], key=str)
    assert found(spark, []) == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = np.sort(np.concatenate([both, a])), np.sort(np.concatenate([both, b]))
    sig = neardup.signatures(np.repeat([0, 1], 900), np.concatenate([x, y]), 2)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.12
    few = neardup.signatures(np.array([0, 2]), rng.integers(0, 1 << 63, 2, dtype=np.uint64), 3)
    assert (few[0] == few[0][0]).all() and (few[1] == 0).all()


def test_linked_is_all_pairs_closure():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sets = [np.unique(rng.integers(0, 12, rng.integers(1, 14))).astype(np.uint64) for _ in range(12)]
        first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        root = neardup.linked(first, np.concatenate(sets), 60)
        label = list(range(12))
        for i in range(12):
            for j in range(12):
                n = len(np.intersect1d(sets[i], sets[j]))
                if 100 * n >= 60 * (len(sets[i]) + len(sets[j]) - n):
                    low, high = sorted((label[i], label[j]))
                    label = [low if x == high else x for x in label]
        assert root.tolist() == label
