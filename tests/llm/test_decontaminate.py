import random

import numpy as np
import pytest
from brute import greedy_tiles, tokens

from adgrove.llm import decontaminate
from adgrove.llm.words import Hasher

ITEMS = "item_id bigint, text string, doc_id bigint"


def find(spark, docs, items, **options):
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string, coverage int")
    bench = spark.createDataFrame(items, ITEMS)
    got = decontaminate.find_passages(df, bench, **options).collect()
    clean = decontaminate.without_passages(df, bench, **options)
    assert clean.columns == df.columns
    return got, [tuple(r) for r in clean.collect()]


@pytest.mark.parametrize("seed", range(4))
def test_tiles_are_greedy(seed):
    rng, hasher = random.Random(seed), Hasher(41)
    for _ in range(60):
        a, b = ([rng.randint(1, 3) for _ in range(rng.randint(1, 40))] for _ in range(2))
        least = rng.randint(1, 5)
        spread = np.array([0, 3 << 40, 5 << 41, 7 << 42], np.uint64)
        tiles = decontaminate.tile(spread[a], spread[b], least, hasher)
        used_a, used_b = set(), set()
        for i, j, n in tiles:
            assert n >= least and a[i:i + n] == b[j:j + n]
            assert not used_a & set(range(i, i + n)) and not used_b & set(range(j, j + n))
            used_a |= set(range(i, i + n))
            used_b |= set(range(j, j + n))
        # Nothing of the least length is left unmarked on both sides.
        left = greedy_tiles([x if i not in used_a else -1 for i, x in enumerate(a)],
                            [x if i not in used_b else -2 for i, x in enumerate(b)], least)
        assert left == 0
        if tiles:
            longest = max(n for _, _, n in tiles)
            assert longest == max(k for k in range(1, 41) if any(
                a[i:i + k] == b[j:j + k] and len(a[i:i + k]) == k for i in range(len(a)) for j in range(len(b))))


def test_passages_whole_cut_up_and_rearranged(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice((3, 12, 30, 60)))), 0) for i in range(30)]
    docs = []
    for d in range(150):
        text = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        item = rng.choice(items)[1].split()
        kind = d % 5
        if kind == 1:
            text[len(text) // 2:len(text) // 2] = item
        elif kind == 2:
            cut = len(item) // 2
            text = item[cut:] + text + item[:cut]
        elif kind == 3:
            text = text + item[: len(item) * 2 // 5]
        elif kind == 4:
            text = text + [x if rng.random() > 0.1 else "zz" for x in item]
        docs.append((d, rng.choice((" ", "\n", "*** ")).join(text).title(), "", 0))
    got, clean = find(spark, docs, items)
    want = {}
    for d, t, *_ in docs:
        for i, item, _ in items:
            b = tokens(item)
            n = greedy_tiles(tokens(t), b, min(5, len(b)))
            if 2 * n >= len(b):
                want[d, i] = n
    # Ties between equally long runs may be marked in another order.
    pairs = {(r.doc_id, r.item_id): r.n_covered for r in got}
    assert set(pairs) == set(want) and len(pairs) > 60
    assert sum(pairs[k] != want[k] for k in pairs) <= 2
    for r in got:
        a, b, spans = tokens(docs[r.doc_id][1]), tokens(items[r.item_id][1]), r.tiles
        assert sum(spans[2::3]) == r.n_covered and r.coverage == r.n_covered / len(b)
        assert all(a[i:i + n] == b[j:j + n] for i, j, n in zip(spans[::3], spans[1::3], spans[2::3]))
    assert {c[0] for c in clean} == {d[0] for d in docs} - {p[0] for p in pairs}
    small, _ = find(spark, docs, items, block=100)
    assert {(r.doc_id, r.item_id) for r in small} == set(pairs)


def test_edge_cases(spark):
    item = "alpha beta gamma delta epsilon zeta eta"
    docs = [(1, None, "", 0), (2, "", "", 0), (3, item, "", 0), (3, item, "", 0), (None, item, "", 0), (4, "x " * 60_000 + item, "", 0),
            (5, "Übung MACHT", "", 0), (6, "clean", "", 0)]
    items = [(1, item, 0), (1, item, 0), (2, None, 0), (3, "", 0), (4, "...", 0), (None, item, 0), (5, "übung macht", 0)]
    got, clean = find(spark, docs, items)
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(
        [(3, 1)] * 4 + [(None, 1)] * 2 + [(4, 1)] * 2 + [(5, 5)], key=str)
    assert sorted(c[0] for c in clean) == [1, 2, 6]
    assert find(spark, docs, [])[0] == [] and len(find(spark, docs, [])[1]) == len(docs)
    assert find(spark, [], items) == ([], [])
