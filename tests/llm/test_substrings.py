import hashlib
import random

import pytest
from brute import WORD, repeated as brute

from adgrove.llm import substrings


def removed(spark, rows, window, ddl="doc_id bigint, text string, kept string, whole int"):
    df = spark.createDataFrame(rows, ddl).repartition(3)
    return substrings.remove_repeated(df, ["doc_id", "text"], window).collect()


def digest(got):
    return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got}


def test_every_remainder_is_a_difference():
    for period, members in substrings.COVERS.items():
        assert {(a - b) % period for a in members for b in members} == set(range(period))


@pytest.mark.parametrize("seed,window", [(0, 14), (1, 20), (2, 50), (3, 37)])
def test_same_as_all_windows(spark, seed, window):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["é\x1cx"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(window - 3, 3 * window))] for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.1:
            words += ["re", "peat"] * window
        rows.append((i * 3, rng.choice((" ", "\n ")).join(words), "x", 0))
    rows += [(1000 + i, rows[i][1], "x", 0) for i in range(20)]
    rng.shuffle(rows)
    got = removed(spark, rows, window)
    assert digest(got) == brute([r[:2] for r in rows], window)
    assert sum(r.n_removed for r in got) > 1000
    for r in got:
        assert WORD.findall(r.left or "") == r.kept.split(" ") if r.kept else not WORD.findall(r.left)
        if not r.n_removed:
            assert r.left == (r.text or "")


def test_edge_cases(spark):
    text = " ".join(f"x{i}" for i in range(60))
    rows = [(1, None, "", 0), (2, "", "", 0), (3, text, "", 0), (3, text, "", 0), (4, text, "", 0), (None, text, "", 0),
            (5, "a " * 60_000, "", 0), (6, "a " * 55, "", 0), (7, "  " + text, "", 0), (8, text + " tail\n", "", 0)]
    got = removed(spark, rows, 50)
    n = {}
    for r in got:
        assert n.setdefault(r.doc_id, (r.n_words, r.n_removed)) == (r.n_words, r.n_removed)
    assert n == {1: (0, 0), 2: (0, 0), 3: (60, 0), 4: (60, 60), None: (60, 0), 5: (60_000, 0), 6: (55, 55), 7: (60, 60), 8: (61, 60)}
    assert [r.left for r in got if r.doc_id == 8] == ["tail"]
    assert removed(spark, [], 50) == []


def test_short_windows_are_refused(spark):
    with pytest.raises(ValueError):
        removed(spark, [], 5)
