import random

import numpy as np
import pyarrow as pa
import pytest
from brute import WORD

from adgrove.llm.words import Hasher, inside, split_words, steps, text_bytes


@pytest.mark.parametrize("seed", range(5))
def test_words_are_those_of_the_pattern(seed):
    rng = random.Random(seed)
    texts = [None if rng.random() < 0.1 else "".join(rng.choice("ab é\t\n\x1c\x0b ") for _ in range(rng.randint(0, 40)))
             for _ in range(60)]
    for column in (pa.array(texts), pa.array([*texts[:7], *texts]).slice(7), pa.array(texts, pa.large_string())):
        data, at = text_bytes(column)
        got = []
        for low, high in steps(at, 50):
            w = split_words(data, at[low:high + 1])
            raw = w.data.tobytes()
            got += [[raw[s:e].decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first, w.first[1:])]
        assert got == [WORD.findall(t or "") for t in texts]


def test_equal_words_and_windows_have_equal_hashes_only():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(("a", "b", "ab", "ba", "aa")) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts.append("x" * 5000 + " " + "x" * 5001)
    data, at = text_bytes(pa.array(texts))
    w = split_words(data, at)
    h = Hasher(0)
    hashes = h.words(w, limit=100)
    assert (hashes == h.words(w)).all()
    words = [x for t in texts for x in t.split()]
    by_hash = {}
    for x, y in zip(words, hashes.tolist()):
        assert by_hash.setdefault(y, x) == x
    assert len(by_hash) == len(set(words))
    for size in (1, 2, 7):
        starts = inside(w.first, size)
        rows = [t.split() for t in texts]
        want = [tuple(r[i:i + size]) for r in rows for i in range(len(r) - size + 1)]
        got = h.windows(hashes, size)[starts].tolist()
        assert len(got) == len(want)
        assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_no_texts():
    data, at = text_bytes(pa.array([], pa.string()))
    assert list(steps(at)) == []
    data, at = text_bytes(pa.array([None, ""], pa.string()))
    w = split_words(data, at)
    assert len(w.start) == 0 and w.first.tolist() == [0, 0, 0]
    assert len(Hasher(0).windows(np.empty(0, np.uint64), 3)) == 0
