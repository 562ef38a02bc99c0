import functools
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adgrove.llm import packing
from adgrove.llm.packing import best_fill, best_fit, pack, pack_documents, places, reduce, sequences
from adgrove.operators.scratch import Scratch

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
with open(PATH, encoding="utf-8") as f:
    DEFINITION = f.read()


def fewest(sizes, capacity):
    """Exact number of sequences, by trying all."""
    @functools.cache
    def search(left):
        if not left:
            return 0
        first, rest = left[-1], left[:-1]
        best = len(left)
        for mask in range(1 << len(rest)):
            if first + sum(s for i, s in enumerate(rest) if mask >> i & 1) <= capacity:
                best = min(best, 1 + search(tuple(s for i, s in enumerate(rest) if not mask >> i & 1)))
        return best

    return search(tuple(sorted(sizes)))


def tally(sizes, capacity):
    return [sizes.count(s) for s in range(capacity + 1)]


def contents(groups):
    return [[s for s, n in g.content for _ in range(n)] for g in groups for _ in range(g.sequences)]


@given(st.lists(st.integers(1, 14), max_size=9))
@settings(max_examples=400, deadline=None)
def test_fixed_sets_keep_the_optimum(sizes):
    counts = tally(sizes, 14)
    fixed = contents(reduce(counts, 14))
    left = [s for s, n in enumerate(counts) for _ in range(n)]
    assert sorted(sum(fixed, []) + left) == sorted(sizes) and all(sum(c) <= 14 for c in fixed)
    assert len(fixed) + fewest(left, 14) == fewest(sizes, 14)


@pytest.mark.parametrize("sizes, fixed", [
    ([7, 7, 5, 9], 2), ([10, 9, 8], 3), ([8, 4, 1], 1), ([6, 6, 6, 4, 4, 4], 2), ([5, 5, 5, 5, 5, 5, 5, 5], 4),
])
def test_the_rule_fixes_known_sets(sizes, fixed):
    assert sum(g.sequences for g in reduce(tally(sizes, 14), 14)) >= fixed


def plain_best_fit(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fits = [b for b in bins if sum(b) + s <= capacity]
        if fits:
            max(fits, key=sum).append(s)
        else:
            bins.append([s])
    return bins


@given(st.lists(st.integers(1, 30), max_size=60))
@settings(max_examples=200, deadline=None)
def test_groups_are_best_fit_by_falling_length(sizes):
    got, want = contents(best_fit(tally(sizes, 30), 30)), plain_best_fit(sizes, 30)
    assert sorted(map(sum, got)) == sorted(map(sum, want))  # which of equally full sequences is taken is open


@given(st.lists(st.integers(1, 40), max_size=12), st.integers(0, 40))
def test_best_fill(sizes, room):
    sums = {0}
    for s in sizes:
        sums |= {t + s for t in sums if t + s <= room}
    assert best_fill(tally(sizes, 40), room) == max(sums)


@pytest.mark.parametrize("seed", range(6))
def test_large_counts_pack_near_the_bound(seed):
    rng = random.Random(seed)
    counts = [0, *[rng.randint(0, 10 ** 6) if seed % 2 else int(rng.paretovariate(.5)) * 1000 for _ in range(1024)]]
    groups = pack(counts, 1024)
    have = [0] * 1025
    for g in groups:
        assert sum(s * n for s, n in g.content) <= 1024
        for s, n in g.content:
            have[s] += n * g.sequences
    assert have == counts and len(groups) < 8 * 1024  # groups follow the capacity, not the pieces
    bound = max(-(-sum(s * n for s, n in enumerate(counts)) // 1024), sum(counts[513:]) + -(-counts[512] // 2))
    if seed % 2:
        assert sum(g.sequences for g in groups) <= bound * 1.01 + 1


@given(st.lists(st.integers(1, 30), min_size=1, max_size=50))
@settings(max_examples=100, deadline=None)
def test_places_are_gapless(sizes):
    plan, seen, got = places(pack(tally(sizes, 30), 30)), {}, {}
    for s in sizes:
        n = seen[s] = seen.get(s, -1) + 1
        q, at = plan.find(np.array([s]), np.array([n]))
        got.setdefault(int(q[0]), []).append((int(at[0]), s))
    for spans in got.values():
        at = 0
        for start, size in sorted(spans):
            assert start == at
            at += size
        assert at <= 30


def whole(rows, got, capacity, end):
    """Pieces against the tokenizer, one document at a time; sequences without gaps."""
    plain, want = Tokenizer.from_file(PATH), []
    for d, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, end]
        cut = len(ids) % capacity or capacity
        cuts = [0, *range(cut, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                 for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    assert sorted((tuple(r)[:1] + (r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for start, size in sorted(spans):
            assert start == at
            at += size
        assert at <= capacity
    sizes = [w[3] for w in want]
    assert len(places) <= -(-sum(sizes) // capacity) * 1.02 + 1 or len(places) <= len(plain_best_fit(sizes, capacity))


def test_documents_and_their_sequences(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(("old", "king", "né", "x1,")) for _ in range(rng.randint(0, 40)))) for i in range(150)]
    rows += [(200, None), (None, "no id"), (None, None), (90, ""), (5, "again"), (5, "again"), (300, "z " * 500), (301, "a <|endoftext|>")]
    docs = spark.createDataFrame([(7, *r, "s") for r in rows], "length int, doc_id bigint, text string, part string").repartition(5)
    packed = pack_documents(docs, DEFINITION, Scratch(spark), capacity=32).cache()
    got = packed.collect()
    whole(rows, got, 32, 2)
    ids = {(r.sequence_id, r.offset): r.ids for r in got}
    for r in sequences(packed).collect():
        assert r.ids == b"".join(v for (q, _), v in sorted(ids.items()) if q == r.sequence_id)
        assert sum(r.lengths) * 4 == len(r.ids) <= 128 and len(r.doc_ids) == len(r.lengths)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert pack_documents(docs, DEFINITION, Scratch(spark)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    whole(rows, packing.query(spark, SF).collect(), 1024, 2)
