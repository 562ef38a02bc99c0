"""Every registered query of the operators on the smallest driver tables: SQL, or a plain restatement of its contract."""

import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import components, greedy_tiles, repeated, tokens
from tokenizers import Tokenizer

from adgrove.llm.queries import QUERIES
from workload.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("select doc_id, text, lang from documents order by doc_id").fetchall()


def run(spark, name):
    return QUERIES[next(n for n in QUERIES if n.startswith(name))][0](spark, SF).collect()


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_matches_its_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_op1(spark, con, docs):
    items = {i: tokens(t) for i, t in con.execute("select item_id, text from benchmark").fetchall()}
    runs = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in items.items()}
    want = {}
    for d, text, _ in docs:
        a = tokens(text)
        own = {tuple(a[k:k + 5]) for k in range(len(a) - 4)}
        for i, w in items.items():
            if 10 * len(own & runs[i]) >= len(w):
                n = greedy_tiles(a, w, 5)
                if 2 * n >= len(w):
                    want[d, i] = n
    assert {(r.doc_id, r.item_id): r.n_covered for r in run(spark, "op1_")} == want


def test_op2(spark, docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for d, text, _ in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in run(spark, "op2_")) == want


def test_op5(spark, con, docs):
    got = {r.doc_id: r for r in run(spark, "op5_")}
    assert set(got) == {d for d, _, _ in docs}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_op7(spark, docs):
    want = components([d[:2] for d in docs], 4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, "op7_")} == want


def test_op8(spark, docs):
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(spark, "op8_")} == repeated([d[:2] for d in docs])


def test_op9(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in run(spark, "op9_")}
    assert {d: list(r.ids) for d, r in got.items()} == {d: model.encode(t or "") for d, t, _ in docs}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got.values())


def test_op10(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op10_")}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 for d, r in got.items())
    held = [got[d].lang_pred == lang for d, t, lang in docs if got[d].held_out and len(t or "") > 30]
    assert np.mean(held) > 0.95
