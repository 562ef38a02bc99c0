import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from adgrove.llm import alignment
from adgrove.llm.alignment import Blocks, Fragment, Units, add_up, align, compose, link_counts, links, ranges
from adgrove.llm.tokens import byte_letters
from adgrove.operators.scratch import Scratch

SF = "/root/testdata/sf0.001"
with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
    DEFINITION = f.read()
with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    PROTO = f.read()

ODD = ["", " ", "  a", "a  b ", "\n\n a\tb", "don't <|endoftext|> <s> </s> <0x41> <unk>", "naïve ʼn 中文 字、、", "a▁b c", "▁",
       "x" * 700, "ab\0cd", "🙂🙂 🙂", "　a 　 b", "é é", "a\x1c b", "1234567 89", "    indented", "tail ", "\r\n"]


def brute(rows):
    """Contract, one document at a time: {position: (figures..., digest, groups)}."""
    a, b = Tokenizer.from_str(DEFINITION), SentencePieceProcessor(model_proto=PROTO)
    a.encode_special_tokens = True
    back = {c: n for n, c in byte_letters().items()}
    bytes_a = {i: bytes(back[c] for c in t) for t, i in a.get_vocab().items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs, held = [], defaultdict(set)
    for k, (_, text) in enumerate(rows):
        groups, raw = [], (" " + (text or "")).encode()
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        u, v = [bytes_a[i] for i in x], [piece(i) for i in y]
        if b"".join(u) == raw == b"".join(v):
            at_u, at_v = np.cumsum([len(t) for t in u]), np.cumsum([len(t) for t in v])
            i = j = 0
            for place in sorted(set(at_u.tolist()) & set(at_v.tolist())):
                i2, j2 = np.searchsorted(at_u, place) + 1, np.searchsorted(at_v, place) + 1
                groups.append((x[i:i2], y[j:j2]))
                i, j = i2, j2
        docs.append(groups)
        for g in groups:
            for i in g[0]:
                for j in g[1]:
                    held[i, j].add(k)
    count = {p: len(d) for p, d in held.items()}
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for (doc_id, _), groups in zip(rows, docs):
        pairs = [(i, j) for g in groups for i in g[0] for j in g[1]]
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        out.append((doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(pairs),
                    sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs),
                    hashlib.sha256(text.encode()).hexdigest() if text else "", text))
    return out, count


def texts(seed, n):
    rng = random.Random(seed)
    words = ["old", "king", "né", "x1,", "straße", "don't", "\n", "unbelievably", "中文", " ", "12345", "\t", "🙂", "re-enter", "été."]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_documents_in_one_range(spark):
    rows = [(i, t) for i, t in enumerate(ODD + texts(1, 40))] + [(None, "no id"), (3, "again"), (3, "again"), (77, None)]
    docs = spark.createDataFrame([("z", *r, 1) for r in rows], "groups string, doc_id bigint, text string, block int").repartition(3)
    want, _ = brute(rows)
    assert sorted(map(tuple, align(docs, DEFINITION, PROTO, Scratch(spark)).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("size", [5, 64])
def test_documents_in_many_ranges(spark, size):
    rows = [(i, t) for i, t in enumerate(ODD + texts(2, 12))] + [(900, "a" * 300 + " b"), (None, "ab " * 200), (None, "ab " * 200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want, _ = brute(rows)
    got = align(docs, DEFINITION, PROTO, Scratch(spark), chunk=size)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def same(f, g):
    f, g = [h._replace(**dict(zip(("codes", "times"), add_up(h.codes, h.times)))) for h in (f, g)]
    return all(np.array_equal(x, y) for x, y in zip(f, g))


def test_fragments_are_a_monoid():
    units, rng = Units(DEFINITION, PROTO), random.Random(4)
    for text in [*ODD[1:], *texts(3, 15)]:
        whole = next(units.whole([text]))
        for size in (1, 3, 11):
            parts = [units.between(*r) for r in ranges(text, size)]
            assert any(len(f.pre_a) for f in parts) or len(parts) < 4
            flat = compose([Fragment(mark=True), *parts])
            if whole.valid:
                assert same(flat, whole)
            else:
                assert not flat.valid
                continue
            while len(parts) > 1:  # any bracketing, neutral elements anywhere
                k = rng.randrange(len(parts) - 1)
                parts[k: k + 2] = [compose([Fragment(), *parts[k: k + 2]])]
            assert same(compose([Fragment(mark=True), Fragment(), parts[0], Fragment()]), whole)


def test_a_unit_is_read_by_two_ranges_at_most():
    text = "a " * 20 + "y" * 500 + " b" * 30
    parts = list(ranges(text, 16))
    assert sum("y" in p for p, _, _ in parts) <= 2
    assert max(len(p) for p, _, _ in parts if "y" not in p) < 40


def test_links_of_wide_groups(monkeypatch):
    a, b = np.array([1, 2, 1, 7, 7]), np.array([5, 5, 6, 9])
    ga, gb = np.array([0, 0, 0, 1, 1]), np.array([0, 0, 0, 1])
    want = Counter((int(g), (int(x) << 32) + int(y)) for x, g in zip(a, ga) for y, h in zip(b, gb) if g == h)
    for limit in (0, 3, 100):
        monkeypatch.setattr(alignment, "WIDE", limit)
        got = Counter()
        for g, c, n in links(a, b, ga, gb):
            for key, times in zip(zip(g.tolist(), c.tolist()), n.tolist()):
                got[key] += times
        assert got == want


def test_counts_over_blocks(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts(5, 30))]
    want, count = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)

    def small(keep_groups, plain=Blocks):
        blocks = plain(keep_groups)
        blocks.add = lambda doc_id, f: (yield from [*plain.add(blocks, doc_id, f), *blocks.flush()])
        return blocks

    monkeypatch.setattr(alignment, "Blocks", small)  # a block for each document
    finished, _ = Scratch(spark).cut(alignment.finish_short(docs, DEFINITION, PROTO, False))
    assert finished.where("listed").count() == len(rows)
    assert {(r.a, r.b): r.docs for r in link_counts(finished).collect()} == count


def test_worker_forgets_units(monkeypatch):
    units = Units(DEFINITION, PROTO)
    before = list(units.whole(texts(6, 5)))
    monkeypatch.setattr(alignment, "REMEMBER", 3)
    assert units.full()
    units.forget()
    assert not units.full() and all(same(f, g) for f, g in zip(before, units.whole(texts(6, 5))))


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert align(docs, DEFINITION, PROTO, Scratch(spark)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want, _ = brute(rows)
    assert sorted(map(tuple, alignment.query(spark, SF).collect())) == sorted(w[:-1] for w in want)
