import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from adgrove.llm import tokens
from adgrove.llm.tokens import Encoder, TokenFile, dump, open_file, pack, read_documents, unpack, write_tokens
from adgrove.operators.scratch import Scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")
with open(PATH, encoding="utf-8") as f:
    DEFINITION = f.read()


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("width", [4, 8, 12, 16, 24])
def test_packing(width):
    v = np.random.default_rng(width).integers(0, 1 << width, 70_001)
    assert (unpack(pack(v, width), width, len(v)) == v).all()
    assert pack(v[:0], width) == b""


@pytest.mark.parametrize("widths", [(12, 4, 8, 8), (4, 4, 8, 16), (16, 16)])
def test_every_token_is_addressable(widths):
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 60_000, 3000), rng.integers(0, 1 << 32, 200), np.arange(1500), [0]]).astype(np.uint32)
    data = dump([7, None, 9], [3000, 0, 1701], ids, widths)
    reads = []

    def fetch(start, n):
        reads.append(n)
        return data[start: start + n]

    f = TokenFile(fetch)
    assert (f.ids() == ids).all()
    assert f.documents()[0] == [7, None, 9] and f.documents()[1].tolist() == [0, 3000, 3000, 4701]
    reads.clear()
    assert [f.token(i) for i in range(len(ids))] == ids.tolist()
    assert max(reads) <= 64
    with pytest.raises(IndexError):
        f.token(len(ids))


def test_empty_file_and_too_large_ids():
    f = TokenFile(lambda s, n, d=dump([], [], np.empty(0, np.uint32)): d[s: s + n])
    assert f.ids().tolist() == [] and f.documents()[0] == []
    with pytest.raises(ValueError):
        dump([1], [1], np.array([1 << 20], np.uint32), (12, 4))


@pytest.mark.parametrize("special", [True, False])
def test_cached_encoding_is_the_tokenizers_own(special, monkeypatch):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = not special
    rng = random.Random(3)
    texts = ["a  b", "  a", "a ", "", " ", None, "\n a \n\nb  \tc", "don't we'll <|endoftext|> x", "naïve Ünï ʼn 中文 字",
             "x" * 50_000 + " y", "Ġ Ġa ġ", "foo\n bar baz", "1 22 a1 b", "a b  c",
             "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|><|endoftext|>", "<|endoftext| >"]
    texts += ["".join(rng.choice("ab \n\t.'s1é中  ") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder = Encoder(DEFINITION, special=special)
    for _ in range(2):
        counts, ids = encoder.encode(pa.array(texts))
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    monkeypatch.setattr(tokens, "REMEMBER", 20)
    encoder = Encoder(DEFINITION, end=0, special=special)
    parts = [encoder.encode(pa.array(texts[low: low + 50], pa.string())) for low in range(0, len(texts), 50)]
    assert np.concatenate([i for _, i in parts]).tolist() == [i for w in want for i in (*w, 0)]
    assert encoder.encode(pa.array([], pa.string()))[1].tolist() == []


def test_files_round_trip(spark, plain):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(("old", "king", "né", "x1,")) for _ in range(rng.randint(0, 60))), 0) for i in range(90)]
    rows += [(200, None, 1), (None, "no id", 2), (90, "", 3), (5, "again", 4), (5, "again", 4), (300, "z " * 40_000, 5), (301, "old <|endoftext|> king", 6)]
    rng.shuffle(rows)
    scratch = Scratch(spark)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tokens int")
    files = write_tokens(docs, f"{scratch.folder}/t", DEFINITION, scratch, task=4000, file=300)
    assert files.count() > 3
    got = [tuple(r) for r in read_documents(files).collect()]
    want, start = [], 0
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    first = files.orderBy("part").first()
    f = open_file(first["path"])
    assert [f.token(i) for i in range(20)] == f.ids()[:20].tolist()


def test_no_documents(spark):
    scratch = Scratch(spark)
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert read_documents(write_tokens(docs, f"{scratch.folder}/t", DEFINITION, scratch)).collect() == []
