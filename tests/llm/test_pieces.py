import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from adgrove.llm import pieces

with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    PROTO = f.read()


def unigram():
    """The same pieces as a unigram model: scores fall with the rank."""
    m = pb.ModelProto()
    m.ParseFromString(PROTO)
    m.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for i, p in enumerate(m.pieces):
        if p.type == pb.ModelProto.SentencePiece.NORMAL:
            p.score = -1.0 - i / 4096 if len(p.piece) > 1 else -12.0 - i / 4096
    return m.SerializeToString()


def no_bytes():
    m = pb.ModelProto()
    m.ParseFromString(PROTO)
    m.trainer_spec.byte_fallback = False
    del m.pieces[3:259]
    return m.SerializeToString()


def texts():
    rng = random.Random(6)
    words = ["the", "Hello", "naïve", "über", "don't", "x", "1234", "—", "中文字符", "ßtraße", "😀", "foo_bar", "²", "\x00", "co.uk", "▁"]
    out = [None, "", " ", "  ", "a", " a", "a  b   c", "tabs\tand\r\nlines\n\n", "    x = 1;\r\n", "▁▁ ▁a", "x" * 3000, "ab" * 150 + " c",
           "é" * 400, "😀" * 300, "word " * 20_000]
    out += [rng.choice((" ", "  ", "\n")).join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    out += ["".join(rng.choice("abcdefgh'. éü") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    return out


@pytest.mark.parametrize("proto", [PROTO, unigram(), no_bytes()], ids=["bpe", "unigram", "no_bytes"])
def test_ids_are_the_librarys(spark, proto):
    model, library = pieces.load(proto), sentencepiece.SentencePieceProcessor(model_proto=proto)
    rows = [(i if i % 50 else None, t, i) for i, t in enumerate(texts())] + [(3, "repeated row", 0)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = pieces.encode(df, model, block_bytes=3000)
    got = pieces.decode(out, model).collect()
    want = sorted(((d, library.encode(t or "")) for d, t, _ in rows), key=str)
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=str) == want
    back = sorted(((d, library.decode(library.encode(t or ""))) for d, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == back


def test_no_rows_and_odd_ids(spark):
    model = pieces.load(PROTO)
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert pieces.encode(df, model).collect() == []
    df = spark.createDataFrame([(None,), ([],), ([1, 2, 10 ** 6],)], "ids array<int>")
    assert [r["text"] for r in pieces.decode(df, model).collect()] == [None, "", ""]


def test_models_that_are_not_supported():
    m = pb.ModelProto()
    m.ParseFromString(PROTO)
    m.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.load(m.SerializeToString())
    m.ParseFromString(PROTO)
    m.trainer_spec.model_type = pb.TrainerSpec.WORD
    with pytest.raises(ValueError):
        pieces.load(m.SerializeToString())


def test_codes_and_units():
    import numpy as np

    codes = np.array([0, 1, 255, 256, 1 << 20, (1 << 32) - 1], np.uint32)
    assert (pieces.unpack_codes(pieces.pack_codes(codes)) == codes).all()
    assert pieces.unpack_codes(pieces.pack_codes(codes[:0])).tolist() == []
    model = pieces.load(PROTO)
    assert model.units == pieces.unit_patterns([p for p, _, _ in model.rows])[0]


def test_texts_of_blocks_are_not_shuffled(spark):
    """Of a block's texts only the name of their file goes to the ids; every block's file is read."""
    rows = [(k, f"some words {k} and more of them " * 20) for k in range(600)] + [(600, None), (601, "")]
    model, library = pieces.load(PROTO), sentencepiece.SentencePieceProcessor(model_proto=PROTO)
    out = pieces.encode(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), model, block_bytes=3000)
    moved = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Project" in line or "Scan" in line]
    assert any("path" in line for line in moved) and not any("codes" in line for line in moved)
    assert {r.doc_id: r.ids for r in out.collect()} == {d: library.encode(t or "") for d, t in rows}
