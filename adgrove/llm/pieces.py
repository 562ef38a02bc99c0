"""SentencePiece encoding and decoding as joins and folds over a lattice.

Texts fall apart into units that no piece can cross: runs of letters, and runs of other characters, each with the word
marks before it. Only distinct units are encoded:

1. One pass writes each block of texts as a list of its distinct units, and a file with the texts as numbers into that list.
2. Distinct units of all blocks are cut into all substrings up to the longest piece, joined with the piece table on
   equality, and the edges found are grouped by unit again.
3. A higher-order ``aggregate`` folds each unit's edges. For a unigram model that is Viterbi: the best score that
   reaches each position. For a BPE model scores are merge ranks, whose sums mean nothing; the same edges are then
   folded in rank order, an edge being taken if it joins exactly two neighbours, which gives the merges.
4. Ids go back to the blocks, whose files are read where the numbers are replaced: texts are written once and never shuffled.

Everything that grows with the corpus moves as units of blocks, never as words of texts, so no frequent word makes a
large group: a unit has one row a block, and its blocks are listed together for a bounded number of tasks only.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, delete, map_arrow, setting, table
from adgrove.llm.files import read_all, write_new
from adgrove.llm.substrings import free_shuffles
from adgrove.operators.scratch import Scratch

MARK = "▁"
#: Bytes of text in a block, about.
BLOCK = 24 << 20
#: Characters of the longest unit that is folded; longer ones go to the library itself, which takes them whole.
LONG = 192
#: Most pieces in a table: it is broadcast and part of a plan.
MOST_PIECES = 1 << 20



def unit_patterns(pieces: Sequence[str]) -> list[str]:
    """Ways to cut texts, finest first. A way is right for a table whose every piece is one unit.

    The finest cuts between letters and other characters. Signs like a raised 2 count as letters for ``re``;
    those that stand in pieces are taken out of that class.
    """
    signs = "".join(sorted({c for p in pieces for c in p if c.isnumeric() and not (c.isdecimal() or c.isalpha())}))
    letter, other = rf"[^\W\d_{re.escape(signs)}]", rf"[\W\d_{re.escape(signs)}]"
    return [rf"{MARK}*{letter}+|{MARK}*(?:(?!{MARK}){other})+|{MARK}+", rf"{MARK}*[^{MARK}]+|{MARK}+"]




class Pieces(NamedTuple):
    """A model's pieces as the operator needs them."""

    rows: list[tuple[str, int, float]]  # piece, id, score of normal pieces
    unigram: bool
    units: str
    longest: int
    byte_ids: list[int]  # by byte; empty without byte fallback
    unknown: int
    spelled: list[str]  # hex of each id's text; empty for control ids
    proto: bytes


def load(proto: bytes) -> Pieces:
    """Pieces of a serialised SentencePiece model of type unigram or BPE without a text normaliser."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(proto)
    kind = pb.ModelProto.SentencePiece
    spec, trainer = m.normalizer_spec, m.trainer_spec
    if trainer.model_type not in (pb.TrainerSpec.UNIGRAM, pb.TrainerSpec.BPE):
        raise ValueError("the model is neither unigram nor BPE")
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix \
            or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
        raise ValueError("the model normalises texts in a way that is not supported")
    if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in m.pieces) or len(m.pieces) > MOST_PIECES:
        raise ValueError("user-defined and unused pieces are not supported")
    rows = [(p.piece, i, p.score) for i, p in enumerate(m.pieces) if p.type == kind.NORMAL]
    units = next((u for u in unit_patterns([p for p, _, _ in rows]) if all(re.findall(u, p) == [p] for p, _, _ in rows)), None)
    if units is None:
        raise ValueError("pieces go on after a word mark")
    by_byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == kind.BYTE}
    spelled = []
    for p in m.pieces:
        text = {kind.BYTE: lambda p=p: bytes([int(p.piece[1:-1], 16)]), kind.CONTROL: lambda: b"",
                kind.UNKNOWN: lambda: trainer.unk_surface.encode()}.get(p.type, lambda p=p: p.piece.encode())()
        spelled.append(text.hex().upper())
    return Pieces(rows, trainer.model_type == pb.TrainerSpec.UNIGRAM, units, max(len(p) for p, _, _ in rows),
                  [by_byte[b] for b in range(256)] if trainer.byte_fallback else [], trainer.unk_id, spelled, proto)


class Index(dict):
    """Numbers of units by first use."""

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        return n


def pack_codes(codes: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_codes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


# A unit of a block as one long: task, block of the task, number of the unit.
BLOCK_BITS, NUMBER_BITS = 12, 24
#: Blocks of 4096 tasks are listed together for a unit.
SHARE = BLOCK_BITS + 12
#: Units of a partition whose edges are grouped at once, in a hash table and without a sort.
GROUPED = 50_000

PACKED = "kind int, block bigint, first bigint, units array<string>, path string"
#: Texts of a block, in the file of its row's ``path``.
TEXTS = "doc_ids array<bigint>, counts array<bigint>, crcs array<bigint>, codes binary"


def pack(docs: DataFrame, pieces: Pieces, block_bytes: int, folder: str) -> DataFrame:
    """Blocks of texts: rows with distinct units (from number ``first`` on), a row with the file in ``folder`` of texts as numbers."""
    schema, inner = arrow_schema(PACKED), arrow_schema(TEXTS)
    pattern = pieces.units

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cut = re.compile(pattern)
        task, number = TaskContext.get().partitionId(), 0
        index, size, texts_ = Index(), 0, []

        def row(**values) -> pa.RecordBatch:
            full = {"kind": int("path" in values), "block": (task << BLOCK_BITS) + number, **values}
            return pa.RecordBatch.from_arrays([pa.array([full.get(f.name)], f.type) for f in schema], schema=schema)

        def written() -> Iterator[pa.RecordBatch]:
            if not texts_:
                return
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, inner) as stream:
                for batch in texts_:
                    stream.write_batch(batch)
            yield row(path=write_new(folder, f"block-{(task << BLOCK_BITS) + number}", ".arrow", out.getvalue()))
            names = list(index)
            for low in range(0, len(names), 1 << 15):
                yield row(first=low, units=names[low: low + (1 << 15)])

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                texts = [t or "" for t in some.column("text").to_pylist()]
                cuts = [cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
                counts = [len(c) for c in cuts]
                codes = np.fromiter(map(index.__getitem__, chain.from_iterable(cuts)), np.uint32, sum(counts))
                raw = [t.encode() for t in texts]
                size += sum(map(len, raw))
                values = (some.column("doc_id").to_pylist(), counts, [zlib.crc32(r) for r in raw], pack_codes(codes))
                texts_.append(pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, inner)], schema=inner))
                if size >= block_bytes and number + 1 < 1 << BLOCK_BITS:
                    yield from written()
                    index, size, texts_, number = Index(), 0, [], number + 1
        yield from written()

    return docs.select("doc_id", "text").mapInArrow(run, PACKED)


# A BPE edge as one long, so that edges sort as numbers: rank, start, size, id + 1.
ID_BITS, SIZE_BITS, START_BITS = 21, 6, 8


def edges_of(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, edges): every piece in every unit; a character that is no piece is an edge with id -1 below all others.

    For a unigram model an edge is (start, size, id + 1, score). For BPE it is a long: rank (0 for single characters, which
    the merges begin with), start, size, id + 1.
    """
    lowest = min(s for _, _, s in pieces.rows) - 10.0
    order = {s: r for r, s in enumerate(sorted({-s for _, _, s in pieces.rows}), 1)}
    rows = [(p, i, s, order[-s] if len(p) > 1 else 0) for p, i, s in pieces.rows]
    table_ = units.sparkSession.createDataFrame(rows, "piece string, id int, score double, rank bigint")
    length = F.char_length("unit")
    cut = (
        units.select("unit", F.explode(F.sequence(F.lit(0), length - 1)).alias("start"))
        .select("unit", "start", F.explode(
            F.sequence(F.lit(1), F.least(F.lit(pieces.longest), length - F.col("start")))
        ).alias("size"))
        .select("unit", "start", "size", F.substring("unit", F.col("start") + 1, F.col("size")).alias("piece"))
    )
    found = cut.join(F.broadcast(table_), "piece", "left").where("id is not null or size = 1")
    number = F.coalesce("id", F.lit(-1)) + 1
    if pieces.unigram:
        edge = F.struct("start", "size", number.alias("id"), F.coalesce("score", F.lit(lowest)).alias("score"))
    else:
        edge = F.coalesce("rank", F.lit(0).cast("bigint"))
        for part, bits in ((F.col("start"), START_BITS), (F.col("size"), SIZE_BITS), (number, ID_BITS)):
            edge = edge * F.lit(1 << bits) + part
    return found.groupBy("unit").agg(F.collect_list(edge).alias("edges"))


def viterbi(edges: Column, length: Column) -> tuple[Column, Column]:
    """Back pointers by position (a fold of the edges) and, from column ``_back`` that holds them, the best path.

    Both are packed as ``id * 64 + size`` of a piece.

    Edges are taken by start, so the score at an edge's start is final; of equal paths the first found stays.
    """
    nothing = F.lit(float("-inf"))
    state = F.struct(
        F.transform(F.sequence(F.lit(0), length), lambda i: F.when(i == 0, F.lit(0.0)).otherwise(nothing)).alias("best"),
        F.transform(F.sequence(F.lit(0), length), lambda i: F.lit(0)).alias("back"),
    )

    def put(values: Column, at: Column, value: Column) -> Column:
        return F.transform(values, lambda x, i: F.when(i == at, value).otherwise(x))

    def take(acc: Column, e: Column) -> Column:
        end = e["start"] + e["size"]
        score = F.get(acc["best"], e["start"]) + e["score"]
        return F.when(score > F.get(acc["best"], end), F.struct(
            put(acc["best"], end, score).alias("best"), put(acc["back"], end, e["id"] * 64 + e["size"]).alias("back")
        )).otherwise(acc)

    folded = F.aggregate(F.array_sort(edges), state, take, lambda acc: acc["back"])
    # From the end backwards; a step for each character is enough.
    path = F.aggregate(
        F.sequence(F.lit(1), length),
        F.struct(length.alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, _: F.when(acc["at"] > 0, F.struct(
            (acc["at"] - F.get(F.col("_back"), acc["at"]) % 64).alias("at"),
            F.concat(F.array(F.get(F.col("_back"), acc["at"])), acc["out"]).alias("out"),
        )).otherwise(acc),
        lambda acc: acc["out"],
    )
    return folded, path


def merges(edges: Column, length: Column) -> Column:
    """Pieces of a BPE model in order, packed as ``id * 64 + size``.

    The state holds at each position the piece that starts there, 0 where none does; it begins with single characters.
    Edges come by rank and place. One is taken if a piece starts where it starts, and the next piece ends where it
    ends. No edge can become possible after its turn: a trained piece is built from pieces of better rank.
    """
    def field(e: Column, shift: int, bits: int) -> Column:
        return F.shiftright(e, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

    def parts(e: Column) -> Column:
        size = field(e, ID_BITS, SIZE_BITS)
        return F.struct(
            field(e, ID_BITS + SIZE_BITS, START_BITS).alias("start"), size.alias("size"),
            (field(e, 0, ID_BITS) * 64 + size).alias("piece"),
        )

    ranked = F.transform(F.sort_array(edges), parts)
    single = F.transform(F.slice(ranked, F.lit(1), length), lambda e: e["piece"])

    def take(acc: Column, e: Column) -> Column:
        here = F.get(acc, e["start"]) % 64
        middle = e["start"] + here
        fits = (here > 0) & (here < e["size"]) & (F.get(acc, middle) % 64 + here == e["size"])
        return F.when(fits, F.transform(
            acc, lambda x, i: F.when(i == e["start"], e["piece"]).when(i == middle, F.lit(0)).otherwise(x)
        )).otherwise(acc)

    rest = F.slice(ranked, length + 1, F.size(ranked))
    return F.filter(F.aggregate(rest, single, take), lambda x: x > 0)


def spell(path: Column, unit: Column, pieces: Pieces) -> Column:
    """Ids of packed pieces; a character that is no piece becomes its bytes, or the unknown id."""
    known = F.transform(path, lambda x: F.shiftright(x, 6) - 1)
    if not pieces.byte_ids:
        return F.transform(known, lambda i: F.when(i < 0, F.lit(pieces.unknown)).otherwise(i))
    byte_ids = F.from_json(F.lit(json.dumps(pieces.byte_ids)), "array<int>")
    starts = F.transform(
        F.sequence(F.lit(1), F.size(path)),
        lambda k: F.aggregate(F.slice(path, F.lit(1), k - 1), F.lit(0), lambda a, x: a + x % 64),
    )

    def bytes_at(start: Column) -> Column:
        digits = F.hex(F.encode(F.substring(unit, start + 1, F.lit(1)), "utf-8"))
        return F.transform(
            F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1),
            lambda b: F.get(byte_ids, F.conv(F.substring(digits, 2 * b + 1, F.lit(2)), 16, 10).cast("int")),
        )

    spelled = F.flatten(F.zip_with(
        known, starts, lambda i, s: F.when(i < 0, bytes_at(s)).otherwise(F.array(i))
    ))
    return F.when(F.exists(known, lambda i: i < 0), spelled).otherwise(known)


def _library(proto: bytes):
    """Ids of long units by the library: the unit without its first word mark is a text."""

    def make():
        import sentencepiece

        model, schema = sentencepiece.SentencePieceProcessor(model_proto=proto), arrow_schema("unit string, ids array<int>")

        def ids(unit: str) -> list[int]:
            if unit.startswith(MARK):
                return model.encode(unit[1:].replace(MARK, " ")) if len(unit) > 1 else model.encode(unit)
            # Without a mark in front: behind a character that no piece joins to anything.
            lead = model.encode("\n")
            return model.encode("\n" + unit)[len(lead):]

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            units = batch.column("unit").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("unit"), pa.array([ids(u) for u in units], pa.list_(pa.int32()))], schema=schema
            )

        return step

    return make


def encode_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, ids) of distinct units."""
    length = F.char_length("unit")
    lattice = edges_of(units.where(length <= LONG), pieces)
    if pieces.unigram:
        folded, path = viterbi(F.col("edges"), length)
        paths = lattice.withColumn("_back", folded).select("unit", path.alias("path"))
    else:
        paths = lattice.select("unit", merges(F.col("edges"), length).alias("path"))
    short = paths.select("unit", spell(F.col("path"), F.col("unit"), pieces).alias("ids"))
    long = map_arrow(units.where(length > LONG).select("unit"), _library(pieces.proto), "unit string, ids array<int>")
    return short.unionByName(long)


ANSWERS = "block bigint, numbers binary, sizes binary, ids binary"


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (refs, ids) of a task as a few packed rows for each block."""
    schema, held, count = arrow_schema(ANSWERS), [], 0

    def flush() -> pa.RecordBatch:
        block, number, size, begin, ids = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(block, kind="stable")
        block, number, size, begin = block[order], number[order], size[order], begin[order]
        ends = np.cumsum(size)
        ids = ids[np.repeat(begin - (ends - size), size) + np.arange(ends[-1])]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        at = np.concatenate([[0], ends])
        rows = [(int(block[a]), pack_codes(number[a:b]), pack_codes(size[a:b]), pack_codes(ids[at[a]: at[b]]))
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    base = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        refs, lists = batch.column("refs"), batch.column("ids")
        uses, size = np.diff(refs.offsets.to_numpy()), np.diff(lists.offsets.to_numpy()).astype(np.int64)
        places, ids = (x.flatten().to_numpy(zero_copy_only=False) for x in (refs, lists))
        block, number = places >> NUMBER_BITS, places & ((1 << NUMBER_BITS) - 1)
        begin = base + np.cumsum(size) - size
        held.append((block, number, np.repeat(size, uses), np.repeat(begin, uses), ids))
        base, count = base + len(ids), count + len(block)
        if count >= 1 << 20:
            yield flush()
            held, count, base = [], 0, 0
    if held:
        yield flush()


ENCODED = "doc_id bigint, ids array<int>, text_crc32 bigint"


def _unpack(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Texts of a block with their numbers replaced by ids."""
    schema = arrow_schema(ENCODED)
    number, size, ids = (
        np.concatenate([unpack_codes(x) for x in answers.column(n).to_pylist()] or [np.empty(0, np.uint32)])
        for n in ("numbers", "sizes", "ids")
    )
    size = size.astype(np.int64)
    begin = np.empty(len(number), np.int64)
    length = np.empty(len(number), np.int64)
    begin[number] = np.cumsum(size) - size
    length[number] = size
    made = []
    # One row a block, so one file.
    rows = (r for path in texts.column("path").to_pylist() for b in pa.ipc.open_stream(read_all(path)) for r in b.to_pylist())
    for doc_ids, counts, crcs, codes in (r.values() for r in rows):
        code = unpack_codes(codes)
        n = length[code]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(begin[code] - ends[:-1], n) + np.arange(ends[-1])
        cuts = ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        made.append(pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()),
             pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids[at].astype(np.int32))),
             pa.array(crcs, pa.int64())], names=schema.names,
        ))
    return pa.Table.from_batches(made).cast(schema) if made else schema.empty_table()


def encode(docs: DataFrame, pieces: Pieces, scratch: Scratch | None = None, block_bytes: int = BLOCK) -> DataFrame:
    """(doc_id, ids, text_crc32) of every row of ``docs`` (doc_id, text).

    Ids are those that the SentencePiece library gives for the model; NULL and empty texts have none. Every row is
    encoded on its own, so repeated rows and ids repeat their result. ``text_crc32`` is that of the text in UTF-8.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    path = f"{scratch.folder}/packed"
    pack(docs, pieces, block_bytes, f"{scratch.folder}/texts").write.partitionBy("kind").parquet(path)
    packed = spark.read.schema(PACKED).parquet(path)
    listed = (
        packed.where("kind = 0")
        .select("block", "first", F.posexplode("units").alias("at", "unit"))
        .select("unit", (F.shiftleft("block", NUMBER_BITS) + F.col("first") + F.col("at")).alias("ref"))
        .repartition("unit")
        .groupBy("unit", F.shiftright("ref", SHARE + NUMBER_BITS).alias("share")).agg(F.collect_list("ref").alias("refs"))
        .select("unit", "refs")
    )
    schema = listed.schema
    listed.write.parquet(f"{scratch.folder}/listed")
    listed = spark.read.schema(schema).parquet(f"{scratch.folder}/listed")
    delete(spark, f"{path}/kind=0")
    free_shuffles(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-listed.count() // GROUPED))
    # Again: what the first call found in use may be done with now.
    free_shuffles(spark)
    encoded = encode_units(listed.select("unit").distinct(), pieces)
    found = listed.hint("merge").join(encoded, "unit").select("refs", "ids")
    # One partitioning by unit, of bounded parts, carries the lattice and both sides of the join.
    with setting(spark, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", 4 * GROUPED), \
            setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"), \
            setting(spark, "spark.sql.shuffle.partitions", parts):
        answers, _ = scratch.cut(found.mapInArrow(_collect, ANSWERS))
    delete(spark, f"{scratch.folder}/listed")
    free_shuffles(spark)
    texts = packed.where("kind = 1").select("block", "path")
    out = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_unpack, ENCODED)
    if pieces.byte_ids:
        return out
    # Unknown characters next to each other are one unknown piece.
    once = F.filter("ids", lambda x, i: (x != pieces.unknown) | (i == 0) | (F.get("ids", i - 1) != pieces.unknown))
    return out.withColumn("ids", once)


def decode(encoded: DataFrame, pieces: Pieces, name: str = "text", ids: str = "ids") -> DataFrame:
    """``encoded`` with column ``name``: the text that ids spell; ids outside the table spell nothing, NULL gives NULL.

    Word marks become spaces, the first one, which encoding adds, goes. Control ids are empty. Only texts with bytes
    of other than ASCII characters are put together byte by byte.
    """
    raw = [bytes.fromhex(h) for h in pieces.spelled]
    # A zero character stands for a lone byte of a longer character.
    plain = F.from_json(F.lit(json.dumps([r.decode("utf-8", "replace").replace("\ufffd", "\0") for r in raw])), "array<string>")
    digits = F.from_json(F.lit(json.dumps(pieces.spelled)), "array<string>")

    def joined(table_: Column) -> Column:
        return F.array_join(F.transform(F.col(ids), lambda i: F.get(table_, i)), "")

    out = encoded.withColumn(name, joined(plain))
    exact = F.when(F.instr(F.col(name), "\0") > 0, F.unhex(joined(digits)).cast("string")).otherwise(F.col(name))
    out = out.withColumn(name, F.translate(exact, MARK, " "))
    rest = F.substring(F.col(name), 2, F.lit(2147483647))
    return out.withColumn(name, F.when(F.startswith(F.col(name), F.lit(" ")), rest).otherwise(F.col(name)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and whether they spell the document's text again."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        pieces = load(f.read())
    out = decode(encode(table(spark, sf_dir, "documents"), pieces), pieces)
    again = F.crc32(F.col("text").cast("binary"))
    return out.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", (again == F.col("text_crc32")).alias("round_trip")
    )
