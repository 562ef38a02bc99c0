"""Tokens of two tokenizers over the same texts, cut into groups where tokens of both end.

A stretch of a document is a fragment: an open prefix up to the first place where tokens of both end, closed groups,
and an open suffix behind the last such place. Fragments compose: the left one's suffix and the right one's prefix
become a group. Composition is associative, so byte ranges of a very long document are taken in any tasks, and a tree
of shuffles puts them together.

Both tokenizers leave a single space between two characters that are not white space at the start of a token, and no
merge crosses it. Texts fall into units there, and a task reads a byte range from the unit that holds its start
to the unit that holds its end. Each distinct unit is tokenised once in a worker.

How many documents link a pair of ids is summed over blocks of documents: a block lists its distinct pairs once, and
the answers come back to the block, so shuffled rows are pairs of blocks and not of documents.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, map_arrow, map_runs, release, table
from adgrove.llm.pieces import load, pack_codes, unpack_codes
from adgrove.llm.tokens import SLICE, Encoder, byte_letters
from adgrove.llm.words import steps, text_bytes
from adgrove.operators.scratch import Scratch

#: Bytes of a document's ranges.
CHUNK = 1 << 16
#: Fragments that one task composes.
FAN = 8
#: Distinct units a worker remembers.
REMEMBER = 1 << 18
#: Entries (a pair of a document) of a block.
BLOCK = 1 << 21
#: Pairs of a group from which equal ids are counted first.
WIDE = 1 << 12

#: Units tokenised at once.
AT_ONCE = 1 << 13

CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space next to a space, or a space at an edge: then not every space is a cut.
ODD = re.compile(r"\s | \s|\A | \Z")
_NONE = np.empty(0, np.int64)


def cut(text: str) -> list[str]:
    """Units of a text, each without the space before it; an empty text has none."""
    if not text:
        return []
    return CUT.split(text) if ODD.search(text) else text.split(" ")


# Tokens with their bytes


class Tokens(NamedTuple):
    """Ids one after the other, their byte lengths, and how many each unit has."""

    ids: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray


class Pair:
    """Both tokenizers; a unit's text is without the space before it, which both see."""

    def __init__(self, definition: str, proto: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.a = Encoder(definition, special=False)
        vocabulary = self.a.plain.get_vocab()
        back = {c: b for b, c in byte_letters().items()}
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(back[c] for c in token)
        self.b = SentencePieceProcessor(model_proto=proto)
        model = pb.ModelProto()
        model.ParseFromString(proto)
        byte = pb.ModelProto.SentencePiece.BYTE
        self.bytes_b = [
            bytes([int(p.piece[3:5], 16)]) if p.type == byte else p.piece.replace("▁", " ").encode() for p in model.pieces
        ]
        self.opens_b = np.array([p.piece.startswith("▁") for p in model.pieces])
        self.size_a = np.array([len(b) for b in self.bytes_a])
        self.size_b = np.array([len(b) for b in self.bytes_b])

    def _pieces(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for B: units without a space or mark inside go to the model side by side, and begin with a mark."""
        inside = [n for n, u in enumerate(units) if " " in u or "▁" in u]
        alone = set(inside)
        at = [n for n in range(len(units)) if n not in alone]
        texts = [" ".join([units[n] for n in at[low: low + 128]]) for low in range(0, len(at), 128)]
        ids = np.fromiter(chain.from_iterable(self.b.encode(texts, num_threads=1)), np.int64)
        first = np.flatnonzero(self.opens_b[ids])
        made = self.b.encode([units[n] for n in inside], num_threads=1)
        order = np.array(at + inside, np.int64)
        found = np.concatenate([np.diff(np.append(first, len(ids))), [len(i) for i in made]]).astype(np.int64)
        size, begin = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        size[order], begin[order] = found, np.cumsum(found) - found
        flat = np.concatenate([ids, np.fromiter(chain.from_iterable(made), np.int64)])
        return size, flat[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(flat))]

    def tokenise(self, units: list[str]) -> tuple[Tokens, Tokens, np.ndarray]:
        """Tokens of both, and whether a unit's bytes come out of either; a unit for which they don't has no tokens."""
        raw = [b" " + u.encode() for u in units]
        length, whole, valid, made = np.fromiter(map(len, raw), np.int64, len(raw)), b"".join(raw), np.ones(len(raw), bool), []
        for (counts, ids), sizes, spelled in (
            (self.a.spaced(units), self.size_a, self.bytes_a), (self._pieces(units), self.size_b, self.bytes_b),
        ):
            ids = ids.astype(np.int64)
            text = [spelled[i] for i in ids.tolist()]
            ends = np.cumsum(counts)
            total = np.concatenate([[0], np.cumsum(sizes[ids])])
            fits = total[ends] - total[ends - counts] == length
            if not fits.all() or b"".join(text) != whole:
                for k, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
                    valid[k] &= b"".join(text[end - n: end]) == raw[k]
            made.append((counts, ids, sizes))
        out = []
        for counts, ids, sizes in made:
            ids = ids[np.repeat(valid, counts)]
            out.append(Tokens(ids, sizes[ids], np.where(valid, counts, 0)))
        return *out, valid


def links(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> Iterator[tuple]:
    """(group, pair codes, occurrences) in parts: all pairs of tokens a, b of one group; groups are sorted numbers from 0 on."""
    groups = int(max(group_a.max(initial=-1), group_b.max(initial=-1))) + 1
    n_a, n_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    wide = n_a * n_b > WIDE
    first_b = np.cumsum(n_b) - n_b
    narrow = ~wide[group_a]
    each = n_b[group_a[narrow]]
    group = np.repeat(group_a[narrow], each)
    at = np.arange(len(group)) - np.repeat(np.cumsum(each) - each, each) + first_b[group]
    yield group, (np.repeat(a[narrow], each) << 32) + b[at], np.ones(len(group), np.int64)
    for g in np.flatnonzero(wide):
        x, times_x = np.unique(a[group_a == g], return_counts=True)
        y, times_y = np.unique(b[group_b == g], return_counts=True)
        for i, n in zip(x.tolist(), times_x.tolist()):
            yield np.full(len(y), g), (i << 32) + y, n * times_y


def add_up(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sums of their occurrences."""
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(times, first) if len(first) else times


def spell(a: np.ndarray, b: np.ndarray) -> bytes:
    """A group as text."""
    return f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))}".encode()


def spell_all(a: Tokens, b: Tokens, group_a: np.ndarray, group_b: np.ndarray, count: int) -> list[bytes]:
    """Groups of each unit as text. Every token is followed by its sign, so one join spells all units."""
    row_a, row_b = np.repeat(np.arange(count), a.counts), np.repeat(np.arange(count), b.counts)

    def changes(values: np.ndarray) -> np.ndarray:
        return np.append(values[1:] != values[:-1], True)[: len(values)]

    signs_a = np.where(changes(group_a), "|", ",")
    signs_b = np.where(changes(row_b), "", np.where(changes(group_b), ";", ","))
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    ids, signs = np.concatenate([a.ids, b.ids])[order], np.concatenate([signs_a, signs_b])[order]
    row = np.concatenate([row_a, row_b])[order]
    text = "".join(chain.from_iterable(zip(map(str, ids.tolist()), np.where(changes(row), "\n", signs).tolist())))
    lines = iter(text.encode().split(b"\n"))
    return [next(lines) if n else b"" for n in a.counts.tolist()]


# Fragments


class Fragment(NamedTuple):
    """A stretch of a document. ``mark``: it has a place where tokens of both end; without one all tokens are prefix."""

    valid: bool = True
    mark: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    pre_a: np.ndarray = _NONE
    pre_b: np.ndarray = _NONE
    suf_a: np.ndarray = _NONE
    suf_b: np.ndarray = _NONE
    groups: bytes = b""
    codes: np.ndarray = _NONE
    times: np.ndarray = _NONE


def closed(a: np.ndarray, b: np.ndarray) -> Fragment:
    """One group with a place on either side; nothing between two equal places."""
    if not len(a) and not len(b):
        return Fragment(mark=True)
    parts = [p[1:] for p in links(a, b, np.zeros(len(a), np.int64), np.zeros(len(b), np.int64))]
    codes, times = add_up(*map(np.concatenate, zip(*parts)))
    return Fragment(True, True, len(a), len(b), 1, len(a) * len(b), groups=spell(a, b), codes=codes, times=times)


def compose(fragments: list[Fragment]) -> Fragment:
    """The fragments one after the other as one; no fragment at all is the neutral element."""
    if not fragments:
        return Fragment()
    pre, open_, inner, mark = ([], []), ([], []), [], False
    for f in fragments:
        side = open_ if mark else pre
        side[0].append(f.pre_a)
        side[1].append(f.pre_b)
        if f.mark:
            if mark:
                inner.append(closed(np.concatenate(open_[0]), np.concatenate(open_[1])))
            inner.append(f)
            open_, mark = ([f.suf_a], [f.suf_b]), True
    join = lambda parts: np.concatenate(parts) if parts else _NONE
    codes, times = add_up(join([f.codes for f in inner]), join([f.times for f in inner]))
    return Fragment(
        all(f.valid for f in fragments), mark, sum(f.n_a for f in fragments), sum(f.n_b for f in fragments),
        sum(f.n_groups for f in inner), sum(f.n_links for f in inner), join(pre[0]), join(pre[1]), join(open_[0]),
        join(open_[1]), b";".join([f.groups for f in inner if f.groups]), codes, times,
    )


def stretch(a: Tokens, b: Tokens, low: int, high: int) -> Fragment:
    """Fragment of the tokens of one unit that end behind byte ``low`` and not behind ``high``."""
    ends, ids = [], []
    for t in (a, b):
        end = np.cumsum(t.sizes)
        inside = (end > low) & (end <= high)
        ends.append(end[inside])
        ids.append(t.ids[inside])
    common = np.intersect1d(*ends)
    if not len(common):
        return Fragment(n_a=len(ids[0]), n_b=len(ids[1]), pre_a=ids[0], pre_b=ids[1])
    parts = [np.split(i, np.searchsorted(e, common, "right")) for i, e in zip(ids, ends)]
    inner = [Fragment(mark=True), *[closed(x, y) for x, y in list(zip(*parts))[1:-1]]]
    out = compose(inner)
    (pre_a, *_, suf_a), (pre_b, *_, suf_b) = parts
    return out._replace(n_a=len(ids[0]), n_b=len(ids[1]), pre_a=pre_a, pre_b=pre_b, suf_a=suf_a, suf_b=suf_b)


class Units(dict):
    """Units by number, each tokenised and cut into groups once. A whole unit begins and ends at a place of both."""

    def __init__(self, definition: str, proto: bytes):
        super().__init__()
        self.pair = Pair(definition, proto)
        self.forget()

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.new.append(unit)
        return n

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.valid, self.spelled = array("b"), []
        #: n_a, n_b, n_groups, n_links of each unit.
        self.figures = [array("q") for _ in range(4)]
        self.first, self.pairs, self.times = array("q", [0]), array("q"), array("q")
        #: Numbers of pair codes.
        self.numbers: dict[int, int] = {}
        self.codes = array("q")

    def full(self) -> bool:
        return len(self) > REMEMBER or len(self.pairs) > 16 * REMEMBER

    def learn(self) -> None:
        """Figures, text and pairs of all new units."""
        for low in range(0, len(self.new), AT_ONCE):
            self._learn(self.new[low: low + AT_ONCE])
        self.new.clear()

    def _learn(self, new: list[str]) -> None:
        count = len(new)
        a, b, valid = self.pair.tokenise(new)
        at_a, at_b = np.cumsum(a.sizes), np.cumsum(b.sizes)  # bytes agree, so one after the other the units do too
        places = np.intersect1d(at_a, at_b)
        group_a, group_b = np.searchsorted(places, at_a), np.searchsorted(places, at_b)
        n_a, n_b = np.bincount(group_a, minlength=len(places)), np.bincount(group_b, minlength=len(places))
        unit = np.empty(len(places), np.int64)
        unit[group_a] = np.repeat(np.arange(count), a.counts)
        n_groups = np.bincount(unit, minlength=count)
        n_links = np.bincount(unit, n_a * n_b, count).astype(np.int64)
        for stored, made in zip(self.figures, (a.counts, b.counts, n_groups, n_links)):
            stored.frombytes(np.ascontiguousarray(made, np.int64).tobytes())
        self.valid.frombytes(valid.astype(np.int8).tobytes())
        self.spelled += spell_all(a, b, group_a, group_b, count)
        parts = list(links(a.ids, b.ids, group_a, group_b))
        group, codes, times = map(np.concatenate, zip(*parts))
        distinct, at = np.unique(codes, return_inverse=True)
        number = np.fromiter(map(self._number, distinct.tolist()), np.int64, len(distinct))
        key, times = add_up((unit[group] << 32) + number[at], times)
        per_unit = np.bincount(key >> 32, minlength=count)
        self.first.frombytes((self.first[-1] + np.cumsum(per_unit)).tobytes())
        self.pairs.frombytes((key & 0xFFFFFFFF).tobytes())
        self.times.frombytes(np.ascontiguousarray(times, np.int64).tobytes())

    def _number(self, code: int) -> int:
        n = self.numbers.setdefault(code, len(self.codes))
        if n == len(self.codes):
            self.codes.append(code)
        return n

    def whole(self, texts: list[str]) -> Iterator[Fragment]:
        """Fragments of texts that begin and end at a place of both tokenizers; an empty text has no tokens."""
        cuts = list(map(cut, texts))
        counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
        units = np.fromiter(map(self.__getitem__, chain.from_iterable(cuts)), np.int64, counts.sum())
        self.learn()
        row = np.repeat(np.arange(len(texts)), counts)
        valid = np.bincount(row, ~np.frombuffer(self.valid, bool)[units], len(texts)) == 0
        sums = [
            np.bincount(row, np.frombuffer(f, np.int64)[units], len(texts)).astype(np.int64).tolist() for f in self.figures
        ]
        key, times = np.unique((row << 32) + units, return_counts=True)
        row, unit = key >> 32, key & 0xFFFFFFFF
        first = np.frombuffer(self.first, np.int64)
        start, size = first[unit], first[unit + 1] - first[unit]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - start, size)
        key = (np.repeat(row, size) << 32) + np.frombuffer(self.pairs, np.int64)[at]
        key, times = add_up(key, np.repeat(times, size) * np.frombuffer(self.times, np.int64)[at])
        codes = np.frombuffer(self.codes, np.int64)[key & 0xFFFFFFFF]
        ends = np.cumsum(np.bincount(key >> 32, minlength=len(texts))).tolist()
        at, spelled = np.concatenate([[0], np.cumsum(counts)]).tolist(), self.spelled
        unit_list = units.tolist()
        for k in range(len(texts)):
            low, high = ends[k - 1] if k else 0, ends[k]
            groups = b";".join([spelled[u] for u in unit_list[at[k]: at[k + 1]]])
            yield Fragment(bool(valid[k]), True, *[s[k] for s in sums], groups=groups, codes=codes[low:high], times=times[low:high])

    def between(self, text: str, low: int, high: int) -> Fragment:
        """Fragment of the tokens that end in bytes ``low`` to ``high`` of ``text``, which consists of whole units.

        Only the first unit can begin before ``low`` and only the last one end behind ``high``.
        """
        units = cut(text)
        sizes = [len(u.encode()) + 1 for u in units]
        total, out = sum(sizes), []
        inner_from, inner_to = int(low > 0), len(units) - int(high < total)
        if low > 0:
            out.append(self._part(units[0], low, min(high, sizes[0])))
        if inner_from < inner_to:
            out += self.whole([" ".join(units[inner_from:inner_to])])
        if high < total and inner_to >= inner_from:
            out += [Fragment(mark=True), self._part(units[-1], 0, high - (total - sizes[-1]))]
        return compose(out)

    def _part(self, unit: str, low: int, high: int) -> Fragment:
        a, b, valid = self.pair.tokenise([unit])
        return stretch(a, b, low, high)._replace(valid=bool(valid[0]))


_SHARED: dict[tuple, Units] = {}


def shared_units(definition: str, proto: bytes) -> Units:
    """The units this worker process knows, for all tasks that follow each other in it."""
    key = (definition, proto)
    if key not in _SHARED:
        _SHARED.clear()
        _SHARED[key] = Units(definition, proto)
    return _SHARED[key]


# Byte ranges of very long documents

CHUNKS = "key bigint, chunk bigint, doc_id bigint, text string, low bigint, high bigint"


def ranges(text: str, size: int) -> Iterator[tuple[str, int, int]]:
    """(text of whole units, low, high) for each byte range: its tokens are those that end behind low and not behind high.

    Ranges end at multiples of ``size``; of several in one unit only the first counts, so a unit is read twice at most.
    """
    units = cut(text)
    starts = np.cumsum([0, *[len(u.encode()) + 1 for u in units]])
    ends = np.arange(size, starts[-1], size)
    inside = np.searchsorted(starts, ends, "right") - 1
    _, first = np.unique(inside, return_index=True)
    cuts = [0, *ends[first].tolist(), int(starts[-1])]
    for low, high in zip(cuts, cuts[1:]):
        i, j = np.searchsorted(starts, [low, high - 1], "right") - 1
        yield " ".join(units[i: j + 1]), low - int(starts[i]), high - int(starts[i])


def chunks(docs: DataFrame, size: int) -> DataFrame:
    """Byte ranges of long documents, dealt out over tasks."""
    schema = arrow_schema(CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("key", "doc_id", "text")]):
                for n, (part, low, high) in enumerate(ranges(text, size)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], f.type) for v, f in zip((key, n, doc_id, part, low, high), schema)], schema=schema
                    )
        release()

    numbered = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    return numbered.mapInArrow(run, CHUNKS).repartition("key", "chunk")


ARRAYS = ("pre_a", "pre_b", "suf_a", "suf_b", "codes", "times")
FRAGMENTS = ("key bigint, chunk bigint, doc_id bigint, valid boolean, mark boolean, n_a bigint, n_b bigint, "
             "n_groups bigint, n_links bigint, pre_a binary, pre_b binary, suf_a binary, suf_b binary, groups binary, "
             "codes binary, times binary")


def to_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """(key, chunk, doc_id, fragment) tuples as a batch."""
    fields = [f._asdict() | {"key": k, "chunk": c, "doc_id": d} for k, c, d, f in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[f.name].tobytes() if f.name in ARRAYS else r[f.name] for r in fields], f.type) for f in schema],
        schema=schema,
    )


def from_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for r in batch.to_pylist():
        values = {k: np.frombuffer(r[k], np.int64) if k in ARRAYS else r[k] for k in Fragment._fields}
        yield r["key"], r["chunk"], r["doc_id"], Fragment(**values)


def fragments(rows: DataFrame, definition: str, proto: bytes) -> DataFrame:
    """One fragment for each byte range."""
    schema = arrow_schema(FRAGMENTS)

    def make():
        units = shared_units(definition, proto)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for r in batch.to_pylist():
                if units.full():
                    units.forget()
                yield to_rows([(r["key"], r["chunk"], r["doc_id"], units.between(r["text"], r["low"], r["high"]))], schema)

        return step

    return map_arrow(rows, make, FRAGMENTS)


def composed(parts: DataFrame, scratch: Scratch) -> DataFrame:
    """One fragment for each document: levels of ``FAN`` neighbours, until no document has two."""
    schema = arrow_schema("key bigint, up bigint, " + FRAGMENTS.split(", ", 1)[1])

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = sorted(from_rows(batch), key=lambda r: r[1])
        up = batch.column("up")[0].as_py()
        yield to_rows([(rows[0][0], up, rows[0][2], compose([r[3] for r in rows]))], arrow_schema(FRAGMENTS))

    parts, seen = scratch.cut(parts, last=F.max("chunk"))
    last = seen["last"] or 0
    while last:
        grouped = parts.withColumn("up", F.expr(f"chunk div {FAN}"))
        parts, last = map_runs(grouped, ["key", "up"], None, lambda: step, FRAGMENTS), last // FAN
    return parts


# Blocks of documents

FINISHED = ("block bigint, listed boolean, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
            "groups_sha256 string, groups string, own binary, times binary, codes binary, docs binary")


class Blocks:
    """Documents of a task in blocks: a row for each, and a row with the distinct pairs of the block."""

    def __init__(self, keep_groups: bool):
        from pyspark import TaskContext

        self.keep_groups, self.schema = keep_groups, arrow_schema(FINISHED)
        self.block, self.rows, self.entries = TaskContext.get().partitionId() << 32, [], 0

    def add(self, doc_id: int | None, f: Fragment) -> Iterator[pa.RecordBatch]:
        """A whole document: what lies before its first place is a group, and nothing lies behind its last one."""
        f = compose([Fragment(mark=True), f])
        if not f.valid or f.n_a == 0:
            f = Fragment()
        self.rows.append((doc_id, f.n_a, f.n_b, f.n_groups, f.n_links,
                          hashlib.sha256(f.groups).hexdigest() if f.groups else "",
                          f.groups.decode() if self.keep_groups else None, f.codes, f.times))
        self.entries += len(f.codes)
        if self.entries >= BLOCK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        sizes = [len(r[7]) for r in self.rows]
        codes, at = np.unique(np.concatenate([r[7] for r in self.rows]), return_inverse=True)
        ends = np.cumsum(sizes).tolist()
        own = [pack_codes(at[e - n: e]) for e, n in zip(ends, sizes)]
        docs = np.bincount(at, minlength=len(codes)).astype(np.int64)
        nothing = [None] * len(self.rows)
        columns = [[self.block] * len(self.rows), [False] * len(self.rows), *list(zip(*self.rows))[:7], own,
                   [pack_codes(r[8]) for r in self.rows], nothing, nothing]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        last = {"block": self.block, "listed": True, "codes": codes.tobytes(), "docs": docs.tobytes()}
        yield pa.RecordBatch.from_arrays([pa.array([last.get(f.name)], f.type) for f in self.schema], schema=self.schema)
        self.block, self.rows, self.entries = self.block + 1, [], 0


def finish_short(docs: DataFrame, definition: str, proto: bytes, keep_groups: bool) -> DataFrame:
    """Documents that are one byte range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, blocks = shared_units(definition, proto), Blocks(keep_groups)
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for low, high in steps(offsets, SLICE):
                if units.full():
                    units.forget()
                some = batch.slice(low, high - low)
                texts = [t or "" for t in some.column("text").to_pylist()]
                for doc_id, f in zip(some.column("doc_id").to_pylist(), units.whole(texts)):
                    yield from blocks.add(doc_id, f)
        yield from blocks.flush()
        release()

    return docs.mapInArrow(run, FINISHED)


def finish_long(parts: DataFrame, keep_groups: bool) -> DataFrame:
    """Documents put together from their byte ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(keep_groups)
        for batch in batches:
            for _, _, doc_id, f in from_rows(batch):
                yield from blocks.add(doc_id, f)
        yield from blocks.flush()
        release()

    return parts.mapInArrow(run, FINISHED)


# Counts of linked pairs

LISTED = "block bigint, nth int, code bigint, docs bigint"


def _listed():
    schema = arrow_schema(LISTED)

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block, codes, docs in zip(*[batch.column(c).to_pylist() for c in ("block", "codes", "docs")]):
            n = len(codes) // 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)),
                 pa.array(np.frombuffer(codes, np.int64)), pa.array(np.frombuffer(docs, np.int64))], schema=schema,
            )

    return step


def link_counts(finished: DataFrame) -> DataFrame:
    """(a, b, code, docs): how many documents link a pair of ids, over all blocks."""
    listed = map_arrow(finished.where("listed").select("block", "codes", "docs"), _listed, LISTED)
    counts = listed.groupBy("code").agg(F.sum("docs").alias("docs"))
    return counts.select(F.shiftright("code", 32).alias("a"), F.col("code").bitwiseAND(0xFFFFFFFF).alias("b"), "code", "docs")


RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string, groups string")


def _answer(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of one block with the counts of the block's pairs."""
    order = np.argsort(answers.column("nth").to_numpy())
    count = answers.column("docs").to_numpy()[order]
    best = answers.column("best").to_numpy()[order]
    n_best, count_sum = [], []
    for own, times in zip(docs.column("own").to_pylist(), docs.column("times").to_pylist()):
        own, times = unpack_codes(own), unpack_codes(times).astype(np.int64)
        n_best.append(int(times[best[own]].sum()))
        count_sum.append(int((times * count[own]).sum()))
    made = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    schema = arrow_schema(RESULT)
    return pa.Table.from_arrays(
        [made[f.name] if f.name in made else docs.column(f.name).cast(f.type) for f in schema], schema=schema
    )


def align(
    docs: DataFrame, definition: str, proto: bytes, scratch: Scratch, chunk: int = CHUNK, keep_groups: bool = True
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups) for each row of (doc_id, text).

    A is the byte-level BPE of the tokenizers file ``definition`` over a space and the text, B the SentencePiece model
    ``proto`` over the text, both without special tokens. ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of the ids of each
    group; without ``keep_groups`` it is NULL and only its digest is there. A link is a pair of tokens of one group, its
    count the number of documents that hold its ids linked; ``n_best`` counts links of the highest count of their A id.

    NULL and empty texts, and texts whose bytes do not come out of both tokenizers (U+2581 in the text, for one), have
    zeros and empty strings. Rows with a NULL or repeated doc_id count as documents of their own; other columns are not
    read; an empty table gives an empty result.
    """
    load(proto)  # refuses models that join pieces across a space or change texts
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    long = F.octet_length("text") >= chunk  # one more byte, the space, makes a second range
    parts = composed(fragments(chunks(docs.where(long), chunk), definition, proto), scratch)
    short = finish_short(docs.where(F.coalesce(~long, F.lit(True))), definition, proto, keep_groups)
    finished, _ = scratch.cut(short.unionByName(finish_long(parts, keep_groups)))
    counts, _ = scratch.cut(link_counts(finished))
    # One row for each id of A: bounded by its vocabulary.
    most = F.broadcast(counts.groupBy("a").agg(F.max("docs").alias("most")))
    flagged = counts.join(most, "a").select("code", "docs", (F.col("docs") == F.col("most")).alias("best"))
    listed = map_arrow(finished.where("listed").select("block", "codes", "docs"), _listed, LISTED)
    answers = listed.select("block", "nth", "code").join(flagged, "code").select("block", "nth", "docs", "best")
    rows = finished.where("not listed").drop("listed", "codes", "docs")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answer, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; groups as digests."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        proto = f.read()
    return align(table(spark, sf_dir, "documents"), definition, proto, Scratch(spark), keep_groups=False).drop("groups")
