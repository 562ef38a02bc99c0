"""Documents packed into as few sequences of bounded length as can be found.

How many pieces there are of each length is all that packing needs to know, so an instance of any number of documents is
a table of at most ``capacity`` counts. That table is solved on the driver: Martello and Toth's dominance rule
fixes small sets of pieces that belong together in some optimal packing, as often as both are there, and best fit by falling
length packs what is left. A group of equal sequences is one row of the plan, so the plan's size follows the capacity
too. Spark numbers the pieces of each length, and a piece's number tells its place in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, map_rows, release, table
from adgrove.llm.tokens import SLICE, shared_encoder
from adgrove.llm.words import steps, text_bytes
from adgrove.operators.scratch import Scratch

CAPACITY = 1024
END = 2


# Packing of counts


class Group(NamedTuple):
    """``sequences`` equal sequences: lengths in order with the number of pieces of each."""

    sequences: int
    content: tuple[tuple[int, int], ...]


def best_fill(counts: list[int], room: int) -> int:
    """Largest total up to ``room`` that some of the pieces have; a set of totals is the bits of one integer."""
    mask, reach = (1 << (room + 1)) - 1, 1
    for size in range(1, room + 1):
        left, step = min(counts[size], room // size), 1
        while left > 0:
            take = min(step, left)
            reach |= (reach << (size * take)) & mask
            left, step = left - take, step * 2
    return reach.bit_length() - 1


def partners(counts: list[int], j: int, capacity: int) -> tuple[int, ...] | None:
    """Pieces that some optimal packing has with a piece of length ``j`` and nothing else; None if the rule says nothing.

    A set {j, ...} dominates if everything else that could stand beside j can be split into parts no longer than the
    set's members: exchanging them never takes another sequence. ``counts`` is without the piece j itself.
    """
    room = capacity - j
    fitting = [s for s in range(room, 0, -1) if counts[s]]
    if not fitting:
        return ()
    k = fitting[0]
    if k == room or best_fill(counts, room) == k:
        return (k,)  # no filling of the room is longer than the one piece
    least = [s for s in fitting[::-1] for _ in range(min(counts[s], 3))][:3]
    if len(least) == 3 and sum(least) <= room:
        return None
    # At most two pieces fit beside j. The longest with the longest that fits beside it, unless two others with a
    # longer second piece fit.
    second = next((s for s in fitting if k + s <= room and counts[s] > (s == k)), None)
    if second is None:
        return None
    longer = [s for s in fitting if second < s <= room // 2]
    if any(counts[s] > 1 or any(s < t <= room - s for t in fitting) for s in longer):
        return None
    return (k, second)


def reduce(counts: list[int], capacity: int) -> list[Group]:
    """Sequences fixed by dominance, in rounds until the rule says nothing more; takes their pieces out of ``counts``."""
    fixed, again = [], True
    while again:
        again = False
        for j in range(capacity, 0, -1):
            while counts[j]:
                counts[j] -= 1
                others = partners(counts, j, capacity)
                counts[j] += 1
                if others is None:
                    break
                members = [j, *others]
                # With fewer pieces about, the set still dominates: fix it as often as its members are there.
                times = min(counts[s] // members.count(s) for s in members)
                for s in members:
                    counts[s] -= times
                content = {s: members.count(s) for s in members}
                fixed.append(Group(times, tuple(content.items())))
                again = bool(others) or again
    return fixed


def best_fit(counts: list[int], capacity: int) -> list[Group]:
    """Best fit by falling length: a piece goes where it leaves the least room; equal sequences are filled together."""
    by_room: dict[int, list[Group]] = {}

    def put(room: int, sequences: int, content: tuple) -> None:
        if sequences:
            by_room.setdefault(room, []).append(Group(sequences, content))

    for size in range(capacity, 0, -1):
        left = counts[size]
        for room in sorted(r for r in by_room if r >= size):
            for group in by_room.pop(room) if left else ():
                each = room // size
                full = min(group.sequences, left // each)
                put(room - each * size, full, (*group.content, (size, each)))
                left -= full * each
                rest = group.sequences - full
                if rest and left:
                    # Fewer than fill one more sequence.
                    put(room - left * size, 1, (*group.content, (size, left)))
                    left, rest = 0, rest - 1
                put(room, rest, group.content)
        each = capacity // size
        put(capacity - each * size, left // each, ((size, each),))
        if left % each:
            put(capacity - left % each * size, 1, ((size, left % each),))
    return [g for groups in by_room.values() for g in groups]


def pack(counts: list[int], capacity: int) -> list[Group]:
    """Sequences for ``counts[s]`` pieces of each length s from 1 to ``capacity``."""
    counts = list(counts)
    fixed = reduce(counts, capacity)
    return fixed + best_fit(counts, capacity)


class Places(NamedTuple):
    """Where pieces go: runs of pieces of one length, by number, ordered by (length, first)."""

    key: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``number``-th pieces of these lengths."""
        at = np.searchsorted(self.key, _key(length, number), "right") - 1
        n = number - self.first[at]
        return self.sequence[at] + n // self.each[at], self.offset[at] + n % self.each[at] * length


def _key(length: np.ndarray, number: np.ndarray) -> np.ndarray:
    return (length.astype(np.int64) << 44) + number


def places(groups: list[Group]) -> Places:
    rows, used, sequence = [], {}, 0
    for group in groups:
        offset = 0
        for size, each in group.content:
            first = used.get(size, 0)
            rows.append((size, first, sequence, each, offset))
            used[size] = first + group.sequences * each
            offset += size * each
        sequence += group.sequences
    size, *rest = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Places(_key(size, rest[0]), *rest)


# Pieces of documents

PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, ids binary, part int, nth bigint"


def pieces(docs: DataFrame, definition: str, end: int, capacity: int, keep_ids: bool) -> DataFrame:
    """Pieces of all documents; ``nth`` counts a task's pieces of one length, ``part`` is the task."""
    schema = arrow_schema(PIECES)
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = shared_encoder(definition, end), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for low, high in steps(offsets, SLICE):
                some = batch.slice(low, high - low)
                counts, ids = encoder.encode(some.column("text"))
                each = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), each)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
                first = (counts - (each - 1) * capacity)[row]
                length = np.where(piece, capacity, first)
                start = np.where(piece, first + (piece - 1) * capacity, 0)
                ends = np.cumsum(length)
                data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                spans = [data[4 * (e - n): 4 * e] for e, n in zip(ends.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                group = np.searchsorted(length[order], length[order], "left")
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - group
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays([
                    some.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start),
                    pa.array(length, pa.int32()), pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                    pa.array([bytes(s) for s in spans], pa.binary()) if keep_ids else pa.nulls(len(row), pa.binary()),
                    some.column("part").take(pa.array(row)), pa.array(nth),
                ], schema=schema)
        release()

    out = given.mapInArrow(run, PIECES)
    return out if keep_ids else out.drop("ids")


def pack_documents(
    docs: DataFrame, definition: str, scratch: Scratch, end: int = END, capacity: int = CAPACITY, keep_ids: bool = True
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset): every piece and its place.

    A document is its ids by the tokenizers file ``definition`` with ``end`` behind them; a NULL or empty text is ``end``
    alone. A document longer than ``capacity`` is cut into pieces of that length, of which the first may be
    shorter; such full pieces are sequences of their own. ``ids`` are little-endian unsigned 32-bit integers, left out
    without ``keep_ids``. Rows with a NULL or repeated doc_id are documents like others; other columns are not read;
    an empty table gives an empty result.
    """
    cut, _ = scratch.cut(pieces(docs, definition, end, capacity, keep_ids))
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("own"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts, _ = scratch.cut(counts.withColumn("before", F.coalesce(F.sum("own").over(before), F.lit(0))))
    total = [0] * (capacity + 1)
    for r in counts.groupBy("length").agg(F.sum("own").alias("n")).collect():  # at most ``capacity`` rows
        total[r["length"]] = r["n"]
    plan = places(pack(total, capacity))

    def find():
        def place(length: pa.Array, nth: pa.Array, before: pa.Array) -> list[np.ndarray]:
            return list(plan.find(length.to_numpy(), nth.to_numpy() + before.to_numpy()))

        return place

    numbered = cut.join(counts.drop("own"), ["length", "part"])
    keep = [c for c in cut.columns if c not in ("part", "nth")]
    return map_rows(numbered, keep, ["length", "nth", "before"], find, "sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, lengths): whole sequences, pieces by offset; a sequence is at most ``capacity`` ids."""
    piece = F.struct("offset", "doc_id", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return rows.select(
        "sequence_id", F.concat(F.lit(b""), F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))).alias("ids"),
        F.col("pieces.doc_id").alias("doc_ids"), F.col("pieces.length").alias("lengths"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; checksums are taken from the ids as they are cut."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    return pack_documents(table(spark, sf_dir, "documents"), definition, Scratch(spark), keep_ids=False)
