"""Repeated passages: words of long windows that also start in an earlier document.

Only windows at difference-cover positions are hashed at first: positions whose remainder by the period lies in a set
where every difference occurs. Two equal windows of full length, wherever they start, have such a position at the same
distance from both starts, so they share the hash of a shorter anchor there. Shared anchors are few; around them, and
nowhere else, windows of full length are hashed with 96 bits and compared by the smallest document that has each.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, map_arrow, map_rows, table
from adgrove.llm.words import Hasher, inside, signed, split_words, steps, text_bytes
from adgrove.operators.scratch import Scratch
from adgrove.operators.skew import join_spread

#: Words of a window.
WINDOW = 50

# Perfect difference sets by period. Every remainder is the difference of two members.
COVERS = {
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    21: (3, 6, 7, 12, 14),
    31: (1, 5, 11, 24, 25, 27),
    57: (0, 1, 6, 15, 22, 26, 45, 55),
}
#: Fewest words of an anchor.
ANCHOR = 8


def cover(window: int) -> tuple[int, np.ndarray]:
    """Period and marked remainders: the longest period that leaves anchors of ``ANCHOR`` words."""
    periods = [p for p in COVERS if window - p + 1 >= ANCHOR]
    if not periods:
        raise ValueError(f"windows have at least {min(COVERS) + ANCHOR - 1} words")
    marked = np.zeros(max(periods), bool)
    marked[list(COVERS[max(periods)])] = True
    return max(periods), marked


class Windows:
    """Anchors and windows of texts."""

    def __init__(self, window: int):
        self.window = window
        self.period, self.marked = cover(window)
        self.anchor = window - self.period + 1
        self.word, self.wide = Hasher(31), Hasher(32)

    def anchors(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of the anchors at cover positions of rows with at least one window."""
        at = inside(first, self.anchor)
        count = np.diff(first)
        begin, enough = np.repeat(first[:-1], count)[at], np.repeat(count >= self.window, count)[at]
        at = at[enough & self.marked[(at - begin) % self.period]]
        return at, self.word.windows(h, self.anchor)[at]


def distinct_pairs(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) pairs and where each is found."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new], order[new]


def _anchors(window: int):
    def make():
        w_, schema = Windows(window), arrow_schema("h bigint, doc_id bigint")

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            data, at = text_bytes(batch.column("text"))
            for low, high in steps(at):
                w = split_words(data, at[low: high + 1])
                place, h = w_.anchors(w_.word.words(w), w.first)
                row, h, _ = distinct_pairs(np.searchsorted(w.first, place, "right") - 1, h)
                yield pa.RecordBatch.from_arrays([signed(h), pa.array(ids[low + row])], schema=schema)

        return step

    return make


def near(first: np.ndarray, place: np.ndarray, window: int, reach: int) -> np.ndarray:
    """Starts of the windows, inside their rows, that cover an anchor at ``place`` within their first ``reach`` words."""
    row = np.searchsorted(first, place, "right") - 1
    low, high = np.maximum(place - reach + 1, first[row]), np.minimum(place, first[row + 1] - window)
    ok = high >= low
    change = np.zeros(first[-1] + 1, np.int64)
    np.add.at(change, low[ok], 1)
    np.add.at(change, high[ok] + 1, -1)
    return np.flatnonzero(np.cumsum(change)[:-1] > 0)


def _members(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column; NULL is empty."""
    size = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
    return np.concatenate([[0], np.cumsum(size)]), column.drop_null().flatten().to_numpy().view(np.uint64)


def _windows(window: int):
    def make():
        w_, schema = Windows(window), arrow_schema("a bigint, b int, doc_id bigint")

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids = batch.column("doc_id").to_numpy()
            data, at = text_bytes(batch.column("text"))
            cuts, values = _members(batch.column("anchors"))
            for low, high in steps(at):
                w = split_words(data, at[low: high + 1])
                h = w_.word.words(w)
                place, anchor = w_.anchors(h, w.first)
                row = np.searchsorted(w.first, place, "right") - 1
                shared = np.zeros(len(place), bool)
                for r in range(high - low):
                    a, b = np.searchsorted(row, [r, r + 1])
                    shared[a:b] = np.isin(anchor[a:b], values[cuts[low + r]: cuts[low + r + 1]])
                start = near(w.first, place[shared], window, w_.period)
                full = w_.word.windows(h, window)[start]
                row, full, at_ = distinct_pairs(np.searchsorted(w.first, start, "right") - 1, full)
                second = w_.wide.windows(w_.wide.words(w), window)[start[at_]] if len(start) else full
                yield pa.RecordBatch.from_arrays(
                    [signed(full), pa.array((second & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)),
                     pa.array(ids[low + row])], schema=schema,
                )

        return step

    return make


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of finished steps now; it does so only when the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def repeated(docs: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """(doc_id, whole, bad): documents with words to remove, one row an id.

    Joins with whole texts are sort-merge joins at every size: the lists that they meet grow with the corpus.

    ``whole`` marks copies of a whole text with a smaller id, whose words all go if the text has a window; ``bad``
    holds the hashes of the other documents' windows that start in a document with a smaller id.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    prints, seen = scratch.cut(
        docs.select("doc_id", F.md5("text").alias("print")).where("print is not null"), rows=F.count(F.lit(1))
    )
    classes = (
        prints.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("weight")).where("weight > 1")
    )
    single = prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("doc_id")
    copies, _ = scratch.cut(
        join_spread(prints, classes, ["print"], "weight", max(1, seen["rows"])).where("doc_id > least")
        .select("doc_id").join(single, "doc_id")
    )

    found, counted = scratch.cut(
        map_arrow(docs, _anchors(window), "h bigint, doc_id bigint"), rows=F.count(F.lit(1))
    )
    shared = (
        found.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("weight"))
        .where("low < high").select("h", "weight")
    )
    of_doc, _ = scratch.cut(
        join_spread(found, shared, ["h"], "weight", max(1, counted["rows"]))
        .join(copies, "doc_id", "left_anti")
        .groupBy("doc_id").agg(F.collect_set("h").alias("anchors"))
    )
    free_shuffles(spark)

    full, counted = scratch.cut(
        map_arrow(docs.hint("merge").join(of_doc, "doc_id").select("doc_id", "text", "anchors"), _windows(window),
                  "a bigint, b int, doc_id bigint"), rows=F.count(F.lit(1)),
    )
    free_shuffles(spark)
    earliest = (
        full.groupBy("a", "b").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("weight"))
        .where("low < high").select("a", "b", "low", "weight")
    )
    bad = (
        join_spread(full, earliest, ["a", "b"], "weight", max(1, counted["rows"])).where("doc_id > low")
        .groupBy("doc_id").agg(F.collect_set("a").alias("bad"))
    )
    out, _ = scratch.cut(
        bad.select("doc_id", F.lit(False).alias("whole"), "bad").unionByName(
            copies.select("doc_id", F.lit(True).alias("whole"), F.array().cast("array<bigint>").alias("bad"))
        )
    )
    free_shuffles(spark)
    return out


def _remover(window: int):
    def make():
        w_ = Windows(window)

        def derive(texts: pa.Array, whole: pa.Array, bad: pa.Array) -> list:
            data, at = text_bytes(texts)
            cuts, values = _members(bad)
            copy = whole.fill_null(False).to_numpy(zero_copy_only=False)
            n_words = np.zeros(len(texts), np.int64)
            removed = np.zeros(len(texts), np.int64)
            kept, left = [], []
            for low, high in steps(at):
                w = split_words(data, at[low: high + 1])
                count = np.diff(w.first)
                n_words[low:high] = count
                gone = np.zeros(len(w.start), bool)
                touched = np.flatnonzero((np.diff(cuts[low: high + 1]) > 0) | copy[low:high])
                if len(touched):
                    h = w_.word.windows(w_.word.words(w), window)
                for r in touched:
                    a, b = w.first[r], w.first[r + 1]
                    if b - a < window:
                        continue
                    if copy[low + r]:
                        gone[a:b] = True
                        continue
                    start = a + np.flatnonzero(np.isin(h[a: b - window + 1], values[cuts[low + r]: cuts[low + r + 1]]))
                    change = np.zeros(b - a + 1, np.int64)
                    np.add.at(change, start - a, 1)
                    np.add.at(change, start - a + window, -1)
                    gone[a:b] = np.cumsum(change)[:-1] > 0
                raw = w.data.tobytes()
                bounds = at[low: high + 1] - at[low]
                for r in range(high - low):
                    a, b = w.first[r], w.first[r + 1]
                    text = raw[bounds[r]: bounds[r + 1]]
                    if gone[a:b].any():
                        keep = np.flatnonzero(~gone[a:b]) + a
                        removed[low + r] = b - a - len(keep)
                        kept.append(b" ".join(raw[s:e] for s, e in zip(w.start[keep].tolist(), w.end[keep].tolist())))
                        left.append(_cut(raw, w.start, w.end, gone, a, b))
                    else:
                        kept.append(b" ".join(text.split()))
                        left.append(text)
            return [pa.array(n_words), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(left, pa.binary()).cast(pa.string())]

        return derive

    return make


def _cut(raw: bytes, start: np.ndarray, end: np.ndarray, gone: np.ndarray, a: int, b: int) -> bytes:
    """Text of words a to b without the removed runs; white space inside what stays is unchanged."""
    edge = np.diff(np.concatenate([[True], gone[a:b], [True]]).astype(np.int8))
    begins, ends = np.flatnonzero(edge == -1) + a, np.flatnonzero(edge == 1) + a - 1
    return b"\n".join(raw[start[i]: end[j]] for i, j in zip(begins.tolist(), ends.tolist()))


def remove_repeated(
    docs: DataFrame, keep: list[str], window: int = WINDOW, scratch: Scratch | None = None, inside: str | None = None
) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` (doc_id, text), with ``n_words``, ``n_removed``, ``kept`` and ``left``.

    Each word covered by a window of ``window`` consecutive words whose sequence also starts in a document with a
    smaller id is removed; windows are judged on the input. ``kept`` has the kept words joined by one space, ``left``
    the text itself without the removed runs (a line feed where one was). A NULL text has no words. Rows with one id
    are judged alike and are no source for each other; a row with a NULL id is no source and loses nothing. ``inside``
    names the kept struct that holds the text, if one does, so that the text does not travel twice.
    """
    cover(window)
    scratch = scratch or Scratch(docs.sparkSession)
    marked = repeated(docs, window, scratch).withColumnRenamed("doc_id", "_id")
    text = f"_row.{inside}.text" if inside else "text"
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col("doc_id").alias("_doc"), *([] if inside else ["text"])
    )
    joined = rows.hint("merge").join(marked, F.col("_doc") == F.col("_id"), "left")
    out = map_rows(joined, ["_row"], [text, "whole", "bad"], _remover(window),
                   "n_words bigint, n_removed bigint, kept string, left string")
    new = ["n_words", "n_removed", "kept", "left"]
    return out.select(*[F.col("_row").getField(c).alias(c) for c in keep if c not in new], *new)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated passages of 50 words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated(docs, ["doc_id"]).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
