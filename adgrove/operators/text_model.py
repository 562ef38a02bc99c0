"""A text model trained on all rows: hashed word embeddings, their mean, and a softmax over labels.

Each step is one Spark job. Tasks hold the model, add up the gradient of their rows and cut the sum into slices; a tree of
aggregations merges the slices, and the driver moves the model, whose size is bounded by its parameters and not by the rows.
Values are kept on a grid of 2^-20 and gradients are added up as integers, so a run gives the same model for a seed however
the rows are split, dealt out or repeated by lost tasks.

An epoch goes through the rows share by share; a share is a directory, so a step reads its own rows only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adgrove.operators.scratch import Scratch

#: Steps of the grid in 1, for the model and for gradients of the output.
GRID, FINE = 1 << 20, 1 << 16
#: Largest absolute value of a model entry, so that products of two stay exact.
LARGEST = 64.0
#: Entries of the gradient in one row, rows that one task merges, and texts at once.
SLICE, FAN, BATCH = 1 << 15, 64, 512
#: A word is frequent if it comes at least once in this many texts of a batch.
COMMON = 64
#: Rows of one step: sums of as many fit 64 bits.
MOST_ROWS = 1 << 24
MOST_LABELS = 10_000


def buckets_of(words: Column, buckets: int) -> Column:
    """Word list as embedding numbers; a text without words, or NULL, has none."""
    return F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


def _split(words: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of frequent words, how often each text has them, and number and text of every other word.

    Frequent words go through matrix products, the others one by one. All sums are exact, so the split changes nothing.
    """
    texts = len(offsets) - 1
    text = np.repeat(np.arange(texts), np.diff(offsets))
    common = np.bincount(words, minlength=buckets) * COMMON >= texts
    ids, column, often = np.flatnonzero(common), np.cumsum(common) - 1, common[words]
    cells = text[often] * len(ids) + column[words[often]]
    counts = np.bincount(cells, minlength=texts * len(ids)).reshape(texts, len(ids)).astype(np.float64)
    return ids, counts, words[~often], text[~often]


def _means(parts: tuple, n: np.ndarray, embeddings: np.ndarray) -> np.ndarray:
    ids, counts, rest, text = parts
    out = counts @ embeddings[ids]
    if len(rest):
        first = np.flatnonzero(np.diff(text, prepend=-1))
        out[text[first]] += np.add.reduceat(embeddings[rest], first)
    return np.rint(out / np.maximum(n, 1)[:, None] * GRID) / GRID


def means(words: np.ndarray, offsets: np.ndarray, embeddings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean embedding of each text on the grid, number of its words); without words it is zero."""
    n = np.diff(offsets)
    return _means(_split(words, offsets, len(embeddings)), n, embeddings), n


def gradient(
    words: np.ndarray, offsets: np.ndarray, labels: np.ndarray, embeddings: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Sums over the texts of the loss's gradient by embeddings and weights, as integers, and of the loss."""
    n, parts = np.diff(offsets), _split(words, offsets, len(embeddings))
    text = _means(parts, n, embeddings)
    p = probabilities(text, weights)
    loss = float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).sum())
    p[np.arange(len(labels)), labels] -= 1
    p = np.rint(p * FINE) / FINE
    by_weights = np.rint(p.T @ text * FINE * GRID).astype(np.int64)
    each = np.rint((p @ weights) / np.maximum(n, 1)[:, None] * GRID)
    by_words = np.zeros(embeddings.shape, np.int64)
    ids, counts, rest, at = parts
    by_words[ids] = (counts.T @ each).astype(np.int64)
    if len(rest):
        order = np.argsort(rest, kind="stable")
        first = np.flatnonzero(np.diff(rest[order], prepend=-1))
        by_words[rest[order][first]] += np.add.reduceat(each[at[order]], first, axis=0).astype(np.int64)
    return by_words, by_weights, loss


def probabilities(text: np.ndarray, weights: np.ndarray) -> np.ndarray:
    logits = text @ weights.T
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    for low in range(0, batch.num_rows, BATCH):
        some = batch.slice(low, BATCH)
        column = some.column("words")
        offsets = column.offsets.to_numpy().astype(np.int64)
        yield column.values.to_numpy()[offsets[0]: offsets[-1]], offsets - offsets[0], some


@dataclass(frozen=True)
class TextModel:
    """``labels`` in order; ``embeddings`` by word bucket, ``weights`` by label; mean ``losses`` of the epochs."""

    labels: tuple[str, ...]
    embeddings: np.ndarray
    weights: np.ndarray
    losses: tuple[float, ...]

    def apply(self, rows: DataFrame, keep: Sequence[str], words: str = "words") -> DataFrame:
        """Columns ``keep`` with ``vector`` (mean embedding), ``predicted`` label and its ``probability``.

        A text without known words has the zero vector and the label that comes first among the likeliest.
        """
        spark = rows.sparkSession
        shared = spark.sparkContext.broadcast((self.embeddings, self.weights, self.labels))
        packed = rows.select(F.struct(F.lit(0).alias("_"), *keep).alias("row"), buckets_of(F.col(words), len(self.embeddings)).alias("words"))
        schema = f"row {packed.schema['row'].dataType.simpleString()}, vector array<double>, predicted string, probability double"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            embeddings, weights, labels = shared.value
            names = pa.array(labels, pa.string())
            for batch in batches:
                for ids, offsets, some in _texts(batch):
                    text, _ = means(ids, offsets, embeddings)
                    p = probabilities(text, weights)
                    best = p.argmax(1)
                    flat = pa.ListArray.from_arrays(np.arange(0, text.size + 1, text.shape[1], np.int32), pa.array(text.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [some.column("row"), flat, names.take(pa.array(best)), pa.array(p[np.arange(len(best)), best])],
                        names=["row", "vector", "predicted", "probability"],
                    )

        return packed.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in keep], "vector", "predicted", "probability")


def train(
    rows: DataFrame, dim: int = 64, buckets: int = 1 << 14, epochs: int = 20, shares: int = 1, rate: float = 0.05, seed: int = 1
) -> TextModel:
    """Model of ``rows`` (id, label, words); rows with a NULL label are left out, repeated rows count each time.

    ``shares`` steps make an epoch; there are at least as many as keep a step below ``MOST_ROWS`` rows.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    known = rows.where(F.col("label").isNotNull()).select("id", F.col("label").cast("string").alias("label"), "words")
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label").limit(MOST_LABELS + 1).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    labels, total = tuple(r["label"] for r in counts), sum(r["n"] for r in counts)
    if not labels:
        return TextModel((), np.zeros((buckets, dim)), np.zeros((0, dim)), ())
    shares = max(shares, math.ceil(total / MOST_ROWS))
    numbers = spark.createDataFrame(list(enumerate(labels)), "at int, label string")
    share = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(shares)).cast("int").alias("share")
    cut = known.join(F.broadcast(numbers), "label").select(buckets_of(F.col("words"), buckets).alias("words"), "at", share)
    path = f"{scratch.folder}/texts"
    cut.write.partitionBy("share").parquet(path)
    texts = spark.read.schema("words array<int>, at int, share int").parquet(path)
    read = [texts.where(F.col("share") == k) for k in range(shares)]
    rng = np.random.default_rng(seed)
    embeddings = np.rint(rng.uniform(-1 / dim, 1 / dim, (buckets, dim)) * GRID) / GRID
    weights, moments, losses, step = np.zeros((len(labels), dim)), None, [], 0
    for _ in range(epochs):
        loss = 0.0
        for some in read:
            by_words, by_weights, here, n = _summed(some, embeddings, weights)
            loss += here
            if not n:
                continue
            step += 1
            slope = np.concatenate([by_words / (n * GRID), by_weights / (n * FINE * GRID)])
            model, moments = _moved(np.concatenate([embeddings, weights]), slope, moments, step, rate)
            embeddings, weights = model[:buckets], model[buckets:]
        losses.append(loss / total)
    return TextModel(labels, embeddings, weights, tuple(losses))


def _moved(model: np.ndarray, slope: np.ndarray, moments, step: int, rate: float) -> tuple[np.ndarray, tuple]:
    """One step of adaptive moments (decay 0.9 and 0.999), back on the grid and inside the range that stays exact."""
    first, second = moments or (np.zeros_like(model), np.zeros_like(model))
    first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
    move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return np.clip(np.rint((model - move) * GRID) / GRID, -LARGEST, LARGEST), (first, second)


def _summed(rows: DataFrame, embeddings: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Gradient sums of all rows (embeddings, weights), loss and rows: slices of integers merged by a tree."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((embeddings, weights))
    size, dim = embeddings.size, embeddings.shape[1]
    schema = "slice int, part bigint, data binary, loss double, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        e, w = shared.value
        total, loss, n = np.zeros(e.size + w.size, np.int64), 0.0, 0
        for batch in batches:
            for ids, offsets, some in _texts(batch):
                by_words, by_weights, here = gradient(ids, offsets, some.column("at").to_numpy(), e, w)
                total[: e.size] += by_words.ravel()
                total[e.size:] += by_weights.ravel()
                loss, n = loss + here, n + some.num_rows
        if n:
            for k, low in enumerate(range(0, len(total), SLICE)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int64()),
                     pa.array([total[low: low + SLICE].tobytes()], pa.binary()), pa.array([0.0 if k else loss]),
                     pa.array([0 if k else n], pa.int64())], names=["slice", "part", "data", "loss", "n"],
                )

    def merge(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(d, np.int64) for d in group["data"].to_pylist()], axis=0)
        return pa.table({
            "slice": group["slice"][:1].cast(pa.int32()), "part": group["part"][:1],
            "data": pa.array([total.tobytes()], pa.binary()), "loss": pa.array([math.fsum(group["loss"].to_pylist())]),
            "n": pa.array([sum(group["n"].to_pylist())], pa.int64()),
        })

    found, tasks = rows.mapInArrow(run, schema), rows.rdd.getNumPartitions()
    while tasks > 1:
        found = found.withColumn("part", F.expr(f"part div {FAN}")).groupBy("slice", "part").applyInArrow(merge, schema)
        tasks = math.ceil(tasks / FAN)
    slices = found.collect()  # the model's size
    shared.unpersist()
    total = np.zeros(size + weights.size, np.int64)
    for r in slices:
        total[r["slice"] * SLICE: r["slice"] * SLICE + len(r["data"]) // 8] = np.frombuffer(r["data"], np.int64)
    return (total[:size].reshape(-1, dim), total[size:].reshape(-1, dim),
            math.fsum(r["loss"] for r in slices), sum(r["n"] for r in slices))


def quality(model: TextModel, rows: DataFrame) -> DataFrame:
    """Examples, labels and correct predictions of ``rows`` (id, label, words), which the model should not have seen."""
    scored = model.apply(rows.where(F.col("label").isNotNull()), ["id", "label"])
    right = F.count_if(F.col("predicted") == F.col("label").cast("string"))
    return scored.agg(
        F.count(F.lit(1)).alias("examples"), F.count_distinct("label").alias("labels"), right.alias("correct"),
        (right / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("precision"),
    )
