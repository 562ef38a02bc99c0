"""Toxic texts by a convolutional classifier over hashed word embeddings, trained on all labelled texts.

A word is a run of letters and digits in lower case; its vector is the sum of hashed embeddings of the word, twice
with independent hashes so that chance meetings of rare words do not look like a known word, and of its first bytes.
Filters of several widths run over the word vectors; the largest response of each filter over the whole text feeds a
logistic unit. Thresholds are calibrated for each language that a word profile tells apart, and scores are bent so that
the threshold of a text's language lies at one half.

Every epoch is one Spark job over all texts that are not held back: each task goes on from the common model through its own
texts and hands back what moved, and the mean of the moves is the next common model. Word profile and thresholds come
from counts over all labelled texts. What the driver holds is bounded by the model's parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import delete, id_crc, map_arrow, map_rows, table
from adgrove.llm.words import Hasher, Words, letter_table, lower_text, mix, split_words, steps, text_bytes
from adgrove.operators.scratch import Scratch

#: Tasks of an epoch, so models that meet after it.
TASKS = 64
#: Bits that mark the ids of labelled texts, 2 MB in all.
SLOTS = 1 << 24
#: Scores are counted in this many steps to find thresholds.
SCORES = 1 << 12
#: Languages that a profile tells apart: the most frequent ones.
MOST_LANGUAGES = 1000
#: Rows of each embedding table.
BUCKETS = 1 << 16
#: First bytes of a word that have an embedding of their own.
PREFIXES = (3, 4, 6)
DIM, WIDTHS, FILTERS = 8, (1, 2, 3), 8
EPOCHS, BATCH, RATE = 12, 32, 0.05
#: Rows of the word profile that tells languages apart.
PROFILE = 1 << 12


class Model(NamedTuple):
    tables: np.ndarray  # kind, bucket, dim
    filters: np.ndarray  # dim, offset x filter
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: float
    languages: list[str]
    profile: np.ndarray  # bucket, language: log probabilities
    thresholds: np.ndarray  # by language


class Features:
    """Bucket numbers of words, by kind of embedding."""

    def __init__(self):
        self.hashers = (Hasher(11), Hasher(12))
        self.letters = letter_table()

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        return split_words(data, offsets, self.letters)

    def buckets(self, w: Words) -> np.ndarray:
        kinds = [h.words(w) for h in self.hashers]
        padded = np.concatenate([w.data, np.zeros(max(PREFIXES), np.uint8)])
        size = w.end - w.start
        value, done = np.zeros(len(size), np.uint64), 0
        for k, n in enumerate(PREFIXES):
            for j in range(done, n):
                byte = np.where(size > j, padded[w.start + j], 0).astype(np.uint64)
                value = value * np.uint64(257) + byte
            done = n
            kinds.append(mix(value + np.uint64((k + 1) << 56)))
        return np.stack([(k % np.uint64(BUCKETS)).astype(np.int32) for k in kinds])


def responses(model: Model, buckets: np.ndarray) -> np.ndarray:
    """Response of every filter part at every word: words x (offset, filter)."""
    return embedded(model.tables, buckets) @ model.filters


def embedded(tables: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Vectors of words: the sum of their embeddings of all kinds."""
    x = tables[0].take(buckets[0], axis=0)
    more = np.empty_like(x)
    for k in range(1, len(buckets)):
        x += tables[k].take(buckets[k], axis=0, out=more, mode="clip")
    return x


def summed(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ``at``, and for each the sum of its rows."""
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    return at[order][first], np.add.reduceat(rows[order], first, axis=0)


def parts(width_index: int) -> list[slice]:
    """Columns of ``filters`` that hold each offset of a width's filters."""
    first = sum(WIDTHS[:width_index])
    return [slice((first + j) * FILTERS, (first + j + 1) * FILTERS) for j in range(WIDTHS[width_index])]


def convolve(r: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Responses of each width's filters by position; where a filter would leave its text, the rest counts nothing."""
    out = []
    for k, width in enumerate(WIDTHS):
        cols = parts(k)
        c = r[:, cols[0]].copy()
        for j in range(1, width):
            edge = (first[1:, None] - np.arange(1, j + 1)).ravel()
            edge = edge[(edge >= 0) & (edge < len(r) - j)]
            inner = c[edge]
            c[:-j] += r[j:, cols[j]]
            c[edge] = inner
        out.append(c)
    return out


def pooled(model: Model, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest response of every filter in each text, at least 0; a text without words has zeros."""
    texts = len(first) - 1
    out = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        r = responses(model, buckets)
        for k, c in enumerate(convolve(r, first)):
            out[full, k * FILTERS: (k + 1) * FILTERS] = np.maximum.reduceat(c, first[:-1][full], axis=0)
    return np.maximum(out + model.filter_bias, 0)


def probability(model: Model, pool: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(pool @ model.weights + model.bias, -30, 30)))


def guess(model: Model, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of each text's language by the word profile; -1 without words."""
    texts, n = len(first) - 1, len(model.languages)
    out = np.full(texts, -1)
    full = np.flatnonzero(np.diff(first))
    if len(full) and n:
        logs = np.add.reduceat(model.profile[buckets[0] % PROFILE], first[:-1][full], axis=0)
        out[full] = logs.argmax(1)
    return out


def bend(p: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """Probabilities stretched so that ``threshold`` becomes one half."""
    return np.where(p < threshold, 0.5 * p / threshold, 0.5 + 0.5 * (p - threshold) / (1 - threshold))


def _features(f: Features, texts: pa.Array) -> Iterator[np.ndarray]:
    """Bucket numbers (kind, word) of each text."""
    data, at = text_bytes(lower_text(texts))
    for low, high in steps(at):
        w = f.words(data, at[low: high + 1])
        b = f.buckets(w)
        for i in range(high - low):
            yield b[:, w.first[i]: w.first[i + 1]]


def _text_features(texts: list[str | None]) -> list[np.ndarray]:
    return list(_features(Features(), pa.array(texts, pa.string())))


def _joined(feats: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Words of several texts side by side, and where each text begins."""
    return np.concatenate(feats, axis=1), np.concatenate([[0], np.cumsum([b.shape[1] for b in feats])])


#: The parts of a model that training moves.
MOVING = ("tables", "filters", "filter_bias", "weights")


def started(seed: int) -> tuple[Model, dict]:
    """A model before its first step, and the sums of squares that scale the steps."""
    rng = np.random.default_rng(seed)
    kinds, wide, pools = 2 + len(PREFIXES), sum(WIDTHS) * FILTERS, len(WIDTHS) * FILTERS
    model = Model(
        rng.normal(0, 0.05, (kinds, BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.5, (DIM, wide)).astype(np.float32),
        np.zeros(pools, np.float32), rng.normal(0, 0.3, pools).astype(np.float32), 0.0, [], np.zeros((PROFILE, 0), np.float32), np.zeros(0),
    )
    return model, {**{n: np.full_like(getattr(model, n), 1e-3) for n in MOVING}, "bias": 1e-3}


def constant(model: Model, share: float) -> Model:
    """The model that gives a share of toxic texts of 0 or 1 everywhere."""
    return model._replace(weights=np.zeros_like(model.weights), bias=30.0 * (2 * share - 1))


def step(model: Model, sums: dict, feats: list[np.ndarray], y: np.ndarray, balance: dict[int, float], rate: float) -> Model:
    """One step on some texts; arrays of ``model`` and ``sums`` change in place. Texts without words teach nothing."""
    full = [i for i, b in enumerate(feats) if b.shape[1]]
    if not full:
        return model
    y = y[full]
    buckets, first = _joined([feats[i] for i in full])
    tables, filters, weights, kinds, texts = model.tables, model.filters, model.weights, len(buckets), len(full)
    r = responses(model, buckets)
    pool = np.empty((texts, len(weights)), np.float32)
    where = np.empty((texts, len(weights)), np.int64)
    for k, c in enumerate(convolve(r, first)):
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        for i in range(texts):
            at = c[first[i]: first[i + 1]].argmax(0)
            where[i, cols] = first[i] + at
            pool[i, cols] = c[first[i] + at, np.arange(FILTERS)]
    pool += model.filter_bias
    active = pool > 0
    pool *= active
    p = probability(model, pool)
    g = (p - y) * np.where(y == 1, balance[1], balance[0]) / texts
    g_pool = np.outer(g, weights) * active
    g_filters = np.zeros_like(filters)
    rows, grads = [], []
    for k, width in enumerate(WIDTHS):
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        for j, part in enumerate(parts(k)):
            at = where[:, cols] + j
            ok = at < first[1:, None]
            at, gp = np.minimum(at, first[-1] - 1), g_pool[:, cols] * ok
            x = embedded(tables, buckets[:, at.ravel()]).reshape(*at.shape, DIM)
            g_filters[:, part] += np.einsum("tfd,tf->df", x, gp)
            rows.append(at.ravel())
            grads.append((gp[:, :, None] * filters[:, part].T[None]).reshape(-1, DIM))
    updates = (("filters", g_filters), ("filter_bias", g_pool.sum(0)), ("weights", pool.T @ g + 1e-4 * weights))
    for name, grad in updates:
        sums[name] += grad * grad
        getattr(model, name)[...] -= rate * grad / np.sqrt(sums[name])
    grad = float(g.sum())
    sums["bias"] += grad * grad
    bias = model.bias - rate * grad / sums["bias"] ** 0.5
    at, grad = np.concatenate(rows), np.concatenate(grads)
    some_rows, total = summed(grad, at)
    moved = np.abs(total).max(1) > 0
    some_rows, total = some_rows[moved], total[moved]
    if not len(some_rows):
        return model._replace(bias=bias)
    for kind in range(kinds):
        own, grad = summed(total, buckets[kind][some_rows])
        squares = sums["tables"][kind][own] + grad * grad
        sums["tables"][kind][own] = squares
        tables[kind][own] -= rate * grad / np.sqrt(squares)
    return model._replace(bias=bias)


def balanced(clean: int, toxic: int) -> dict[int, float]:
    """Weight of a text by its label, so that both labels weigh alike."""
    return {1: (clean + toxic) / 2 / max(1, toxic), 0: (clean + toxic) / 2 / max(1, clean)}


def train(texts: list[str | None], toxic: list[int], langs: list[str | None], seed: int = 3) -> Model:
    """Model of a few labelled texts, in this process. One in five is held back to calibrate the thresholds.

    With one label only, or no texts, the model gives its share of toxic texts (0 without texts) everywhere.
    """
    model, sums = started(seed)
    y = np.array(toxic, np.float32)
    if len(set(toxic)) < 2:
        return constant(model, float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed + 1)
    feats = _text_features(texts)
    held = np.arange(len(y)) % 5 == 4
    fit = np.flatnonzero(~held)
    balance = balanced(int((y[fit] == 0).sum()), int(y[fit].sum()))
    for epoch in range(EPOCHS):
        rng.shuffle(fit)
        for low in range(0, len(fit), BATCH):
            some = fit[low: low + BATCH]
            model = step(model, sums, [feats[i] for i in some], y[some], balance, RATE * (1 - epoch / EPOCHS))
    names = sorted({n for n in langs if n is not None})
    counts = np.zeros((len(names), PROFILE), np.int64)
    for f, name in zip(feats, langs):
        if name is not None:
            counts[names.index(name)] += np.bincount(f[0] % PROFILE, minlength=PROFILE)
    model = model._replace(languages=names, profile=profile_of(counts))
    back = np.flatnonzero(held)
    buckets, first = _joined([feats[i] for i in back])
    p, lang = probability(model, pooled(model, buckets, first)), guess(model, buckets, first)
    everywhere = best_threshold(p, y[back])
    found = [best_threshold(p[lang == k], y[back][lang == k], everywhere) for k in range(len(names))]
    return model._replace(thresholds=np.array([*found, everywhere]))


def profile_of(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of the profile's buckets from counts (language, bucket)."""
    smooth = counts.T + 1.0
    return np.log(smooth / smooth.sum(0)).astype(np.float32)


def best_threshold(p: np.ndarray, y: np.ndarray, default: float = 0.5, n: np.ndarray | None = None) -> float:
    """Threshold with the fewest wrong texts; of several, the middle of the widest gap between scores.

    ``n`` counts the texts of each entry (1 without it). Fewer than 20 texts of either label keep the default.
    """
    n = np.ones(len(p), np.int64) if n is None else n
    if min(n[y == 1].sum(), n[y == 0].sum()) < 20:
        return default
    order = np.argsort(p, kind="stable")
    p, y, n = p[order], y[order], n[order]
    misses = np.concatenate([[0], np.cumsum(n * (y == 1))])
    alarms = n[y == 0].sum() - np.concatenate([[0], np.cumsum(n * (y == 0))])
    edges = np.concatenate([[0], p, [1]])
    wrong, gap = misses + alarms, np.diff(edges)
    # Equal scores can't be told apart.
    best = np.flatnonzero((wrong == wrong[gap > 0].min()) & (gap > 0))
    k = best[gap[best].argmax()]
    return float(np.clip((edges[k] + edges[k + 1]) / 2, 0.02, 0.98))


def with_slots(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id may be one of ``marks``: hashes of those mark ``SLOTS`` bits, which are broadcast.

    A join on the ids follows. Texts without a label mostly stay where they lie instead of moving to it.
    """
    slot = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(SLOTS)) + 1
    bits = marks.select(slot.alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("_bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("_bits")
    )
    kept = docs.withColumn("slot", slot).withColumn("_bucket", F.expr("bitmap_bucket_number(slot)")).join(F.broadcast(bits), "_bucket")
    byte = F.expr("cast(conv(hex(substring(_bits, cast(bitmap_bit_position(slot) div 8 as int) + 1, 1)), 16, 10) as int)")
    return kept.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(slot) % 8 as int))")) != 0).select(*docs.columns)


def _packed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, lang, held, words) of every labelled text: bucket numbers as bytes, one text in five held back."""
    marks = labels.select("doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null")
    rows = with_slots(docs.select("doc_id", "text", "lang"), marks).join(marks, "doc_id")
    held = (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 4).alias("held")

    def make():
        f = Features()

        def derive(texts: pa.Array) -> list:
            return [pa.array([np.ascontiguousarray(b, np.uint16).tobytes() for b in _features(f, texts)], pa.binary())]

        return derive

    return map_rows(rows.select(F.col("toxic").cast("int").alias("toxic"), "lang", held, "text"), ["toxic", "lang", "held"], ["text"], make, "words binary")


def _unpacked(words: pa.Array) -> list[np.ndarray]:
    """Bucket numbers of the texts of a batch."""
    kinds = 2 + len(PREFIXES)
    return [np.frombuffer(w.as_buffer(), np.uint16).reshape(kinds, -1).astype(np.intp) for w in words]


def _word_counts(rows: DataFrame, names: list[str]) -> np.ndarray:
    """Words of all texts by language and profile bucket."""
    def make():
        at = {name: k for k, name in enumerate(names)}

        def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            counts = {}
            for low in range(0, batch.num_rows, BATCH * 8):
                some = batch.slice(low, BATCH * 8)
                for lang, f in zip(some.column("lang").to_pylist(), _unpacked(some.column("words"))):
                    if lang in at:
                        own = counts.setdefault(at[lang], np.zeros(PROFILE, np.int64))
                        own += np.bincount(f[0] % PROFILE, minlength=PROFILE)
            for k, own in counts.items():
                bins = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bins), k)), pa.array(bins), pa.array(own[bins])], names=["lang", "bin", "n"])

        return count

    found = map_arrow(rows.select("lang", "words"), make, "lang bigint, bin bigint, n bigint")
    table = found.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(names), PROFILE), np.int64)
    counts[table["lang"].to_numpy(), table["bin"].to_numpy()] = table["n"].to_numpy()
    return counts


MOVES = "part int, bias double, kept double, tables binary, touched binary, filters binary"


def _flat(values: Model | dict) -> np.ndarray:
    get = values.get if isinstance(values, dict) else lambda n: getattr(values, n)
    return np.concatenate([get(n).ravel() for n in MOVING[1:]])


def _epoch(rows: DataFrame, model: Model, sums: dict, balance: dict[int, float], rate: float) -> tuple[Model, dict]:
    """The common model and sums after every task went through its texts once.

    An embedding takes the mean move of the tasks that moved it, everything else the mean of all tasks with texts.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((model._replace(profile=model.profile[:, :0]), sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        old, old_sums = shared.value
        new, kept, seen = None, None, 0
        for batch in batches:
            if new is None and batch.num_rows:
                new = old._replace(**{n: getattr(old, n).copy() for n in MOVING})
                kept = {n: v.copy() if isinstance(v, np.ndarray) else v for n, v in old_sums.items()}
            for low in range(0, batch.num_rows, BATCH):
                some = batch.slice(low, BATCH)
                new = step(new, kept, _unpacked(some.column("words")), some.column("toxic").to_numpy().astype(np.float32), balance, rate)
            seen += batch.num_rows
        if not seen:
            return
        touched = np.flatnonzero((kept["tables"] != old_sums["tables"]).any(-1).ravel())
        moves = [(x.reshape(-1, DIM)[touched] - y.reshape(-1, DIM)[touched]) for x, y in ((new.tables, old.tables), (kept["tables"], old_sums["tables"]))]
        dense = [_flat(new) - _flat(old), _flat(kept) - _flat(old_sums)]
        yield pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([new.bias - old.bias]), pa.array([kept["bias"] - old_sums["bias"]]),
            pa.array([np.concatenate(moves).tobytes()], pa.binary()), pa.array([touched.astype(np.int32).tobytes()], pa.binary()),
            pa.array([np.concatenate(dense).tobytes()], pa.binary()),
        ], names=["part", "bias", "kept", "tables", "touched", "filters"])

    scratch = Scratch(spark)
    moved, _ = scratch.cut(rows.coalesce(TASKS).mapInArrow(run, MOVES))
    size = model.tables.size // DIM
    tables, times = np.zeros((2, size, DIM), np.float32), np.zeros(size, np.int32)
    dense, biases, tasks = np.zeros((2, len(_flat(model)))), np.zeros(2), 0
    for r in moved.toLocalIterator():  # ``TASKS`` models at most, one file at a time
        at = np.frombuffer(r["touched"], np.int32)
        tables[:, at] += np.frombuffer(r["tables"], np.float32).reshape(2, len(at), DIM)
        times[at] += 1
        dense += np.frombuffer(r["filters"], np.float32).reshape(2, -1)
        biases, tasks = biases + (r["bias"], r["kept"]), tasks + 1
    scratch.release()
    shared.destroy()
    if not tasks:
        return model, sums
    tables /= np.maximum(times, 1).astype(np.float32)[:, None]
    out = []
    for k, old in enumerate((model, sums)):
        get = old.get if isinstance(old, dict) else lambda n, old=old: getattr(old, n)
        new, low = {"tables": get("tables") + tables[k].reshape(model.tables.shape)}, 0
        for n in MOVING[1:]:
            v = get(n)
            new[n] = (v + dense[k][low: low + v.size].reshape(v.shape) / tasks).astype(np.float32)
            low += v.size
        out.append({**new, "bias": float(get("bias") + biases[k] / tasks)})
    return model._replace(**out[0]), out[1]


def _thresholds(rows: DataFrame, model: Model) -> np.ndarray:
    """Threshold of each language, and the one of all texts, from the scores of all ``rows`` in ``SCORES`` steps."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            keys = []
            for low in range(0, batch.num_rows, BATCH * 8):
                some = batch.slice(low, BATCH * 8)
                buckets, first = _joined(_unpacked(some.column("words")))
                p = probability(model, pooled(model, buckets, first)).astype(np.float64)
                at = np.minimum((p * SCORES).astype(np.int64), SCORES - 1)
                keys.append(((guess(model, buckets, first) + 1) * SCORES + at) * 2 + some.column("toxic").to_numpy())
            found, n = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["at", "n"])

        return count

    table = map_arrow(rows.select("toxic", "words"), make, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").toArrow()
    shared.destroy()
    at, n = table["at"].to_numpy(), table["n"].to_numpy()
    y, p, lang = at % 2, (at // 2 % SCORES + 0.5) / SCORES, at // 2 // SCORES - 1
    everywhere = best_threshold(p, y, n=n)
    found = [best_threshold(p[lang == k], y[lang == k], everywhere, n[lang == k]) for k in range(len(model.languages))]
    return np.array([*found, everywhere])


def learn(docs: DataFrame, labels: DataFrame, seed: int = 3) -> Model:
    """Model from (doc_id, text, lang) and (doc_id, toxic): all labelled rows, whole texts.

    Labelled texts are written once as bucket numbers under the shared folder; every epoch, the word profile and the
    thresholds read them there. One text in five, by its id, is held back for the thresholds. Labels other than 0 and 1
    and labels without a document teach nothing. With one label only, or no texts, the model gives its share of toxic
    texts (0 without texts) everywhere.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    path = f"{scratch.folder}/texts"
    packed = _packed(docs, labels)
    packed.write.option("compression", "zstd").parquet(path)
    texts = spark.read.schema(packed.schema).parquet(path)
    sizes = {(r["toxic"], r["held"]): r["n"] for r in texts.groupBy("toxic", "held").agg(F.count(F.lit(1)).alias("n")).collect()}
    model, sums = started(seed)
    by_label = [sum(n for (y, _), n in sizes.items() if y == k) for k in (0, 1)]
    if not all(by_label):
        delete(spark, scratch.folder)
        return constant(model, by_label[1] / max(1, sum(by_label)))
    fit = texts.where("not held")
    balance = balanced(sizes.get((0, False), 0), sizes.get((1, False), 0))
    for epoch in range(EPOCHS):
        model, sums = _epoch(fit, model, sums, balance, RATE * (1 - epoch / EPOCHS))
    known = texts.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    names = sorted(r["lang"] for r in known.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect())
    model = model._replace(languages=names, profile=profile_of(_word_counts(texts, names)))
    model = model._replace(thresholds=_thresholds(texts.where("held"), model))
    delete(spark, scratch.folder)
    return model


def classify(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of the whole text of every row.

    NULL and empty texts, and texts without letters, get the score of no responses at all. Every row is judged on
    its own, so repeated rows repeat their result.
    """

    def make():
        f = Features()
        thresholds = model.thresholds if len(model.thresholds) else np.array([0.5])

        def derive(texts: pa.Array) -> list:
            data, at = text_bytes(lower_text(texts))
            score = np.empty(len(texts))
            for low, high in steps(at, 1 << 18):
                w = f.words(data, at[low: high + 1])
                b = f.buckets(w)
                p = probability(model, pooled(model, b, w.first))
                score[low:high] = bend(p.astype(np.float64), thresholds[guess(model, b, w.first)])
            return [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]

        return derive

    return map_rows(df, keep, [text], make, "score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from labelled ones whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", id_crc("doc_id") % 5 == 0)
    labels = table(spark, sf_dir, "labels").where(id_crc("doc_id") % 5 != 0)
    return classify(docs, learn(docs.where("not held_out"), labels), ["doc_id", "held_out"])
