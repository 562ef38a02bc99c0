import random

import numpy as np
import pytest

from adgrove.operators import text_model as m

WORDS = {"sport": "ball goal team match win cup".split(), "food": "rice soup salt cook dish win".split(), "law": "court judge act case law cup".split()}


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label = rng.choice(list(WORDS))
        out.append((i, label, [rng.choice(WORDS[label]) for _ in range(rng.randint(1, 9))] + [f"x{rng.randrange(300)}"]))
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "id bigint, label string, words array<string>").repartition(parts)


def numeric(words, offsets, labels, e, w):
    """Loss of the texts, plainly."""
    loss = 0.0
    for k, y in enumerate(labels):
        ids = words[offsets[k]: offsets[k + 1]]
        h = e[ids].mean(0) if len(ids) else np.zeros(e.shape[1])
        z = w @ h
        loss += np.log(np.exp(z - z.max()).sum()) + z.max() - z[y]
    return loss


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    e, w = rng.normal(0, .5, (7, 4)), rng.normal(0, .5, (3, 4))
    words, offsets, labels = np.array([0, 1, 1, 6, 3, 2]), np.array([0, 3, 3, 6]), np.array([0, 2, 1])
    by_words, by_weights, loss = m.gradient(words, offsets, labels, e, w)
    assert loss == pytest.approx(numeric(words, offsets, labels, e, w), rel=1e-4)
    for grad, values, unit in ((by_words, e, m.GRID), (by_weights, w, m.FINE * m.GRID)):
        for at in np.ndindex(values.shape):
            moved = values.copy()
            moved[at] += 1e-5
            up = numeric(words, offsets, labels, *((moved, w) if values is e else (e, moved)))
            assert grad[at] / unit == pytest.approx((up - numeric(words, offsets, labels, e, w)) / 1e-5, abs=1e-3)


def plain(rows, dim, buckets, epochs, rate, seed, number):
    """The same training with numpy alone."""
    rng = np.random.default_rng(seed)
    e = np.rint(rng.uniform(-1 / dim, 1 / dim, (buckets, dim)) * m.GRID) / m.GRID
    labels = sorted({r[1] for r in rows})
    w, moments = np.zeros((len(labels), dim)), None
    ids = [[number[x] for x in r[2]] for r in rows]
    offsets, flat = np.concatenate([[0], np.cumsum([len(i) for i in ids])]), np.array(sum(ids, []))
    y = np.array([labels.index(r[1]) for r in rows])
    for step in range(1, epochs + 1):
        by_words, by_weights, _ = m.gradient(flat, offsets, y, e, w)
        slope = np.concatenate([by_words / (len(rows) * m.GRID), by_weights / (len(rows) * m.FINE * m.GRID)])
        both, moments = m._moved(np.concatenate([e, w]), slope, moments, step, rate)
        e, w = both[:buckets], both[buckets:]
    return e, w


def test_training_equals_plain_numpy_and_ignores_the_split(spark, monkeypatch):
    monkeypatch.setattr(m, "SLICE", 100)
    monkeypatch.setattr(m, "FAN", 2)
    rows = texts(120, 2)
    args = dict(dim=8, buckets=64, epochs=6, rate=0.05, seed=3)
    one = m.train(frame(spark, rows, 1), **args)
    monkeypatch.setattr(m, "BATCH", 7)
    other = m.train(frame(spark, rows[::-1], 5), **args)
    assert (one.embeddings == other.embeddings).all() and (one.weights == other.weights).all()
    words = sorted({x for r in rows for x in r[2]})
    number = {r.w: r.at for r in spark.createDataFrame([(x,) for x in words], "w string").selectExpr("w", "cast(pmod(xxhash64(w), 64) as int) as at").collect()}
    e, w = plain(rows, number=number, **args)
    assert (one.embeddings == e).all() and (one.weights == w).all()
    assert one.losses == pytest.approx(other.losses) and one.losses[-1] < one.losses[0]


def test_held_out_quality_shares_and_odd_rows(spark):
    rows = texts(500, 5)
    odd = [(900, "food", []), (901, "food", None), (902, None, ["ball"])]
    model = m.train(frame(spark, rows[:400] + odd), dim=16, buckets=256, epochs=12, shares=3)
    assert model.labels == ("food", "law", "sport") and len(model.losses) == 12
    r = m.quality(model, frame(spark, rows[400:])).first()
    assert (r.examples, r.labels) == (100, 3) and r.precision == r.correct / 100 > 0.9
    out = model.apply(frame(spark, odd), ["id", "label"]).orderBy("id").collect()
    assert [len(x.vector) for x in out] == [16] * 3 and out[0].vector == [0.0] * 16 and out[2].predicted == "sport"


def test_no_rows(spark):
    model = m.train(frame(spark, []), dim=4, buckets=8, epochs=2)
    assert model.labels == () and model.losses == ()


def test_frequent_words_go_through_products():
    from adgrove.operators import text_model as t

    rng = np.random.default_rng(2)
    offsets = np.concatenate([[0], np.cumsum(rng.integers(0, 40, 200))])
    words = np.minimum(rng.geometric(0.02, offsets[-1]), 499).astype(np.int32)
    ids, counts, rest, text = t._split(words, offsets, 500)
    assert 0 < len(ids) < 500 and 0 < len(rest) < len(words) / 4
    embeddings = np.rint(rng.normal(0, 1, (500, 8)) * t.GRID) / t.GRID
    weights = np.rint(rng.normal(0, 1, (3, 8)) * t.GRID) / t.GRID
    labels = rng.integers(0, 3, 200)
    found, n = t.means(words, offsets, embeddings)
    want = [embeddings[words[a:b]].sum(0) / max(1, b - a) for a, b in zip(offsets, offsets[1:])]
    assert np.array_equal(found, np.rint(np.array(want) * t.GRID) / t.GRID) and n.sum() == len(words)
    p = t.probabilities(found, weights)
    p[np.arange(200), labels] -= 1
    each = np.rint((np.rint(p * t.FINE) / t.FINE) @ weights / np.maximum(n, 1)[:, None] * t.GRID).astype(np.int64)
    by_words = np.zeros((500, 8), np.int64)
    np.add.at(by_words, words, np.repeat(each, n, axis=0))
    assert np.array_equal(t.gradient(words, offsets, labels, embeddings, weights)[0], by_words)
