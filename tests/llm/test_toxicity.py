import random

import numpy as np
import pytest

from adgrove.llm import toxicity

BAD = ("vermin", "scoundrel", "wretch")


def texts(n, seed):
    rng = random.Random(seed)
    syllables = ["ba", "ko", "ri", "tu", "ne", "sa", "lo"]
    out = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(("", "s", ",", "ish")))
        text = " ".join(words)
        out.append((i, text.upper() if rng.random() < 0.1 else text, rng.choice(("en", None)), int(bad)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = texts(1200, 1)
    return toxicity.train([r[1] for r in rows], [r[3] for r in rows], [r[2] for r in rows])


def test_new_texts_are_told_apart(spark, model):
    rows = texts(400, 2)
    df = spark.createDataFrame([(d, t, 9.0, y) for d, t, _, y in rows], "doc_id bigint, text string, score double, y int")
    got = toxicity.classify(df, model, ["doc_id", "y", "score"]).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert np.mean([r.predicted == r.y for r in got]) > 0.95
    assert np.mean([r.predicted for r in got if r.y == 0]) < 0.02


def test_edge_cases(spark, model):
    rows = [(1, None), (2, ""), (3, "... 。"), (4, "bako " * 100_000), (5, "bako wretch scoundrel"), (5, "bako wretch scoundrel"),
            (None, "ri"), (6, "中文" * 30)]
    got = {}
    for r in toxicity.classify(spark.createDataFrame(rows, "doc_id bigint, text string"), model, ["doc_id"]).collect():
        assert got.setdefault(r.doc_id, (r.score, r.predicted)) == (r.score, r.predicted)
    assert got[1] == got[2] == (pytest.approx(got[2][0]), 0)
    assert got[4][1] == 0 and got[5][1] == 1 and len(got) == 7
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert toxicity.classify(empty, model, ["doc_id"]).collect() == []


def test_scores_do_not_depend_on_other_rows(model):
    rows = [r[1] for r in texts(50, 3)] + [None, "", "a"]
    f = toxicity._text_features(rows)
    alone = [toxicity.probability(model, toxicity.pooled(model, b, np.array([0, b.shape[1]])))[0] for b in f]
    first = np.concatenate([[0], np.cumsum([b.shape[1] for b in f])])
    together = toxicity.probability(model, toxicity.pooled(model, np.concatenate(f, axis=1), first))
    assert np.allclose(alone, together, atol=1e-6)


@pytest.mark.parametrize("labels,score", [([], 0.0), ([0, 0], 0.0), ([1, 1], 1.0)])
def test_one_label(spark, labels, score):
    docs = spark.createDataFrame([(i, "a b", "en") for i in range(len(labels))], "doc_id bigint, text string, lang string")
    marks = [*enumerate(labels), (0, None), (1, 7), (None, 1), (99, 1)]
    model = toxicity.learn(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    got = toxicity.classify(spark.createDataFrame([(1, "c")], "doc_id bigint, text string"), model, ["doc_id"]).first()
    assert got.score == pytest.approx(score, abs=1e-6) and got.predicted == round(score)


def test_thresholds():
    p, y = np.linspace(0, 1, 100), np.array([0] * 60 + [1] * 40)
    assert p[59] < toxicity.best_threshold(p, y) <= p[60]
    assert toxicity.best_threshold(p, np.zeros(100), 0.7) == 0.7
    assert toxicity.bend(np.array([0.0, 0.2, 1.0]), np.array([0.2] * 3)).tolist() == [0, 0.5, 1]


def test_all_labelled_texts_teach(spark):
    rows = texts(4000, 4)
    rows = [(d, t, f"rare{d}" if d % 130 == 1 else "en", y) for d, t, _, y in rows]
    docs = spark.createDataFrame([r[:3] for r in rows] + [(d + 10_000, "bako ri", "en") for d in range(3000)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(d + 10_000, 0) for d in range(3000)], "doc_id bigint, toxic int")
    model = toxicity.learn(docs.repartition(3), labels)
    assert model.languages == sorted({r[2] for r in rows})
    new = spark.createDataFrame([(d, t, y) for d, t, _, y in texts(400, 5)], "doc_id bigint, text string, y int")
    got = toxicity.classify(new, model, ["y"]).collect()
    assert np.mean([r.predicted == r.y for r in got]) > 0.95


def test_counted_scores_give_the_same_threshold():
    p, y = np.array([0.1, 0.1, 0.3, 0.6, 0.6]), np.array([0, 1, 0, 1, 0])
    n = np.array([50, 3, 20, 40, 2])
    assert toxicity.best_threshold(p, y, n=n) == pytest.approx(toxicity.best_threshold(np.repeat(p, n), np.repeat(y, n))) == pytest.approx(0.45)
