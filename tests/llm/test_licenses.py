import random

import pytest

from adgrove.llm import licenses
from adgrove.llm.licenses import SHINGLE, THRESHOLD, Template, WORDS

NAMES = dict(licenses.TEMPLATES)


def scan(spark, rows, ddl="doc_id bigint, text string, license string, start int", **options):
    return {(r.doc_id, r.license): (r.containment, r.first_word, r.n_windows)
            for r in licenses.scan(spark.createDataFrame(rows, ddl), **options).collect()}


def brute(rows, templates=licenses.TEMPLATES, threshold=THRESHOLD):
    out = {}
    for d, text, *_ in rows:
        words = WORDS.findall((text or "").lower())
        for name, notice in templates:
            t = Template(name, notice, threshold)
            want = {tuple(t.words[i:i + SHINGLE]) for i in range(len(t.words) - SHINGLE + 1)}
            for start in range(0, max(1, len(words) - SHINGLE + 1), -(-t.window // 8)):
                part = words[start:start + t.window]
                has = {tuple(part[i:i + SHINGLE]) for i in range(len(part) - SHINGLE + 1)}
                share = len(want & has) / len(want)
                if share >= threshold:
                    best = out.get((d, name), (0, 0, 0))
                    out[d, name] = (max(share, best[0]), start if share > best[0] else best[1], best[2] + 1)
    return out


def test_notices_in_all_places_and_forms(spark):
    rng = random.Random(4)
    filler = ["the", "license", "software", "version", "old", "permission", "copy", "é", "0"]
    rows = []
    for i in range(160):
        parts = [" ".join(rng.choice(filler) for _ in range(rng.randint(0, 40))) for _ in range(3)]
        for k in (1, 2):
            words = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.choice((0, 0, 1, 2, 6))):
                words[rng.randrange(len(words))] = rng.choice(filler)
            parts.insert(k, rng.choice(("\n", " ** ", ", ")).join(words).upper() if rng.random() < 0.2 else " ".join(words))
        rows.append((i, " ".join(parts), "x", 0))
    got = scan(spark, rows)
    assert got == brute(rows) and len(got) > 150


def test_edge_cases(spark):
    mit = NAMES["MIT"]
    rows = [(1, None, "", 0), (2, "", "", 0), (3, "released under", "", 0), (4, "the " * 60_000 + mit, "", 0), (5, mit, "", 0),
            (5, mit, "", 0), (None, mit, "", 0), (6, mit.replace("MIT", "BSD"), "", 0)]
    got = scan(spark, rows)
    assert set(got) == {(4, "MIT"), (5, "MIT"), (None, "MIT")}
    assert got[5, "MIT"] == (1.0, 0, 2) and got[None, "MIT"] == (1.0, 0, 1)
    assert scan(spark, []) == {}


def test_templates_are_checked(spark):
    with pytest.raises(ValueError):
        scan(spark, [], templates=[("x", "all rights reserved")])
    with pytest.raises(ValueError):
        scan(spark, [], templates=[("x", NAMES["MIT"])] * 2)


def test_no_python_on_the_executors(spark):
    df = licenses.scan(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"))
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
