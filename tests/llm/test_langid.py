from adgrove.llm import langid

EN = "the house of the old king was near the river and the people of the town were with him"
FR = "la maison du vieux roi était près de la rivière et les gens de la ville étaient avec lui"


def predict(spark, rows, content, ddl="doc_id bigint, text string, score string", keep=("doc_id",)):
    out = langid.predict(spark.createDataFrame(rows, ddl), content, keep=keep)
    return [tuple(r) for r in out.orderBy("doc_id").collect()]


def learn(spark, rows):
    return langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_languages_and_edge_cases(spark):
    content = learn(spark, [(1, EN, "en"), (2, FR, "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 34", "de"), (6, EN, None),
                            (None, EN, "en")])
    assert list(content) == ["en", "fr"]
    long = " ".join([FR] * 3000)
    got = predict(spark, [(1, "the people of the river", "x"), (2, "les gens de la rivière", "x"), (3, None, "x"), (4, "", "x"),
                          (5, "12 %% 34", "x"), (6, long, "x"), (7, "the people of the river", "x"),
                          (7, "the people of the river", "x")], content)
    assert [g[:2] for g in got] == [(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (6, "fr"), (7, "en"), (7, "en")]
    assert all(0 <= g[2] <= 1 for g in got) and got[2][2:] == (0.0, False) and got[0][3]
    assert got[6] == got[7]


def test_narrow_margins_are_not_accepted(spark):
    content = {"a": langid.normal(EN), "b": langid.normal(EN)}
    assert predict(spark, [(1, "the house of the king", "")], content) == [(1, "a", 0.0, False)]


def test_nothing_learned_and_no_rows(spark):
    assert learn(spark, []) == {}
    assert predict(spark, [(1, EN, "")], {}) == [(1, "und", 0.0, False)]
    assert predict(spark, [], {"en": b"x"}) == []
    assert predict(spark, [(1, EN, "")], {"en": b"the house"}) == [(1, "en", 1.0, True)]


def test_more_languages_than_are_learned(spark, monkeypatch):
    rows = [(i, f"word{'abcdefghij'[i % 10]} text", f"l{i:04d}") for i in range(1100)]
    rows += [(2000 + i, "more of it", f"l{i:04d}") for i in range(1050, 1100)] + [(3000, "no label", None), (3001, "12", "l9999")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    content = langid.learn(df)
    assert list(content) == [f"l{i:04d}" for i in [*range(1050, 1100), *range(950)]]
    assert content["l1050"] == b" worda text  more of it " and content["l0001"] == b" wordb text "
