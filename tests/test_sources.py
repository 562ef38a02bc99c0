import json

import pytest
from pyspark.sql import functions as F

from adgrove.operators import words
from adgrove.operators.spaces import HashSpace, MixedSpace, VectorSpace
from adgrove.plans import clusters
from adgrove.sources import readers, schemas, writers


def lines(path):
    out = []
    for f in sorted(path.glob("part-*")):
        out += f.read_text().splitlines()
    return out


def test_lines_keep_file_order(spark, tmp_path):
    p = tmp_path / "x.txt"
    p.write_text("".join(f"row {i}\n" for i in range(500)))
    rows = readers.numbered_lines(spark, str(p)).orderBy("line").collect()
    assert [(r.line, r.value) for r in rows] == [(i, f"row {i}") for i in range(500)]


def test_lines_of_many_files_and_splits_stay_where_they_are(spark, tmp_path):
    want = []
    for f, n in (("a", 300), ("b", 0), ("c", 1), ("d", 700)):
        rows = [f"{f} {'x' * (i % 37)} {i}" for i in range(n)]
        (tmp_path / f).write_text("".join(r + "\n" for r in rows[:-1]) + (rows[-1] if rows else ""))
        want += rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = readers.numbered_lines(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 5
        assert [(r.line, r.value) for r in got.orderBy("line").collect()] == list(enumerate(want))
        plan = got._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
        assert moved and not any("value#" in line for line in moved)
        assert "Scan text" in plan.split("BroadcastHashJoin")[1].split("Exchange")[0]  # lines come straight from the files
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_zip_lines(spark, tmp_path):
    for name, n in (("a", 3), ("b", 3), ("c", 2)):
        (tmp_path / name).write_text("".join(f"{name}{i}\n" for i in range(n)))
    a, b, c = (readers.numbered_lines(spark, str(tmp_path / n)) for n in "abc")
    assert [(r.left, r.right) for r in readers.zip_lines(a, b).orderBy("line").collect()] == [("a0", "b0"), ("a1", "b1"), ("a2", "b2")]
    with pytest.raises(Exception, match="differ in length"):
        readers.zip_lines(a, c).collect()


def test_hash_and_history_files(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("a1\thttp://x\t7\na2\thttp://y\t0\na3\thttp://z\t9\n")
    assert [(r.aid, r.hash) for r in readers.read_hashes(spark, str(tmp_path / "h.tsv")).orderBy("idx").collect()] == [("a1", 7), ("a3", 9)]
    (tmp_path / "c.tsv").write_text("a\tu\tn\t0\t0\t12\t0\tw\turl\t77\tcity\n")
    assert tuple(readers.read_history(spark, str(tmp_path / "c.tsv")).first()) == (0, 77, 12)


def test_json_ads_to_cluster_file(spark, tmp_path):
    ads = [
        {"aid": "1", "hash": 12, "url": "u", "wordlist": ["x", "y"], "industry_type": ["a", "b", "c", "d"]},
        {"aid": "2", "hash": 12, "uname": "n", "industry_type": ["a", "b", "c", "d"]},
        {"aid": "3", "hash": 99, "industry_type": ["a", "b", "c", "e"]},
    ]
    (tmp_path / "ads.json").write_text(json.dumps(ads))
    df = readers.read_ads(spark, str(tmp_path / "ads.json")).withColumn("idx", F.col("aid").cast("long"))
    rows, summary = clusters.cluster_ads(df, HashSpace(0.1, 16), 2, industry="d", level=3, start_id=4)
    writers.write_clusters(rows, str(tmp_path / "out"))
    assert lines(tmp_path / "out") == [
        "1\tnull\tnull\t0\t0\t4\t0\tx,y\tu\t12\tnull", "2\tnull\tn\t0\t0\t4\t0\t\tnull\t12\tnull",
    ]
    assert summary.first().next_id == 5
    back = readers.read_clusters(spark, str(tmp_path / "out"))
    assert back.columns == ["idx", *schemas.CLUSTER_COLUMNS] and back.count() == 2


def test_embeddings_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "u", [1.5, -2.0])], "aid string, url string, vector array<double>")
    writers.write_embeddings(df, str(tmp_path / "e"))
    assert lines(tmp_path / "e") == ["a\tu\t1.5,-2.0"]
    back = readers.read_embeddings(spark, str(tmp_path / "e"), vector=2)
    assert back.first().vector == [1.5, -2.0]
    rows, _ = clusters.cluster_embeddings(back, VectorSpace(1.0, 2), 1)
    writers.write_short_clusters(rows, str(tmp_path / "s"))
    assert lines(tmp_path / "s") == ["a\tu\t1"]


def test_word_values_round_trip(spark, tmp_path):
    writers.write_word_values(spark.createDataFrame([("贷款", 0.5)], "word string, value double"), str(tmp_path / "w"))
    assert tuple(readers.read_word_values(spark, str(tmp_path / "w")).first()) == ("贷款", 0.5)


def test_debug_extract_and_truncate(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("c", 2)], "sub_brand string, x int")
    writers.write_debug(df, str(tmp_path / "d"), ["b"])
    assert lines(tmp_path / "d") == ["b,1"]
    df.write.parquet(str(tmp_path / "t"))
    writers.truncate(spark, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 0


def test_day_reader(spark, tmp_path):
    df = spark.createDataFrame([(20210901, 1), (20210902, 2)], "partition_date int, x int")
    writers.write_days(df, str(tmp_path / "t"))
    assert [r.x for r in readers.read_day(spark, str(tmp_path / "t"), 20210902, view="today").collect()] == [2]
    assert spark.table("today").count() == 1


def cluster_file(spark, rows):
    full = [(i, f"a{i}", uid, name, "0", "0", cid, "0", "w", "u", "1", "c") for i, (uid, name, cid) in enumerate(rows)]
    return spark.createDataFrame(full, "idx bigint, " + ", ".join(f"{c} string" for c in schemas.CLUSTER_COLUMNS))


def test_refinement_skips_small_clusters(spark):
    rows = [("u1", "n1", "7")] * 3 + [("u2", "n2", "7"), ("u1", "n3", "7")] + [("u", "n", "8")] * 3 + [("u", "n", "9")] * 4
    space = MixedSpace(0.15, user_weight=1, company_weight=1, known_users=True)
    out, _ = clusters.refine_clusters(cluster_file(spark, rows), space, 2)
    got = {r.idx: r.cluster_id for r in out.collect()}
    assert got == {0: "7_1", 1: "7_1", 2: "7_1", 3: "7_2", 4: "7_3", 8: "9_1", 9: "9_1", 10: "9_1", 11: "9_1"}


def test_names_are_numbered_by_first_appearance(spark):
    out = clusters.refine_by_name(cluster_file(spark, [("u", "z", "1"), ("u", "a", "1"), ("u", "z", "2")]))
    assert [r.cluster_id for r in out.orderBy("idx").collect()] == ["1_1", "1_2", "2_1"]


def test_idf_counts_occurrences(spark):
    docs = spark.createDataFrame([(["贷款", "贷款", "x"],), (["贷款"],), (["保险"],)], "wordlist array<string>")
    assert {r.word: r["count"] for r in words.word_counts(docs).collect()} == {"贷款": 3, "保险": 1}
    idf = {r.word: r.idf for r in words.idf_from_documents(docs).collect()}
    assert idf["贷款"] == 0.0 and idf["保险"] > 0
    assert tuple(words.word_diagnostics(docs).first()) == (3, 1, 2, 3)
    counts = spark.createDataFrame([("贷款", 32711.0), ("保险", 5.0), ("x", 1.0)], "word string, value double")
    local = spark.createDataFrame([("保险", 0.25)], "word string, value double")
    assert {r.word: r.idf for r in words.idf_from_counts(counts, local).collect()} == {"贷款": 0.0, "保险": 0.25}


def test_distance_profile_and_ranks(spark):
    import sequential as seq

    hashes = [(i * 37) % 64 for i in range(21)]
    df = spark.createDataFrame([(i, h, f"u{i}") for i, h in enumerate(hashes)], "idx bigint, hash bigint, url string")
    got = {r.probe: r for r in clusters.distance_profile(df, HashSpace(0.3, 8)).collect()}
    assert set(got) == {0, 5, 10, 16, 20}
    for probe, row in got.items():
        d = [seq.hash_distance(hashes[probe], h) for h in hashes]
        s = sorted(d)
        assert row.head == s[:50:5] and row.total == pytest.approx(sum(d)) and row.points == 21
        assert (row.q0, row.q1, row.q2, row.q3, row.q4) == (s[0], s[5], s[10], s[-5], s[-1])
        assert (row.probe_label, row.nearest_label) == (f"u{probe}", f"u{d.index(min(d))}")
    ranks = clusters.distance_ranks(df, HashSpace(0.3, 8), 3, head=2, step=6).orderBy("rank").collect()
    s = sorted(seq.hash_distance(hashes[3], h) for i, h in enumerate(hashes) if i != 3)
    assert [(r["rank"], r.d) for r in ranks] == [(0, s[0]), (1, s[1]), (6, s[6]), (12, s[12]), (18, s[18])]
