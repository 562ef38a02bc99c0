import random

import pytest
import sequential as seq
from pyspark.sql import functions as F

from adgrove.operators import skew
from adgrove.operators.block_index import assign_batch, compact, create_index, load_history, open_index, touched
from adgrove.operators.pairs import distinct_keys
from adgrove.operators.scratch import Scratch
from adgrove.operators.spaces import HashSpace

BITS, EPS = 12, 0.2


def hashes(rng, n):
    centres = [rng.getrandbits(BITS) for _ in range(6)]
    return [rng.choice(centres) ^ (1 << rng.randrange(BITS) if rng.random() < 0.6 else 0) if rng.random() < 0.7 else rng.getrandbits(BITS)
            for _ in range(n)]


def frame(spark, values, first=0):
    return spark.createDataFrame([(first + 3 * i, h) for i, h in enumerate(values)], "idx bigint, hash bigint")


@pytest.mark.parametrize("seed, limit", [(0, 4096), (1, 3)])
def test_batches_in_sequence_equal_one_sequential_run(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 10)
    rng = random.Random(seed)
    known = [(h, rng.randint(1, 9)) for h in hashes(rng, 25 if seed else 0)]
    path = Scratch(spark).folder
    index = create_index(spark, path, HashSpace(EPS, BITS), 1000, slots=16)
    load_history(index, spark.createDataFrame([(i, h, c) for i, (h, c) in enumerate(known)], "pos bigint, hash bigint, cluster_id int"))
    items, got = hashes(rng, 45), []
    want, start, next_id = seq.assign(items, known, seq.hash_distance, EPS)
    for n, (low, high) in enumerate([(0, 20), (20, 20), (20, 45)]):
        index = open_index(spark, path)
        result = assign_batch(index, frame(spark, items[low:high]), f"day-{n}", limit)
        got += [r.cluster_id for r in result.points.orderBy("idx").collect()]
        bounds = result.bounds.first()
        if n == 0:
            assert bounds.start_id == start
        # The same batch again has its ids and adds nothing.
        again = assign_batch(index, frame(spark, items[low:high]), f"day-{n}", limit)
        assert again.points.orderBy("idx").collect() == result.points.orderBy("idx").collect() and again.bounds.first() == bounds
    assert got == want and bounds.next_id == next_id
    more = hashes(rng, 10)
    merged = compact(index, spark, Scratch(spark).folder)
    want, _, _ = seq.assign(more, known + list(zip(items, got)), seq.hash_distance, EPS)
    for i in (merged, index):
        assert [r.cluster_id for r in assign_batch(i, frame(spark, more), "later").points.orderBy("idx").collect()] == want


def test_a_batch_reads_its_blocks_only(spark):
    rng = random.Random(7)
    space = HashSpace(0.1, 40)
    index = create_index(spark, Scratch(spark).folder, space, 10_000, slots=64)
    history = [rng.getrandbits(40) for _ in range(400)]
    load_history(index, spark.createDataFrame([(i, h, i) for i, h in enumerate(history)], "pos bigint, hash bigint, cluster_id int"))
    scratch = Scratch(spark)
    keys = distinct_keys(frame(spark, [history[5] ^ 1, history[5] ^ 6]), space)
    held, mine = touched(index, keys, 2, scratch)
    slots = {r["slot"] for r in index.blocked(keys).select("slot").distinct().collect()}
    assert len(slots) < 64
    plan = index.read(spark, [1], sorted(slots))._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1]
    assert "batch#" in filters and "slot#" in filters.split("PushedFilters")[0]
    blocks = {(r.choice, r.value) for r in mine.collect()}
    rows = held.collect()
    assert {(r.choice, r.value) for r in rows} <= blocks
    want = {h for h in history if any((choice, h & agree) in blocks for choice, agree in index.space._choices())}
    assert {r.hash for r in rows} == want and 0 < len(want) < len(history)


def test_a_failed_run_leaves_nothing_behind(spark, monkeypatch):
    from adgrove.operators import block_index

    rng = random.Random(3)
    path = Scratch(spark).folder
    index = create_index(spark, path, HashSpace(EPS, BITS), 100)
    first, second = hashes(rng, 15), hashes(rng, 15)
    assign_batch(index, frame(spark, first), "a")
    with monkeypatch.context() as m:
        m.setattr(block_index, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            assign_batch(index, frame(spark, [h ^ 5 for h in second]), "b")
    got = assign_batch(index, frame(spark, second), "b").points.orderBy("idx").collect()
    want, _, _ = seq.assign(first + second, [], seq.hash_distance, EPS)
    assert [r.cluster_id for r in got] == want[15:]


def test_odd_batches(spark):
    index = create_index(spark, Scratch(spark).folder, HashSpace(EPS, BITS), 100)
    with pytest.raises(ValueError, match="NULL"):
        assign_batch(index, spark.createDataFrame([(1, None)], "idx bigint, hash bigint"), "x")
    assert assign_batch(index, frame(spark, []), "empty").points.count() == 0
    extra = frame(spark, [5, 5, 5]).withColumns({"kid": F.lit("k"), "cluster_id": F.lit(8), "d": F.lit(0)})
    assert [r.cluster_id for r in assign_batch(index, extra, "clash").points.collect()] == [1, 1, 1]
    with pytest.raises(ValueError, match="not empty"):
        load_history(index, spark.createDataFrame([], "pos bigint, hash bigint, cluster_id int"))
