"""Distributed clustering against the sequential statement of the rules; many random cases share one job via ``part``."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import adgrove.operators.skew as skew
from adgrove.operators import spaces, vectors
import sequential as seq
from adgrove.operators.assign import assign_incremental
from adgrove.operators.components import connected_components, follow_pointers, stars
from adgrove.operators.dbscan import dbscan
from adgrove.operators.directed import lowest_reaching
from adgrove.operators.numbering import number_rows
from adgrove.operators.pairs import PairSearch, distinct_keys, prepare_pairs
from adgrove.operators.scratch import Scratch
from adgrove.operators.spaces import HashSpace, MixedSpace, VectorSpace

HASH = "part int, idx bigint, hash bigint"


def random_hashes(rng, n, bits):
    """Few templates with some flipped bits, some of them copied often."""
    base = [rng.getrandbits(bits) for _ in range(rng.randint(2, 6))]
    out = []
    for _ in range(n):
        h = rng.choice(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            h ^= 1 << rng.randrange(bits)
        out.append(h)
    return out


def check(spark, cases, space, dist, min_points, noise, columns, **options):
    rows, idx = [], 0
    offsets = []
    for part, items in enumerate(cases):
        offsets.append(idx)
        for item in items:
            rows.append((part, idx, *item))
            idx += 1
    df = spark.createDataFrame(rows, f"part int, idx bigint, {columns}").repartition(3)
    result = dbscan(df, space, min_points, noise, ["part"], **options)
    got = {r.idx: r.cluster_id for r in result.points.collect()}
    summary = {r.part: (r.next_id, r.noise_count) for r in result.summary.collect()}
    for part, items in enumerate(cases):
        want, next_id, met = seq.cluster(
            len(items), lambda i, j: dist(items[i], items[j]), space.eps, min_points, noise,
            options.get("start_id", 1), options.get("start_noise", 0),
        )
        assert [got[offsets[part] + i] for i in range(len(items))] == want, (part, items)
        assert summary[part] == (next_id, met)


@pytest.mark.parametrize("noise", ["singleton", "shared"])
@pytest.mark.parametrize("eps,min_points", [(0.2, 3), (0.35, 2), (0.12, 1), (0.3, 5)])
def test_hash_clusters(spark, noise, eps, min_points):
    rng = random.Random(f"{noise}{eps}")
    cases = [[(h,) for h in random_hashes(rng, rng.randint(1, 26), 12)] for _ in range(40)]
    check(spark, cases, HashSpace(eps, 12), lambda a, b: seq.hash_distance(a[0], b[0]), min_points, noise, "hash bigint",
          start_id=5, start_noise=2)


def test_hot_buckets_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 10)
    rng = random.Random(9)
    cases = [[(h,) for h in random_hashes(rng, 60, 14)] for _ in range(6)]
    for blocks in (None, 5, 7):
        check(spark, cases, HashSpace(0.22, 14, blocks=blocks), lambda a, b: seq.hash_distance(a[0], b[0]), 3, "singleton",
              "hash bigint", bucket_limit=3)


@pytest.mark.parametrize("dim,cell,block", [(2, 1024, 2048), (3, 4, 2048), (5, 3, 2)])
def test_vector_clusters(spark, monkeypatch, dim, cell, block):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = random.Random(dim)
    cases = [
        [([rng.choice([0, 6, 12, 40]) + rng.randint(0, 4) for _ in range(dim)],) for _ in range(rng.randint(1, 24))]
        for _ in range(30)
    ]
    dist = lambda a, b: math.sqrt(sum((x - y) ** 2 for x, y in zip(a[0], b[0])))
    check(spark, cases, VectorSpace(5.0, dim), dist, 3, "singleton", "vector array<bigint>", bucket_limit=4)


def test_cells_lose_no_pair_and_prune_structured_data():
    import numpy as np

    rng = np.random.default_rng(2)
    centres = rng.normal(0, 50, (20, 64))
    v = np.concatenate([c + rng.normal(0, 0.3, (40, 64)) for c in centres])
    pivots = v[rng.choice(len(v), 25, replace=False)]
    cell, visits = vectors.visited(v, pivots, 5.0)
    i, j, d = vectors.close(v, v, 5.0, 1.0)
    exact = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    assert {(a, b) for a, b in zip(i, j)} == {(a, b) for a, b in zip(*np.nonzero(exact < 5.0))}
    for a, b in zip(i, j):
        assert visits[b, cell[a]] and visits[a, cell[b]]
    visits &= np.arange(len(pivots)) <= cell[:, None]  # one of the two cells is enough
    sizes = np.bincount(cell, minlength=len(pivots))
    candidates = int((visits * sizes).sum())
    print("candidates for each close pair:", candidates / len(i))
    assert candidates < 3 * len(i) < len(v) ** 2 / 4


def clustered(n, groups, dim, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = rng.integers(-4000, 4000, (groups, dim))
    v = np.unique(centres[rng.integers(0, groups, n)] + rng.integers(-30, 31, (n, dim)), axis=0)
    return v[rng.permutation(len(v))]


def search(spark, v, space, part=None):
    rows = [(i, x.tolist(), part[i] if part is not None else 0) for i, x in enumerate(v)]
    keys, scratch = spark.createDataFrame(rows, "kid bigint, vector array<bigint>, g int"), Scratch(spark)
    found = vectors.prepare_vectors(keys, len(v), space, scratch, () if part is None else ["g"])
    return keys, found


def test_tree_of_cells_finds_every_pair_once(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(vectors, "CELL", 8)
    monkeypatch.setattr(vectors, "MOST_PIVOTS", 4)
    monkeypatch.setattr(vectors, "SHARE", 64)
    v = clustered(900, 40, 5, 1)
    part = np.random.default_rng(5).integers(0, 2, len(v)).tolist()
    exact = np.sqrt(((v[:, None] - v[None]).astype(float) ** 2).sum(-1))
    for own in (None, part):
        keys, found = search(spark, v, VectorSpace(25.0, 5), own)
        got = [(p.a, p.b) for p in found.close_pairs(keys, ["g"]).collect()]
        want = {(a, b) for a, b in zip(*np.nonzero(exact < 25.0)) if a < b and (own is None or own[a] == own[b])}
        assert len(got) == len(want) and set(got) == want
        assert found.cells.selectExpr("max(length(node))").first()[0] > 6  # several levels


def test_work_in_cells_follows_the_rows(spark, monkeypatch):
    """Groups of bounded size: twice the vectors, twice the compared pairs; an eps beyond all distances splits nothing."""
    monkeypatch.setattr(vectors, "CELL", 32)
    monkeypatch.setattr(vectors, "MOST_PIVOTS", 8)
    work = {}
    for n in (1500, 6000):
        v = clustered(n, n // 25, 6, n)
        _, found = search(spark, v, VectorSpace(40.0, 6))
        work[n] = found.compared() / len(v)
        own = found.cells.where("not guest").groupBy("node").count()
        assert own.selectExpr("percentile(count, 0.99)").first()[0] <= 4 * 32
        assert found.cells.where("not guest").count() == len(v)
    assert work[6000] < 2 * work[1500] and work[6000] < 6000 / 20
    _, whole = search(spark, v, VectorSpace(1e6, 6))
    assert whole.cells.select("node").distinct().count() == 1 and whole.compared() == len(v) ** 2


def test_null_keys_are_refused(spark):
    points = spark.createDataFrame([(1, 5), (2, None)], "idx bigint, hash bigint")
    with pytest.raises(ValueError):
        dbscan(points, HashSpace(0.2, 12), 2)
    known = spark.createDataFrame([(0, 5, 1)], "pos bigint, hash bigint, cluster_id int")
    with pytest.raises(ValueError):
        assign_incremental(points, known, HashSpace(0.2, 12))


def test_slack_is_exact():
    for bits, eps in ((60, 0.1), (60, 0.15), (62, 0.1), (12, 0.25), (10, 0.3)):
        assert HashSpace(eps, bits).slack == max(k for k in range(bits + 1) if k / bits < eps)


def test_numbers_of_null_groups_start_at_zero(spark):
    rows = spark.createDataFrame([(None, 5), ("a", 1), (None, 3), ("a", 9), (None, 4)], "g string, k int")
    got = number_rows(rows, ["k"], "n", Scratch(spark), ["g"]).select("g", "k", "n").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 3, 0), (None, 4, 1), (None, 5, 2), ("a", 1, 0), ("a", 9, 1)], key=str)


def test_mixed_clusters_block_on_parts_that_must_agree(spark):
    rng = random.Random(3)
    cases = [
        [(h, rng.choice("ab"), rng.choice("xyz")) for h in random_hashes(rng, rng.randint(4, 24), 12)] for _ in range(30)
    ]
    dist = lambda a, b: seq.hash_distance(a[0], b[0]) + (a[1] != b[1])
    space = MixedSpace(0.3, user_weight=1, use_hash=True, known_users=True, bits=12)
    check(spark, cases, space, dist, 2, "singleton", "hash bigint, uname string, coname string")


def test_mixed_clusters_with_bonus_for_equal_names(spark):
    """near = -1 subtracts for equal names, so the hash may be farther apart; the clamp makes distinct keys tie at 0."""
    rng = random.Random(4)
    cases = [[(h, rng.choice("ab")) for h in random_hashes(rng, rng.randint(4, 20), 12)] for _ in range(30)]
    dist = lambda a, b: max(seq.hash_distance(a[0], b[0]) + 0.2 * (-1 if a[1] == b[1] else 1), 0)
    space = MixedSpace(0.15, company_weight=0.2, near=-1, clamp=True, bits=12)
    check(spark, cases, space, dist, 3, "singleton", "hash bigint, coname string")


@pytest.mark.parametrize("limit,which", [(4096, 0), (1, 1)])
def test_mixes_with_hashes_make_no_pair_rows(spark, limit, which, monkeypatch):
    """Tasks add up weights and links themselves, also in buckets that are cut and for texts without a table of distances."""
    from adgrove.operators import block_folds

    def pairs(*_, **__):
        raise AssertionError("pairs are rows")

    monkeypatch.setattr(PairSearch, "meet", pairs)
    monkeypatch.setattr(PairSearch, "hints", pairs)
    monkeypatch.setattr(block_folds, "TABLE", (1 << 22, 0)[which])
    rng = random.Random(21 + which)
    space = MixedSpace(0.31, url_weight=0.0613, user_weight=0.0471, company_weight=0.0371, city_weight=0.1137, near=-1, clamp=not which,
                       use_hash=True, bits=12)
    parts = mix(space)

    def dist(a, b):
        d = seq.hash_distance(a[0], b[0]) + parts(a[1:], b[1:])
        return d if which else max(d, 0.0)

    urls = ["http://a.com/x/y", "http://a.com/x/z", "http://a.com/u/v", "http://b.com/x", "http://mp.weixin.qq.com/x/y", "none", ""]
    cases = [
        [(h, rng.choice(urls), rng.choice("0ab"), rng.choice("xy"), rng.choice(["", "c1", "c1,c2", "c2,c3,c1", "c4,"]))
         for h in random_hashes(rng, rng.randint(4, 40), 12)] for _ in range(25)
    ]
    check(spark, cases, space, dist, 3, "singleton", "hash bigint, url string, uname string, coname string, city string", bucket_limit=limit)


def test_weights_without_exact_blocking_are_refused(spark):
    df = spark.createDataFrame([(0, "http://a/b")], "idx bigint, url string")
    for space in (MixedSpace(1.5, url_weight=1), MixedSpace(3, url_weight=1, user_weight=1), MixedSpace(0.5, url_weight=-1)):
        with pytest.raises(ValueError, match="share"):
            dbscan(df.withColumn("uname", F.lit("u")), space, 2)


URLS = ["http://a.com", "http://a.com/x", "http://a.com/x/y", "http://a.com/x/z", "http://a.com/x/z/w", "http://a.com/q/z/w", "no url",
        "http://b.com/x/y", "http://b.com", "", "http://mp.weixin.qq.com/s/1", "http://mp.weixin.qq.com/t/2", "http://b.com/x/y/1/2",
        "http://b.com/u/y/1/3", "http://b.com/u/v/1/3"]
CITIES = ["", "c1", "c1,c2", "c2,c1", "c1,c2,c3", "c4,c5", "c4,c5,c6,c7", "c1,c2,c3,c4,c5", "c9", "c2,c2,c9", "c5"]


def url_sim(a, b, near, far, threshold):
    if a == b:
        return near
    x, y = a.split("/")[2:], b.split("/")[2:]
    k = min(len(x), len(y))
    if not k:
        return 0
    if x[0] != y[0]:
        return far
    if x[0] == "mp.weixin.qq.com":
        return 0
    differing = sum(p != q for p, q in zip(x, y))
    return far if differing >= threshold and differing > 0 else near


def jaccard(a, b):
    x, y = set(a.split(",")), set(b.split(","))
    return 0 if not a or not b else 1 - len(x & y) / len(x | y)


def mix(space):
    def dist(a, b):
        d = space.url_weight * url_sim(a[0], b[0], space.near, space.far, space.url_threshold) if space.url_weight else 0
        if space.user_weight:
            d += space.user_weight * (0 if "0" in (a[1], b[1]) else space.near if a[1] == b[1] else space.far)
        if space.company_weight:
            d += space.company_weight * (space.near if a[2] == b[2] else space.far)
        return d + (space.city_weight * jaccard(a[3], b[3]) if space.city_weight else 0)

    return dist


LED = [
    MixedSpace(0.5, url_weight=1), MixedSpace(0.4, city_weight=1), MixedSpace(1.0, city_weight=1), MixedSpace(0.7, city_weight=1),
    MixedSpace(1.5, url_weight=1, user_weight=1, company_weight=1), MixedSpace(1.2, url_weight=1, city_weight=1),
    MixedSpace(0.9, url_weight=1, city_weight=1, url_threshold=1), MixedSpace(0.6, url_weight=1, user_weight=0.5, url_threshold=3),
    MixedSpace(1.4, url_weight=1, user_weight=1, company_weight=1, city_weight=0.5, known_users=True),
    MixedSpace(0.3, url_weight=0.5, company_weight=0.2, near=-0.5),
]


@pytest.mark.parametrize("which", range(len(LED)))
def test_mixes_led_by_url_or_city(spark, which, monkeypatch):
    monkeypatch.setattr(spaces, "WILD", 3)
    monkeypatch.setattr(spaces, "FREQUENT", 2)
    rng, space = random.Random(which), LED[which]
    cases = [
        [(rng.choice(URLS), rng.choice("ab" if space.known_users else "0ab"), rng.choice("xyz"), rng.choice(CITIES)) for _ in range(rng.randint(2, 22))]
        for _ in range(16)
    ]
    columns = "url string, uname string, coname string, city string"
    check(spark, cases, space, mix(space), 3, "singleton", columns, bucket_limit=4 if which % 2 else 4096)


def one_sided(space):
    """Only an unknown user on the left is near everybody."""
    def dist(a, b):
        d = seq.hash_distance(a[0], b[0]) if space.clamp or space.use_hash else 0
        d += space.user_weight * (0 if a[1] == "0" else space.near if a[1] == b[1] else space.far)
        if space.company_weight:
            d += space.company_weight * (space.near if a[2] == b[2] else space.far)
        if space.city_weight:
            d += space.city_weight * jaccard(a[3], b[3])
        return max(d, 0) if space.clamp else d

    return dist


ONE_SIDED = [
    MixedSpace(0.3, user_weight=1, use_hash=True, one_sided=True, bits=12),
    MixedSpace(0.35, user_weight=0.2, use_hash=True, one_sided=True, bits=12),
    MixedSpace(0.25, user_weight=0.15, company_weight=0.1, near=-1, clamp=True, one_sided=True, bits=12),
    MixedSpace(0.3, user_weight=-0.1, use_hash=True, one_sided=True, bits=12),
    MixedSpace(1.2, user_weight=1, company_weight=1, city_weight=0.5, one_sided=True),
    MixedSpace(0.5, city_weight=1, user_weight=-0.2, one_sided=True),
]


@pytest.mark.parametrize("noise", ["singleton", "shared"])
@pytest.mark.parametrize("which", range(len(ONE_SIDED)))
def test_one_sided_clusters(spark, which, noise, monkeypatch):
    monkeypatch.setattr(spaces, "WILD", 3)
    rng, space = random.Random(which), ONE_SIDED[which]
    cases = [
        [(h, rng.choice("00abc"), rng.choice("xy"), rng.choice(CITIES)) for h in random_hashes(rng, rng.randint(2, 24), 12)]
        for _ in range(60)
    ]
    columns = "hash bigint, uname string, coname string, city string"
    check(spark, cases, space, one_sided(space), rng.choice([2, 3, 4]), noise, columns, start_id=5, start_noise=2)


def test_one_sided_clusters_need_no_pass_over_all_pairs(spark, monkeypatch):
    def all_pairs(*_, **__):
        raise AssertionError("all close pairs are looked at")

    monkeypatch.setattr(PairSearch, "close_pairs", all_pairs)
    rng, space = random.Random(11), ONE_SIDED[0]
    cases = [
        [(h, rng.choice("00ab"), "x", "") for h in random_hashes(rng, rng.randint(20, 60), 12)] for _ in range(12)
    ]
    columns = "hash bigint, uname string, coname string, city string"
    check(spark, cases, space, one_sided(space), 3, "singleton", columns, bucket_limit=4)


@pytest.mark.parametrize("which", [0, 3])
def test_one_sided_clusters_make_no_pair_rows(spark, which, monkeypatch):
    def pairs(*_, **__):
        raise AssertionError("pairs are rows")

    monkeypatch.setattr(PairSearch, "meet", pairs)
    monkeypatch.setattr(PairSearch, "hints", pairs)
    rng, space = random.Random(31), ONE_SIDED[which]
    cases = [[(h, rng.choice("00ab"), "x", "") for h in random_hashes(rng, rng.randint(20, 60), 12)] for _ in range(12)]
    columns = "hash bigint, uname string, coname string, city string"
    check(spark, cases, space, one_sided(space), 3, "shared", columns, bucket_limit=1)


def test_lowest_label_follows_directed_links(spark):
    arcs = [(9, 4), (4, 7), (7, 8), (8, 4), (2, 8), (5, 2), (3, 1), (11, 12), (12, 13), (13, 14), (14, 10)]
    got = lowest_reaching(spark.createDataFrame(arcs, "src long, dst long"), Scratch(spark))
    reach = {n: n for arc in arcs for n in arc}
    for _ in arcs:
        for a, b in arcs:
            reach[b] = min(reach[b], reach[a])
    assert {r.node: r.label for r in got.collect()} == reach
    assert lowest_reaching(spark.createDataFrame([], "src long, dst long"), Scratch(spark)).collect() == []


def test_pairs_of_agreeing_parts_are_found_once_and_few_meet(spark):
    rng = random.Random(8)
    rows = sorted({(f"http://h{rng.randrange(60)}.com/{rng.randrange(9)}/{rng.randrange(9)}/{rng.randrange(3)}",
                    ",".join(sorted({f"c{rng.randrange(90)}" for _ in range(4)}))) for _ in range(700)})
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "idx bigint, url string, city string")
    for space in (MixedSpace(0.5, url_weight=1), MixedSpace(0.5, city_weight=1), MixedSpace(1.2, url_weight=1, city_weight=1)):
        dist, scratch = mix(space), Scratch(spark)
        keys, seen = scratch.cut(distinct_keys(df, space), rows=F.count(F.lit(1)))
        values = [(r.kid, (r.url if "url" in space.key_columns else "", "", "", r.city if "city" in space.key_columns else ""))
                  for r in keys.selectExpr("kid", *[c if c in space.key_columns else f"'' as {c}" for c in ("url", "city")]).collect()]
        want = {(min(i, j), max(i, j)) for n, (i, x) in enumerate(values) for j, y in values[:n] if dist(x, y) < space.eps}
        search = prepare_pairs(keys, seen["rows"], space, scratch)
        pairs = search.close_pairs(keys).collect()
        assert len(pairs) == len(want) and {(p.a, p.b) for p in pairs} == want
        left, right = search.space.left(keys), search.space.right(keys)
        met = left.join(right.select("rule", "value", F.col("kid").alias("other")), ["rule", "value"]).where("kid < other").count()
        assert met < len(values) ** 2 / 8


def test_every_pair_is_found_once(spark):
    rng = random.Random(1)
    hashes = sorted(set(rng.getrandbits(16) for _ in range(150)))
    df = spark.createDataFrame(list(enumerate(hashes)), "idx bigint, hash bigint")
    want = {(i, j) for i in range(len(hashes)) for j in range(i) if seq.hash_distance(hashes[i], hashes[j]) < 0.2}
    for blocks in (None, 4, 6, 8):
        space, scratch = HashSpace(0.2, 16, blocks=blocks), Scratch(spark)
        keys, seen = scratch.cut(distinct_keys(df, space), rows=F.count(F.lit(1)))
        for limit in (10_000, 5):
            pairs = prepare_pairs(keys, seen["rows"], space, scratch, (), limit).close_pairs(keys).collect()
            assert len(pairs) == len(want)
            assert {(max(p.a, p.b), min(p.a, p.b)) for p in pairs} == want


@pytest.mark.parametrize("seed", range(3))
def test_assignment(spark, seed):
    rng = random.Random(seed)
    pool = random_hashes(rng, 70, 12)
    known = [(h, rng.randint(1, 9)) for h in pool[: 30 if seed else 0]]
    batch = pool[30:]
    history = spark.createDataFrame([(i, h, c) for i, (h, c) in enumerate(known)], "pos bigint, hash bigint, cluster_id int")
    df = spark.createDataFrame(list(enumerate(batch)), "idx bigint, hash bigint")
    result = assign_incremental(df, history, HashSpace(0.2, 12), bucket_limit=6)
    want, start, next_id = seq.assign(batch, known, seq.hash_distance, 0.2)
    assert [r.cluster_id for r in result.points.orderBy("idx").collect()] == want
    assert tuple(result.bounds.first()) == (start, next_id)


def test_assignment_makes_no_pair_rows(spark, monkeypatch):
    from adgrove.operators import block_index

    def pairs(*_, **__):
        raise AssertionError("pairs are rows")

    monkeypatch.setattr(PairSearch, "meet", pairs)
    rng = random.Random(9)
    pool = random_hashes(rng, 90, 12)
    known, batch, space = [(h, rng.randint(1, 9)) for h in pool[:40]], pool[40:], HashSpace(0.3, 12)
    history = spark.createDataFrame([(i, h, c) for i, (h, c) in enumerate(known)], "pos bigint, hash bigint, cluster_id int")
    df = spark.createDataFrame(list(enumerate(batch)), "idx bigint, hash bigint")
    want, _, _ = seq.assign(batch, known, seq.hash_distance, 0.3)
    assert [r.cluster_id for r in assign_incremental(df, history, space, bucket_limit=1).points.orderBy("idx").collect()] == want
    index = block_index.create_index(spark, Scratch(spark).folder, space, 60, slots=4)
    block_index.load_history(index, history)
    assert [r.cluster_id for r in block_index.assign_batch(index, df, "one", 1).points.orderBy("idx").collect()] == want


def test_components_of_long_and_hub_graphs(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 4000)]
    random.Random(0).shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(df, Scratch(spark)).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + k: 1000 for k in range(200)}, 5000: 4000, 4000: 4000}


def test_stars_keep_connectivity():
    import numpy as np

    child, root = stars(np.array([9, 4, 7, 2]), np.array([4, 7, 2, 8]))
    assert dict(zip(child.tolist(), root.tolist())) == {4: 2, 7: 2, 8: 2, 9: 2}


def test_pointer_chains(spark):
    df = spark.createDataFrame([(i, max(i - 1, 0)) for i in range(50)] + [(99, 77)], "node bigint, target bigint")
    got = {r.node: r.target for r in follow_pointers(df, Scratch(spark)).collect()}
    assert got == {**{i: 0 for i in range(50)}, 99: 77}


def test_numbering_is_dense_within_groups(spark):
    rows = [(g, i * 7 % 101) for g in "aab" for i in range(40)]
    df = spark.createDataFrame([(g, k, i) for i, (g, k) in enumerate(rows)], "g string, k int, i int")
    got = number_rows(df, ["k", "i"], "n", Scratch(spark), ["g"]).orderBy("g", "n").collect()
    for g, size in (("a", 80), ("b", 40)):
        mine = [r for r in got if r.g == g]
        assert [r.n for r in mine] == list(range(size))
        assert [(r.k, r.i) for r in mine] == sorted((r.k, r.i) for r in mine)


def test_dense_clusters_are_not_searched_again(spark):
    from adgrove.operators.dbscan import outside_largest

    rng = random.Random(4)
    centre, lone = rng.getrandbits(60), [rng.getrandbits(60) for _ in range(40)]
    ball = list({centre ^ (1 << rng.randrange(30, 60)) ^ (1 << rng.randrange(30, 60)) for _ in range(300)} - {centre})
    df = spark.createDataFrame(list(enumerate(ball + lone)), "idx bigint, hash bigint")
    scratch, space = Scratch(spark), HashSpace(0.1, 60)
    keys, seen = scratch.cut(distinct_keys(df, space), rows=F.count(F.lit(1)))
    search = prepare_pairs(keys, seen["rows"], space, scratch)
    close = {(p.a, p.b) for p in search.neighbours(keys, [], "true").collect()}
    assert {(p.a, p.b) for p in search.hints(keys).collect()} <= close
    proven = {p.a for p in search.hints(keys).collect()}
    assert len(proven) > 0.8 * len(ball)
    label = F.when(F.col("kid") < len(ball), F.lit(0)).cast("long")
    rows = search.space.left(keys.withColumns({"label": label, "size": F.lit(len(ball)).cast("long")}))
    left = outside_largest(search, rows)
    assert left.where("label = 0").isEmpty() and left.select("kid").distinct().count() == len(lone)


def test_near_copies_are_assigned_in_the_first_round(spark):
    from adgrove.operators.assign import first_rounds

    rng = random.Random(5)
    base = rng.getrandbits(60)
    items = [base ^ (1 << k) for k in range(40, 60)] + [rng.getrandbits(60) for _ in range(5)]
    keys = spark.createDataFrame([(i, h, int(i > 0)) for i, h in enumerate(items)], "kid bigint, hash bigint, late int")
    rows = {r.kid: r for r in first_rounds(keys, len(items), HashSpace(0.12, 60), Scratch(spark)).collect()}
    assert {k for k in rows if rows[k].open} == set(range(20, 25))
    for k in range(1, 20):
        want = min((seq.hash_distance(items[k], items[j]), j) for j in range(k))
        assert (rows[k].best.d, rows[k].best.other) == want


def test_large_cells_copy_a_vector_a_bounded_number_of_times(spark, monkeypatch):
    from adgrove.operators import vectors

    monkeypatch.setattr(vectors, "BLOCK", 8)
    rng = random.Random(5)
    rows = [(i, [rng.randint(-3, 3) for _ in range(4)]) for i in range(400)]
    keys = spark.createDataFrame(rows, "kid bigint, vector array<bigint>").repartition(3)
    space = VectorSpace(2.5, 4)
    search = vectors.prepare_vectors(keys, len(rows), space, Scratch(spark))
    cut = search.cuts.first()
    assert cut["cut_left"] == cut["cut_right"] == vectors.MOST_CHUNKS
    limit = (space.eps * space.scale) ** 2
    want = {(i, j) for i, v in rows for j, w in rows if i < j and sum((x - y) ** 2 for x, y in zip(v, w)) < limit}
    got = [(r.a, r.b) for r in search.close_pairs(keys).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


@pytest.mark.parametrize("limit", [1, 4096])
def test_hash_blocks_give_each_wanted_pair_once(spark, limit, monkeypatch):
    """Looking keys meet all others, ranked ones those of higher ranks, also in buckets that are cut and in small steps."""
    from adgrove.operators import hash_blocks

    monkeypatch.setattr(hash_blocks, "MATRIX", 8)
    rng, bits = random.Random(31), 40
    centres = [rng.getrandbits(bits) for _ in range(3)]
    hashes = {c ^ (1 << rng.randrange(bits)) ^ (1 << rng.randrange(bits)) for c in centres for _ in range(25)} | {rng.getrandbits(bits) for _ in range(9)}
    items = [(p, h, rng.random() < 0.4, rng.choice((0, 0, 1, 2, 3))) for p in "xy" for h in sorted(hashes)]
    # The same hash in another part is no neighbour.
    keys = spark.createDataFrame([(k, *i) for k, i in enumerate(items)], "kid bigint, p string, hash bigint, looks boolean, rank int")
    space = HashSpace(0.1, bits)
    search = hash_blocks.prepare_blocks(keys, len(items), space, Scratch(spark), ["p"], limit)
    assert (search.hot is not None) == (limit == 1)
    close = {
        (a, b): seq.hash_distance(x[1], y[1]) for a, x in enumerate(items) for b, y in enumerate(items)
        if a != b and x[0] == y[0] and seq.hash_distance(x[1], y[1]) < 0.1
    }
    got = search.neighbours(keys, ["rank", "looks"], "looks").collect()
    assert len(got) == len({(p.a, p.b) for p in got})
    assert {(p.a, p.b): p.d for p in got} == {k: d for k, d in close.items() if items[k[0]][2]}
    assert all((p.rank_a, p.looks_b) == (items[p.a][3], items[p.b][2]) for p in got)
    out = [(p.a, p.b) for p in search.outward(keys, [], "rank").collect()]
    assert sorted(out) == sorted((a, b) for a, b in close if items[a][3] == 0 or items[a][3] < items[b][3])


def test_hash_blocks_hold_no_candidate_rows(spark):
    """Keys that agree in a bucket and are far apart leave no row behind the bucket rows, of which a key has few."""
    from adgrove.operators.hash_blocks import bit_lengths, candidates, prepare_blocks

    n = 3000
    keys = spark.createDataFrame([(k, (k * 2654435761) % (1 << 30)) for k in range(n)], "kid bigint, hash bigint")
    search = prepare_blocks(keys, n, HashSpace(0.1, 60), Scratch(spark))
    pairs = search.neighbours(keys, [], "true")
    assert "Join" not in pairs._jdf.queryExecution().sparkPlan().toString()
    assert search.space.left(keys).count() <= 21 * n
    values = np.array([0, 1, 2, 3, (1 << 53) - 1, 1 << 53, (1 << 60) - 1, 1 << 60], np.int64)
    assert bit_lengths(values).tolist() == [int(v).bit_length() for v in values]
    left, right = np.arange(40), np.arange(90)
    low, high = np.where(left < 20, 0, left), np.where(left % 2, 90, 50)
    got = [(int(x), int(y)) for xs, ys in candidates(left, right, low, high, 2) for x, y in zip(xs, ys)]
    assert sorted(got) == [(x, y) for x in range(40) for y in range(low[x], high[x]) if (x ^ y).bit_count() <= 2]
