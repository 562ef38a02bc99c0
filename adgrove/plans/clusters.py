"""Clustering jobs: cluster ads, refine clusters, cluster embeddings, explain and profile distances."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adgrove.functions import distance as dist
from adgrove.operators.dbscan import Clustering, dbscan
from adgrove.operators.numbering import number_rows
from adgrove.operators.scratch import Scratch
from adgrove.operators.selection import select_ranks, smallest
from adgrove.operators.skew import join_spread
from adgrove.operators.spaces import A, B, MixedSpace, Space, VectorSpace
from adgrove.sources.schemas import CLUSTER_COLUMNS

MIN_REFINED = 4
REFINE_COLUMNS = {"hash": "simhash_emb", "url": "url", "user": "uid", "company": "uname", "city": "city"}


def of_industry(ads: DataFrame, industry: str, level: int) -> DataFrame:
    """Ads whose industry at ``level`` (0-based) is ``industry``; ``"all"`` keeps every ad."""
    return ads if industry == "all" else ads.where(F.get("industry_type", F.lit(level)) == industry)


def cluster_rows(ads: DataFrame, clustering: Clustering) -> DataFrame:
    """Cluster-file rows (with ``idx``) for clustered ads; fields of the retired algorithm stay "0"."""
    zero = F.lit("0")
    hashes = F.col("hash").cast("string") if "hash" in ads.columns else F.lit("null")
    words = F.concat_ws(",", "wordlist") if dict(ads.dtypes).get("wordlist", "").startswith("array") else F.coalesce("wordlist", F.lit("?"))
    text = {n: F.coalesce(n, F.lit("null")) if n in ads.columns else F.lit("null") for n in ("aid", "uid", "uname", "url", "city")}
    columns = {
        **text, "rho": zero, "delta": zero, "neighbor": zero, "wordlist": words, "simhash_emb": hashes,
        "cluster_id": F.col("cluster_id").cast("string"),
    }
    joined = ads.join(clustering.points.select("idx", "cluster_id"), "idx")
    return joined.select("idx", *[columns[n].alias(n) for n in CLUSTER_COLUMNS])


def cluster_ads(
    ads: DataFrame, space: Space, min_points: float = 3, industry: str = "all", level: int = 3,
    start_id: int = 1, start_noise: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Clusters the ads of an industry; returns cluster-file rows and the summary (next id, noise count).

    ``start_id`` and ``start_noise`` let runs over several industries continue each other's numbers.
    """
    chosen = of_industry(ads, industry, level)
    clustering = dbscan(chosen, space, min_points, "singleton", (), start_id, start_noise)
    return cluster_rows(chosen, clustering), clustering.summary


def cluster_industries(
    ads: DataFrame, space: Space, industries: Sequence[str], min_points: float = 3, level: int = 3,
    start_id: int = 1, start_noise: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Clusters the ads of each listed industry on their own in one job, with ids and noise counts that run on.

    Returns cluster-file rows and a summary (industry, next_id, noise_count) in which each industry starts where the one
    before it in the list ended, as if they had been clustered one after the other. An industry without ads takes no id.
    ``industries`` is a bounded list of distinct names; ``idx`` is unique over all of them.
    """
    spark = ads.sparkSession
    if len(set(industries)) < len(industries):
        raise ValueError("an industry is listed twice")
    listed = spark.createDataFrame([(n, k) for k, n in enumerate(industries)], "industry string, industry_at int")
    named = ads.withColumn("industry", F.get("industry_type", F.lit(level))).join(F.broadcast(listed), "industry")
    clustering = dbscan(named, space, min_points, "singleton", ["industry_at"])
    found, _ = Scratch(spark).cut(clustering.summary)
    # One row an industry.
    upto = Window.orderBy("industry_at").rowsBetween(Window.unboundedPreceding, 0)
    used = F.coalesce(F.col("next_id") - 1, F.lit(0))
    runs = listed.join(found, "industry_at", "left").select(
        "industry", "industry_at", (F.sum(used).over(upto) + start_id).cast("bigint").alias("next_id"),
        (F.sum(F.coalesce("noise_count", F.lit(0))).over(upto) + start_noise).cast("bigint").alias("noise_count"),
        (F.sum(used).over(upto) - used + start_id - 1).cast("bigint").alias("shift"),
    )
    points = clustering.points.join(F.broadcast(runs.select("industry_at", "shift")), "industry_at").select(
        "idx", (F.col("cluster_id") + F.col("shift")).alias("cluster_id")
    )
    return cluster_rows(named, replace(clustering, points=points)), runs.select("industry", "next_id", "noise_count")


def refine_clusters(
    rows: DataFrame, space: MixedSpace, min_points: float, start_id: int = 1, start_noise: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Re-clusters every cluster of a cluster file on its own; ids become ``old_new``.

    Clusters of fewer than four members are skipped and not written. Each cluster numbers from ``start_id``.
    All clusters are refined in one job, keyed by cluster id. The mix compares users by ``uid`` and companies
    by ``uname``, as the file's job does.
    """
    scratch = Scratch(rows.sparkSession)
    sizes, seen = scratch.cut(rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("weight")), rows=F.sum("weight"))
    big = sizes.where(F.col("weight") >= MIN_REFINED)
    kept, _ = scratch.cut(join_spread(rows, big, ["cluster_id"], "weight", max(1, seen["rows"] or 0)))
    space = replace(space, columns=REFINE_COLUMNS)
    points = kept.withColumn("simhash_emb", F.col("simhash_emb").cast("long")) if space.use_hash else kept
    clustering = dbscan(
        points.withColumnRenamed("cluster_id", "old_id"), space, min_points, "singleton", ["old_id"], start_id, start_noise
    )
    new = clustering.points.select("idx", F.col("cluster_id").cast("string").alias("new_id"))
    refined = kept.join(new, "idx").withColumn("cluster_id", F.concat_ws("_", "cluster_id", "new_id"))
    return refined.select("idx", *CLUSTER_COLUMNS), clustering.summary.withColumnRenamed("old_id", "cluster_id")


def refine_by_name(rows: DataFrame) -> DataFrame:
    """Appends to every cluster id the number of its user name, from 1 in order of first appearance in the file."""
    scratch = Scratch(rows.sparkSession)
    names, seen = scratch.cut(
        rows.groupBy("uname").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("weight")), rows=F.sum("weight")
    )
    numbers = number_rows(names, ["first"], "n", scratch).select("uname", "weight", (F.col("n") + 1).alias("n"))
    joined = join_spread(rows, numbers, ["uname"], "weight", max(1, seen["rows"] or 0))
    joined = joined.withColumn("cluster_id", F.concat_ws("_", "cluster_id", F.col("n").cast("string")))
    return joined.select("idx", *CLUSTER_COLUMNS)


def cluster_embeddings(vectors: DataFrame, space: VectorSpace, min_points: float = 3) -> tuple[DataFrame, DataFrame]:
    """Clusters (idx, aid, url, vector) rows; returns aid, url, cluster_id rows and the summary."""
    clustering = dbscan(vectors, space, min_points, "singleton")
    rows = vectors.join(clustering.points, "idx").select("idx", "aid", "url", "cluster_id")
    return rows, clustering.summary


def explain_pairs(ads: DataFrame, pairs: DataFrame, near: float = -1, far: float = 1, url_threshold: int = 2) -> DataFrame:
    """Every component distance of given ad pairs (left_id, right_id): two equi-joins, linear in the pairs."""
    fields = ("hash", "url", "uname", "coname", "city")
    sides = [
        ads.select(F.col("aid").alias(key), *[F.col(f).alias(p + f) for f in fields])
        for key, p in (("left_id", A), ("right_id", B))
    ]
    both = pairs.join(sides[0], "left_id").join(sides[1], "right_id")

    def sides_of(name: str) -> tuple[Column, Column]:
        return F.col(A + name), F.col(B + name)

    return both.select(
        "left_id", "right_id",
        dist.hash_distance(*sides_of("hash")).alias("hash_distance"),
        dist.url_similarity(*sides_of("url"), near, far, url_threshold).alias("url"),
        dist.url_prefix_distance(*sides_of("url")).alias("url_prefix"),
        dist.user_distance(*sides_of("uname"), near, far).alias("uname"),
        dist.company_distance(*sides_of("coname"), near, far).alias("coname"),
        dist.city_distance(*sides_of("city")).alias("city"),
    )


def vector_distances(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every vector distance of given pairs (left_id, right_id) of (idx, vector) rows."""
    left = vectors.select(F.col("idx").alias("left_id"), F.col("vector").alias("x"))
    right = vectors.select(F.col("idx").alias("right_id"), F.col("vector").alias("y"))
    x, y = F.col("x"), F.col("y")
    kinds = {
        "l1_twelfth": dist.l1_twelfth, "l1_mean": dist.l1_mean, "l2": dist.l2, "l2_scaled": dist.l2_scaled,
        "l2_mean_square": dist.l2_mean_square, "l2_relative": dist.l2_relative, "cosine": dist.cosine_distance,
        "sign_agreement": dist.sign_agreement,
    }
    both = pairs.join(left, "left_id").join(right, "right_id")
    return both.select("left_id", "right_id", *[f(x, y).alias(n) for n, f in kinds.items()])


def _probe_distances(points: DataFrame, space: Space, positions: Sequence[int], scratch: Scratch, carry: Sequence[str]) -> DataFrame:
    """Distance of every point to each probe position. Probes are a handful of rows, joined by position."""
    numbered, _ = scratch.cut(number_rows(points.select("idx", *carry, *space.key_columns), ["idx"], "position", scratch))
    probes = numbered.where(F.col("position").isin(*positions)).select(
        F.col("position").alias("probe"), *[F.col(c).alias(A + c) for c in (*carry, *space.key_columns)]
    )
    spread = numbered.withColumn("probe", F.explode(F.array(*[F.lit(p).cast("long") for p in positions])))
    renamed = spread.select("probe", "position", *[F.col(c).alias(B + c) for c in (*carry, *space.key_columns)])
    # As many probe rows as there are positions: a bound the caller states.
    return renamed.join(F.broadcast(probes), "probe").withColumn("d", space.distance())


def distance_profile(points: DataFrame, space: Space, label: str = "url") -> DataFrame:
    """Distances from five probes (first, quarter, half, last quarter, last) to all points, summarised per probe.

    head: every fifth of the 50 smallest; quantiles at 0, n/4, n/2, -n/4 and -1 of the sorted list; sum, count,
    mean; and the labels of the probe and its first closest point (which may be the probe itself). Probes and
    quantiles are found by counting (``operators/selection.py``), so neither points nor distances are sorted.
    """
    spark, scratch = points.sparkSession, Scratch(points.sparkSession)
    points, seen = scratch.cut(points.select(*dict.fromkeys(["idx", label, *space.key_columns])), rows=F.count(F.lit(1)))
    n = seen["rows"]
    mark = n // 4
    last_mark = n - mark if mark else 0
    positions = sorted({0, mark, 2 * mark, last_mark, n - 1}) if n else []
    at = select_ranks(points.withColumn("all", F.lit(0)), "all", "idx", [(0, p) for p in positions])
    carry = list(dict.fromkeys([label, *space.key_columns]))
    places = spark.createDataFrame([(p, int(at[0, p])) for p in positions], "probe bigint, idx bigint")
    probes = points.join(F.broadcast(places), "idx").select("probe", *[F.col(c).alias(A + c) for c in carry])
    spread = points.withColumn("probe", F.explode(F.array(*[F.lit(p).cast("long") for p in positions]).cast("array<bigint>")))
    renamed = spread.select("probe", "idx", *[F.col(c).alias(B + c) for c in carry])
    # Five probes at most.
    measured, _ = scratch.cut(
        renamed.join(F.broadcast(probes), "probe").select("probe", space.distance().alias("d"), "idx", A + label, B + label)
    )
    marks = {"q0": 0, "q1": mark, "q2": 2 * mark, "q3": last_mark, "q4": n - 1}
    values = select_ranks(measured, "probe", "d", sorted({(p, r) for p in positions for r in marks.values()}))
    quantiles = spark.createDataFrame(
        [(p, *[values[p, r] for r in marks.values()]) for p in positions], "probe bigint, " + ", ".join(f"{q} double" for q in marks)
    )
    closest = smallest(measured, "probe", ["d", "idx", B + label], 50).select(
        "probe", F.filter("rows", lambda x, i: i % 5 == 0)["d"].alias("head"), F.col("rows")[0][B + label].alias("nearest_label")
    )
    totals = measured.groupBy("probe").agg(
        F.sum("d").alias("total"), F.count("d").alias("points"), F.avg("d").alias("mean"), F.max(A + label).alias("probe_label"),
    )
    return totals.join(F.broadcast(quantiles), "probe").join(closest, "probe").select(
        "probe", "head", "total", "points", "mean", *marks, "probe_label", "nearest_label"
    )


def distance_ranks(points: DataFrame, space: Space, position: int, head: int = 20, step: int = 500) -> DataFrame:
    """Sorted distances from one probe to all other points: the ``head`` smallest and every ``step``-th."""
    scratch = Scratch(points.sparkSession)
    measured = _probe_distances(points, space, [position], scratch, []).where("position <> probe")
    ranked = number_rows(measured.select("d", "position"), ["d", "position"], "rank", scratch)
    return ranked.where((F.col("rank") < head) | (F.col("rank") % step == 0)).select("rank", "d")
