"""Stable assignment of new creatives to known clusters."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adgrove.operators.components import follow_pointers
from adgrove.operators.hash_blocks import prepare_blocks
from adgrove.operators.numbering import number_rows
from adgrove.operators.pairs import BUCKET_LIMIT, spread_keys
from adgrove.operators.scratch import Scratch
from adgrove.operators.skew import join_spread
from adgrove.operators.spaces import HashSpace


#: Differing bits of the first rounds of a search for the nearest, before it goes as far as eps.
ROUNDS = (2, 4)


@dataclass(frozen=True)
class Assignment:
    """``points``: idx, cluster_id. ``bounds``: start_id (first new id) and next_id."""

    points: DataFrame
    bounds: DataFrame


def assign_incremental(
    batch: DataFrame, history: DataFrame, space: HashSpace, bucket_limit: int = BUCKET_LIMIT
) -> Assignment:
    """Ids for ``batch`` (idx, hash) given ``history`` (pos, hash, cluster_id).

    Each new item joins its nearest earlier item closer than eps (history first, then earlier items of the
    batch; the first one wins a tie) and takes its id; without one it opens the next id after the history's
    largest. Equal hashes meet as one key ordered by first appearance, so only distinct hashes are compared,
    and only keys of the batch are compared with earlier ones: the history never meets itself. ``idx`` and ``pos``
    are unique. NULLs are refused.
    """
    scratch = Scratch(batch.sparkSession)
    h = space.column
    batch, new_seen = scratch.cut(
        batch.select("idx", h), rows=F.count(F.lit(1)), first=F.min("idx"),
        unknown=F.count_if(F.col("idx").isNull() | F.col(h).isNull()),
    )
    history, seen = scratch.cut(
        history.select("pos", h, F.col("cluster_id").cast("long").alias("cluster_id")), last=F.max("cluster_id"),
        last_pos=F.max("pos"), unknown=F.count_if(F.col("pos").isNull() | F.col(h).isNull()),
    )
    if new_seen["unknown"] or seen["unknown"]:
        raise ValueError("NULL idx, pos or hash: such rows have no distance; give them a hash or leave them out")
    start_id = (seen["last"] or 0) + 1
    # Positions of the batch go on where those of the history end: key ids in order of first appearance, without a sort.
    shift = 0 if seen["last_pos"] is None or new_seen["first"] is None else seen["last_pos"] + 1 - new_seen["first"]
    known = history.select(F.lit(0).alias("late"), F.col("pos").alias("kid"), h, "cluster_id")
    new = batch.select(
        F.lit(1).alias("late"), (F.col("idx") + shift).alias("kid"), h, F.lit(None).cast("long").alias("cluster_id")
    )
    keys = known.unionByName(new).groupBy(h).agg(
        F.min(F.struct("kid", "late", "cluster_id")).alias("first"), F.sum("late").alias("weight")
    ).select(h, "first.*", "weight")
    keys, seen = scratch.cut(spread_keys(keys), rows=F.count(F.lit(1)))
    looked = first_rounds(keys, seen["rows"], space, scratch, bucket_limit)
    # The later key of a pair is the larger one, and only keys of the batch look for a nearest.
    nearest = (
        nearest_of(looked, seen["rows"], space, scratch, bucket_limit).unionByName(looked.where("best is not null").select("kid", "best"))
        .groupBy("kid").agg(F.min("best")["other"].alias("target"))
    )
    fresh = keys.where("late = 1").select("kid")
    opened, count = resolve(
        fresh.join(nearest, "kid", "left"), keys.where("late = 0").select("kid", "cluster_id"), start_id, scratch
    )
    by_key = keys.select("kid", h, "weight").join(opened, "kid").select(h, "weight", "cluster_id")
    points = join_spread(batch, by_key, [h], "weight", max(1, new_seen["rows"])).select("idx", "cluster_id")
    bounds = batch.sparkSession.createDataFrame(
        [(start_id, start_id + count)], "start_id bigint, next_id bigint"
    )
    return Assignment(points, bounds)


def nearest_of(looked: DataFrame, n_keys: int, space: HashSpace, scratch: Scratch, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(kid, best): for each ``open`` key its nearest earlier one and the distance, as parts whose least is right."""
    search = prepare_blocks(looked, n_keys, space, scratch, (), bucket_limit)
    return search.nearest(search.bucketed(looked, [], F.col("open")))


def first_rounds(keys: DataFrame, n_keys: int, space: HashSpace, scratch: Scratch, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``keys`` (kid, hash, late) with ``best``, the nearest earlier key so far, and ``open`` where a nearer one can exist.

    Hashes that differ in few bits are looked for first, in much finer blocks. All others are at least one bit more apart,
    so a key that has a nearest below that distance is done: in dense places nearly all are.
    """
    looked = keys.withColumns({"open": F.col("late") == 1, "best": F.lit(None).cast("struct<d: double, other: bigint>")})
    for reach in ROUNDS:
        if reach >= space.slack:
            break
        parts = nearest_of(looked, n_keys, replace(space, reach=reach, blocks=None), scratch, bucket_limit)
        found = parts.groupBy("kid").agg(F.min("best").alias("found"))
        looked, _ = scratch.cut(
            looked.join(found, "kid", "left").withColumn("best", F.least("best", "found")).drop("found")
            .withColumn("open", F.col("open") & ~F.coalesce(F.col("best.d") < (reach + 1) / space.bits, F.lit(False)))
        )
    return looked


def resolve(pointers: DataFrame, known: DataFrame, start_id: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """((kid, cluster_id) of every key, number of ids opened). Chains of (kid, target) end at a key of ``known``, which is no
    kid of them, or at one without a target, which opens the next id in order of kids."""
    ends = follow_pointers(
        pointers.select(F.col("kid").alias("node"), F.coalesce("target", "kid").alias("target")), scratch
    )
    roots = pointers.select("kid").join(ends.where("node = target"), F.col("kid") == F.col("node"), "left_semi")
    opened, counts = scratch.cut(
        number_rows(roots, ["kid"], "n", scratch).select("kid", (F.col("n") + start_id).alias("cluster_id")),
        rows=F.count(F.lit(1)),
    )
    ids = known.select("kid", "cluster_id").unionByName(opened)
    reached = ends.select(F.col("node").alias("_node"), F.col("target").alias("kid")).join(ids, "kid")
    return known.select("kid", "cluster_id").unionByName(reached.select(F.col("_node").alias("kid"), "cluster_id")), counts["rows"]
