"""Connected components and pointer forests as iterated joins on DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adgrove.operators.scratch import Scratch
from adgrove.operators.skew import join_spread


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) replaced by (node, smallest connected node) pairs with the same connectivity."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        ru, rv = root[u], root[v]
        open_ = ru != rv
        if not open_.any():
            break
        np.minimum.at(root, np.maximum(ru, rv)[open_], np.minimum(ru, rv)[open_])
        while not np.array_equal(root[root], root):
            root = root[root]
    child = root != np.arange(len(nodes))
    return nodes[child], nodes[root[child]]


LINK_FIELDS = ("a", "b", "d", "core_a", "core_b")
LINK_SCHEMA = "a bigint, b bigint, d double, core_a boolean, core_b boolean"
_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("d", pa.float64()), ("core_a", pa.bool_()), ("core_b", pa.bool_())])
_BUFFER, _FOREST = 1 << 18, 1 << 21


def contract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Combiner for links between core keys: keeps a star forest per task, passes every other row on.

    However many links a task sees, it emits at most about one row per distinct node among them. Links are
    buffered and folded in when they outnumber the forest; a forest that grows large is emitted early.
    """
    child, parent = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def fold() -> None:
        nonlocal child, parent, held
        child, parent = stars(
            np.concatenate([child, *[a for a, _ in waiting]]), np.concatenate([parent, *[b for _, b in waiting]])
        )
        waiting.clear()
        held = 0

    def forest() -> pa.RecordBatch:
        n = len(child)
        yes = np.ones(n, dtype=bool)
        return pa.RecordBatch.from_arrays(
            [pa.array(child), pa.array(parent), pa.array(np.zeros(n)), pa.array(yes), pa.array(yes)], schema=_ARROW
        )

    for batch in batches:
        both = pc.and_(batch["core_a"], batch["core_b"])
        links = batch.filter(both)
        if links.num_rows:
            waiting.append((links["a"].to_numpy(), links["b"].to_numpy()))
            held += links.num_rows
            if held >= max(_BUFFER, len(child)):
                fold()
                if len(child) > _FOREST:
                    yield forest()
                    child, parent = child[:0], parent[:0]
        if links.num_rows < batch.num_rows:
            yield pa.RecordBatch.from_arrays(batch.filter(pc.invert(both)).columns, schema=_ARROW)
    if held:
        fold()
    if len(child):
        yield forest()


def _pair(u: str, w: str) -> Column:
    return F.struct(F.col(u).alias("u"), F.col(w).alias("w"))


STARS_SCHEMA = "v bigint, m bigint"


def star_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (v, m) of a task as a star forest with the same connectivity: at most one row for each node."""
    rows = [b for b in batches if b.num_rows]
    if rows:
        v, m = stars(*(np.concatenate([b.column(i).to_numpy() for b in rows]) for i in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(m)], names=["v", "m"])


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.

    Tasks of up to ``_FOREST`` edges each replace theirs by a star forest first. If that was one task, all is done;
    else alternating large-star / small-star rounds follow (Kiveris et al., 2014). Minima come from a partially
    aggregated groupBy joined back, never from a collected neighbour list, so a hub costs no single task.
    A round that leaves the edge set unchanged ends the loop; rounds grow with the logarithm of the size.
    """
    current, seen = scratch.cut(
        edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v <> m").distinct(),
        rows=F.count(F.lit(1)),
    )
    tasks = -(-seen["rows"] // _FOREST)
    if tasks:
        current, seen = scratch.cut(
            current.coalesce(tasks).mapInArrow(star_batches, STARS_SCHEMA),
            rows=F.count(F.lit(1)), mark=F.bit_xor(F.xxhash64("v", "m")),
        )
    while tasks > 1:
        last = seen
        both_ways = current.select(F.inline(F.array(_pair("v", "m"), _pair("m", "v"))))
        smallest = both_ways.groupBy("u").agg(
            F.least(F.min("w"), F.col("u")).alias("low"), F.count_if(F.col("w") > F.col("u")).alias("above")
        )
        large = (
            join_spread(both_ways.where("w > u"), smallest, ["u"], "above", last["rows"])
            .select(F.col("w").alias("u"), F.col("low").alias("w")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("w").alias("low"), F.count(F.lit(1)).alias("links"))
        small = join_spread(large, lowest, ["u"], "links", last["rows"])
        following = (
            small.select(F.col("w").alias("v"), F.col("low").alias("m"))
            .unionByName(lowest.select(F.col("u").alias("v"), F.col("low").alias("m")))
            .where("v <> m")
            .distinct()
        )
        current, seen = scratch.cut(
            following, rows=F.count(F.lit(1)), mark=F.bit_xor(F.xxhash64("v", "m"))
        )
        if seen == last:
            break
    # Every component is now one star around its smallest node.
    centres = current.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    return current.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(centres)


def follow_pointers(pointers: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, target) with every target replaced by the end of its chain.

    ``pointers`` must be a forest. A node that points to itself, or a target that is no node, ends a chain.
    Each round doubles the distance covered.
    """
    current, seen = scratch.cut(pointers.select("node", "target"), rows=F.count(F.lit(1)))
    total = max(1, seen["rows"])
    while True:
        # What lies beyond each target, looked up once a target; many nodes may share one, so they meet it by weight.
        targets = current.groupBy("target").agg(F.count(F.lit(1)).alias("weight"))
        hop = current.select(F.col("node").alias("target"), F.col("target").alias("next"))
        beyond = targets.join(hop, "target", "left").select("target", "weight", F.coalesce("next", "target").alias("beyond"))
        step = join_spread(current, beyond, ["target"], "weight", total).select(
            "node", F.col("beyond").alias("target"), (F.col("beyond") != F.col("target")).alias("moved"),
        )
        step, seen = scratch.cut(step, moved=F.count_if("moved"))
        current = step.drop("moved")
        if not seen["moved"]:
            return current
