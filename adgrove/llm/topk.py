"""Exact nearest vectors by inner product, with a vector-approximation file.

Every vector is also kept as one small cell number per dimension. A first scan of the cells alone gives each query a score
that k vectors are sure to reach; a second one keeps the vectors whose best possible score is not below it. Exact
vectors are then read in the order of that bound: the best few first, and after them only those whose bound is not
below the k-th exact score found. What is left cannot matter. Bounds are doubles and carry a margin for all their
rounding; scores are whole numbers, in 64 bits where no score can exceed them and as decimals elsewhere.

Queries are a stated set, taken in blocks of bounded size; each block meets all rows in one pass of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adgrove.llm.common import MOST_GROUPS, arrow_schema, map_arrow, table
from adgrove.operators.scratch import Scratch

#: Bits of a cell number.
BITS = 6
#: Queries that meet the table at once.
BLOCK = 8192
#: Components are held to this size, so that 65,536 products add up within 38 digits.
LARGEST = 1 << 55
#: Vectors scored at once in a task.
TILE = 1024
#: Shares into which a group of equal vectors is cut before its smallest ids are taken.
SALTS = 64

RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


def integer_vectors(df: DataFrame, scale: int) -> DataFrame:
    """Rows with ``v = floor(scale * x)``, held to +-``LARGEST``, in place of the embedding.

    Rows with NULL ids, NULL or empty vectors, NULL or non-finite parts are out.
    """
    parts = F.transform("embedding", lambda x: x.cast("double"))
    odd = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    most, least = F.lit(LARGEST).cast("long"), F.lit(-LARGEST).cast("long")
    whole = F.transform(parts, lambda x: F.greatest(F.least(F.floor(x * scale).cast("long"), most), least))
    return (
        df.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~F.coalesce(odd, F.lit(True)))
        .withColumn("v", whole).drop("embedding")
    )


def smallest_of_equals(vectors: DataFrame, k: int) -> DataFrame:
    """Of equal vectors the rows with the k + 1 smallest ids: with ties to smaller ids no other can be in a result.

    A group of any size is ranked in ``SALTS`` shares first, and each task passes on k + 1 rows of a share at most.
    Repeated rows count once.
    """
    share = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    first = Window.partitionBy("v", "share").orderBy("vec_id")
    last = Window.partitionBy("v").orderBy("vec_id")
    return (
        vectors.withColumn("share", share)
        .withColumn("n", F.dense_rank().over(first)).where(F.col("n") <= k + 1).dropDuplicates(["v", "share", "n"])
        .withColumn("n", F.row_number().over(last)).where(F.col("n") <= k + 1)
        .select("vec_id", "v")
    )


def ranges(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each dimension."""
    ddl = "at int, low bigint, high bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dim, LARGEST), np.full(dim, -LARGEST)
        for b in batches:
            if b.num_rows:
                m = b.column(0).flatten().to_numpy().reshape(-1, dim)
                low, high = np.minimum(low, m.min(0)), np.maximum(high, m.max(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim), pa.int32()), pa.array(low), pa.array(high)], schema=schema
        )

    rows = (
        vectors.select("v").mapInArrow(run, ddl)
        .groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("at").collect()
    )
    return np.array([r["low"] for r in rows], np.int64), np.array([r["high"] for r in rows], np.int64)


class Cells:
    """Equal cells of each dimension between its smallest and largest value."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int = BITS):
        self.low, self.high = low, high
        self.size = np.maximum(1, -(-(high - low + 1) // (1 << bits)))

    def codes(self, v: np.ndarray) -> np.ndarray:
        return ((v - self.low) // self.size).astype(np.uint8)

    def centres(self, codes: np.ndarray) -> np.ndarray:
        return self.low + codes * self.size + (self.size - 1) / 2

    def slack(self, queries: np.ndarray) -> np.ndarray:
        """How far a query's score with a vector can lie from the double found for the centre of the vector's cell.

        The second part is more than all roundings on the way: of components and centres to doubles, of a sum of
        ``dim`` products, and of the comparisons with bounds and exact scores that follow.
        """
        reach, most = np.abs(queries), np.maximum(np.abs(self.low), np.abs(self.high)) + self.size
        return reach @ ((self.size - 1) / 2) + (len(self.low) + 16) * 2.0 ** -51 * (reach @ most)

    def score_exceeds_long(self) -> bool:
        """Whether the inner product of two vectors in range may need more than 64 bits."""
        return sum(max(abs(int(a)), abs(int(b))) ** 2 for a, b in zip(self.low, self.high)) >= 1 << 63


def approximate(vectors: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """(vec_id, cells, v): the approximation next to the exact vector, as columns that are read on their own."""
    ddl = "vec_id bigint, cells binary, v array<bigint>"
    schema = arrow_schema(ddl)

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if batch.num_rows:
                codes = cells.codes(batch.column("v").flatten().to_numpy().reshape(batch.num_rows, dim))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array([c.tobytes() for c in codes], pa.binary()),
                     batch.column("v").cast(schema.field("v").type)], schema=schema,
                )

        return step

    return map_arrow(vectors.select("vec_id", "v"), make, ddl)


def own_pairs(ids: np.ndarray, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``vec``, position in ``ids``) of all pairs with equal ids; either side may repeat an id."""
    order = np.argsort(ids, kind="stable")
    first, last = np.searchsorted(ids[order], vec, "left"), np.searchsorted(ids[order], vec, "right")
    n = last - first
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.arange(len(vec)), n), order[np.repeat(first, n) + within]


def centre_scores(batch: pa.RecordBatch, cells: Cells, ids: np.ndarray, queries: np.ndarray) -> Iterator:
    """(tile, scores with cell centres, vector by query) of a batch in tiles; vectors of a query's own id are at -inf."""
    dim = queries.shape[1]
    for low in range(0, batch.num_rows, TILE):
        part = batch.slice(low, TILE)
        codes = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, dim)
        s = cells.centres(codes) @ queries.T
        s[own_pairs(ids, part.column("vec_id").to_numpy())] = -np.inf
        yield part, s


def sure_scores(approx: DataFrame, cells: Cells, ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that at least k vectors reach, -inf with fewer vectors."""
    schema = arrow_schema("query int, best array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((k, len(ids)), -np.inf)
        slack = cells.slack(queries)
        for b in batches:
            for _, s in centre_scores(b, cells, ids, queries):
                both = np.concatenate([best, s - slack])
                best = np.partition(both, len(both) - k, axis=0)[len(both) - k:]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(ids)), pa.int32()), pa.array(list(best.T), pa.list_(pa.float64()))], schema=schema
        )

    rows = (
        approx.select("vec_id", "cells").mapInArrow(run, "query int, best array<double>")
        .select("query", F.explode("best").alias("s"))
        .withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("s")))).where(f"n = {k}")
        .select("query", "s").collect()
    )
    out = np.full(len(ids), -np.inf)
    for r in rows:
        out[r["query"]] = r["s"]
    return out


def candidates(approx: DataFrame, cells: Cells, ids: np.ndarray, queries: np.ndarray, sure: np.ndarray) -> DataFrame:
    """(query, row, bound) of the vectors whose best possible score is not below ``sure``."""
    ddl = "query int, row bigint, bound double"
    schema = arrow_schema(ddl)

    def make():
        slack = cells.slack(queries)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, s in centre_scores(batch, cells, ids, queries):
                at, query = np.nonzero((s + slack >= sure) & (s > -np.inf))
                rows = part.column("row").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int32()), pa.array(rows[at]), pa.array(s[at, query] + slack[query])], schema=schema
                )

        return step

    return map_arrow(approx.select("row", "vec_id", "cells"), make, ddl)


def dot(a: str, b: str, wide: bool) -> Column:
    """Inner product as a whole number: decimal where ``wide``, else a long that can't overflow."""
    part, total = ("decimal(18,0)", "decimal(38,0)") if wide else ("long", "long")
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast(part) * y.cast(part)).cast(total)), F.lit(0).cast(total),
        lambda acc, x: (acc + x).cast(total),
    )


def read_exact(chosen: DataFrame, approx: DataFrame, asked: DataFrame, wide: bool) -> DataFrame:
    """(query, query_id, row, vec_id, score): exact scores of chosen candidates."""
    return (
        approx.select("row", "vec_id", "v").join(chosen, "row").join(F.broadcast(asked), "query")
        .select("query", "query_id", "row", "vec_id", dot("v", "q", wide).cast("decimal(38,0)").alias("score"))
    )


def block_top_k(spark: SparkSession, approx: DataFrame, cells: Cells, block: list, k: int, scratch: Scratch) -> DataFrame:
    """(query_id, vec_id, score): the k best vectors of every row of a block of (vec_id, v) rows.

    The first 2k candidates of each query come from a limit that every task applies before it passes rows on. The
    others are never ranked: those whose bound reaches the k-th score of the first are read as well.
    """
    ids = np.array([r["vec_id"] for r in block], np.int64)
    queries = np.array([r["v"] for r in block], np.float64)
    asked = spark.createDataFrame(
        [(i, r["vec_id"], list(r["v"])) for i, r in enumerate(block)], "query int, query_id bigint, q array<bigint>"
    )
    wide = cells.score_exceeds_long()
    sure = sure_scores(approx, cells, ids, queries, k)
    possible, _ = scratch.cut(candidates(approx, cells, ids, queries, sure))
    by_bound = Window.partitionBy("query").orderBy(F.desc("bound"), "row")
    best = possible.withColumn("n", F.row_number().over(by_bound)).where(F.col("n") <= 2 * k).select("query", "row")
    first, _ = scratch.cut(read_exact(F.broadcast(best), approx, asked, wide))  # 2k rows for each query of a block
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = first.withColumn("n", F.row_number().over(by_score))
    reached = ranked.where(F.col("n") == k).select("query", F.col("score").cast("double").alias("reached"))
    rest = (
        possible.join(F.broadcast(reached), "query").where(F.col("bound") >= F.col("reached"))
        .join(F.broadcast(first.select("query", "row")), ["query", "row"], "left_anti").select("query", "row")
    )
    return (
        first.unionByName(read_exact(rest, approx, asked, wide))
        .withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k)
        .select("query_id", "vec_id", "score")
    )


def top_k(df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query, ties to smaller ids.

    ``df`` has (vec_id, embedding) rows; components become ``floor(scale * x)``, held to +-2^55. Rows marked by
    ``is_query`` are the queries, all rows of other ids their candidates. Rows with a NULL id or a vector that is NULL,
    empty or holds NULL or non-finite parts take no part; repeated rows count once; an id with several vectors asks
    with all of them, and its k highest scores are ranked together; vectors of different lengths do not meet. Fewer
    than k candidates give as many rows. A score beyond 64 bits is NULL, in its right rank.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = df.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asked"))
    vectors, _ = scratch.cut(integer_vectors(rows, scale).withColumn("dim", F.size("v")))
    dims = [r["dim"] for r in vectors.select("dim").distinct().limit(MOST_GROUPS + 1).collect()]
    if len(dims) > MOST_GROUPS:
        raise ValueError(f"vectors have more than {MOST_GROUPS} lengths")
    found = []
    for dim in sorted(dims):
        same = vectors.where(F.col("dim") == dim)
        queries, seen = scratch.cut(
            same.where("asked").select("vec_id", "v").distinct(), rows=F.count(F.lit(1))
        )
        if not seen["rows"]:
            continue
        blocks = -(-seen["rows"] // block)
        cells = Cells(*ranges(same, dim))
        kept = smallest_of_equals(same.select("vec_id", "v"), k)
        approx, _ = scratch.cut(approximate(kept, cells, dim).withColumn("row", F.monotonically_increasing_id()))
        for b in range(blocks):
            part = queries.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == b).collect()
            if part:
                found.append(scratch.cut(block_top_k(spark, approx, cells, part, k, scratch))[0])
    if not found:
        return spark.createDataFrame([], RESULT)
    out = found[0]
    for r in found[1:]:
        out = out.unionByName(r)
    by_id = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(by_id)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
        F.when(F.col("score").between(-(1 << 63), (1 << 63) - 1), F.col("score")).cast("long").alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors of every vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.vec_id as query_id, b.vec_id,
    cast(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where a.vec_id % 20 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 20
"""
