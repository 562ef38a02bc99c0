"""Known hashes kept in their blocks, so that a batch is assigned without blocking the history again.

An index holds each distinct hash once for every choice of agreeing blocks, with the place of its first appearance and its
cluster. Rows lie in directories by batch and slot, a slot being a share of the (choice, value) pairs. A batch is blocked
alone; it reads the slots that its own values fall into and there the rows of its values. What it adds is a new
directory. A batch counts once it is in the log, whose row is written last: files of a run that failed are never read
and are replaced when the batch is run again.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.operators.assign import Assignment, first_rounds, resolve
from adgrove.operators.hash_blocks import COPY_COST, WIDER, met_blocks, some_keys
from adgrove.operators.pairs import BUCKET_LIMIT, spread_keys
from adgrove.operators.scratch import Scratch
from adgrove.operators.skew import join_spread
from adgrove.operators.spaces import HashSpace

LOG = "number int, name string, next_pos bigint, next_id bigint, eps double, bits int, blocks int, slots int"
#: Tasks that write the rows of one slot.
WRITERS = 4


@dataclass(frozen=True)
class BlockIndex:
    """``space`` with its number of blocks fixed; ``slots`` directories for each batch."""

    path: str
    space: HashSpace
    slots: int

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LOG).parquet(f"{self.path}/log")

    def state(self, spark: SparkSession) -> dict:
        """Last row of the log."""
        return self.log(spark).orderBy(F.desc("number")).first().asDict()

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64("choice", "value"), F.lit(self.slots)).cast("int").alias("slot")

    def blocked(self, keys: DataFrame) -> DataFrame:
        """Keys in each of their blocks, with the slot."""
        return self.space.left(keys).select("*", self._slot())

    def read(self, spark: SparkSession, batches: list[int], slots: list[int]) -> DataFrame:
        """Block rows of some batches in some slots; both are directories, so others are not opened."""
        h = self.space.column
        schema = f"kid bigint, {h} bigint, cluster_id bigint, choice int, upto int, value bigint, batch int, slot int"
        if not batches or not slots:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/rows").where(F.col("batch").isin(batches) & F.col("slot").isin(slots))


def create_index(spark: SparkSession, path: str, space: HashSpace, expected: int, slots: int = 256) -> BlockIndex:
    """New index for about ``expected`` distinct hashes: that sets the number of blocks, and so how fine they are.

    More slots mean that a small batch reads less, and more files. With more hashes than expected everything stays exact and
    blocks get larger; build a new index then.
    """
    index = BlockIndex(path, space.tuned(expected, COPY_COST), slots)
    _commit(index, spark, 0, "", 0, 1)
    return index


def open_index(spark: SparkSession, path: str, column: str = "hash") -> BlockIndex:
    row = BlockIndex(path, HashSpace(0.0), 1).state(spark)
    return BlockIndex(path, HashSpace(row["eps"], row["bits"], column, row["blocks"]), row["slots"])


def _commit(index: BlockIndex, spark: SparkSession, number: int, name: str, next_pos: int, next_id: int) -> None:
    s = index.space
    row = (number, name, next_pos, next_id, s.eps, s.bits, s.blocks, index.slots)
    spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(f"{index.path}/log")


def _append(index: BlockIndex, keys: DataFrame, number: int) -> None:
    """Block rows of new keys (kid, hash, cluster_id) as a batch."""
    rows = index.blocked(keys.select("kid", index.space.column, "cluster_id"))
    dealt = rows.repartition("slot", F.pmod(F.xxhash64("kid"), F.lit(WRITERS))).sortWithinPartitions("slot", "choice", "value")
    dealt.write.mode("overwrite").partitionBy("slot").parquet(f"{index.path}/rows/batch={number}")


def _refuse_unknown(seen: dict, what: str) -> None:
    if seen["unknown"]:
        raise ValueError(f"NULL {what} or hash: such rows have no distance; give them a hash or leave them out")


def load_history(index: BlockIndex, history: DataFrame, name: str = "history") -> None:
    """Known items (pos, hash, cluster_id) into an empty index; of equal hashes the first one counts."""
    spark, h = history.sparkSession, index.space.column
    now = index.state(spark)
    if now["number"]:
        raise ValueError("the index is not empty")
    scratch = Scratch(spark)
    rows, seen = scratch.cut(
        history.select("pos", h, F.col("cluster_id").cast("bigint").alias("cluster_id")), last=F.max("pos"),
        last_id=F.max("cluster_id"), unknown=F.count_if(F.col("pos").isNull() | F.col(h).isNull()),
    )
    _refuse_unknown(seen, "pos")
    first = rows.groupBy(h).agg(F.min(F.struct("pos", "cluster_id")).alias("first"))
    _append(index, first.select(F.col("first.pos").alias("kid"), h, F.col("first.cluster_id").alias("cluster_id")), 1)
    after = 0 if seen["last"] is None else seen["last"] + 1
    _commit(index, spark, 1, name, after, (seen["last_id"] or 0) + 1)


def assign_batch(index: BlockIndex, batch: DataFrame, name: str, bucket_limit: int = BUCKET_LIMIT) -> Assignment:
    """Ids for ``batch`` (idx, hash) by the rule of :func:`assign_incremental`, and its new hashes into the index.

    A name that is in the log already gets the ids it got then and adds nothing, so a batch can be run again. ``idx`` orders
    the batch and is unique; NULLs are refused. Batches are assigned one after the other, not side by side.
    """
    spark, space, h = batch.sparkSession, index.space, index.space.column
    log = {r["name"]: r for r in index.log(spark).where(F.col("name") == name).collect()}
    if name in log:
        number, start = log[name]["number"], index.log(spark).where(F.col("number") < log[name]["number"]).agg(F.max("next_id")).first()[0]
        return _assigned(index, spark, number, start, log[name]["next_id"])
    now, scratch = index.state(spark), Scratch(spark)
    number = now["number"] + 1
    batch, seen = scratch.cut(
        batch.select("idx", h), rows=F.count(F.lit(1)), first=F.min("idx"), last=F.max("idx"),
        unknown=F.count_if(F.col("idx").isNull() | F.col(h).isNull()),
    )
    _refuse_unknown(seen, "idx")
    shift = now["next_pos"] - (seen["first"] or 0)
    keys = batch.groupBy(h).agg((F.min("idx") + shift).alias("kid"), F.count(F.lit(1)).alias("weight"))
    keys, made = scratch.cut(spread_keys(keys), rows=F.count(F.lit(1)))
    held, mine = touched(index, keys.select("kid", h), number, scratch)
    held, _ = scratch.cut(held)
    owners, owned = scratch.cut(held.select("kid", h, "cluster_id").distinct(), rows=F.count(F.lit(1)))
    both = owners.select("kid", h, F.lit(0).alias("late")).unionByName(keys.select("kid", h, F.lit(1).alias("late")))
    looked = first_rounds(spread_keys(both), owned["rows"] + made["rows"], space, scratch, bucket_limit).where("late = 1")
    found = _nearest(index, held, mine.join(looked.select("kid", "open"), "kid"), owned["rows"] + made["rows"], scratch, bucket_limit)
    hits = found.unionByName(looked.where("best is not null").select("kid", "best"))
    nearest, met = scratch.cut(hits.groupBy("kid").agg(F.min("best").alias("n")).select("kid", "n.*"), rows=F.count(F.lit(1)))
    first = now["next_pos"]
    meant = nearest.where(F.col("other") < first)
    owner = owners.select(F.col("kid").alias("other"), "cluster_id").join(meant.groupBy("other").agg(F.count(F.lit(1)).alias("weight")), "other")
    old, _ = scratch.cut(join_spread(meant, owner, ["other"], "weight", max(1, met["rows"])))
    free = keys.select("kid").join(old.select("kid"), "kid", "left_anti")
    pointers = free.join(nearest.where(F.col("other") >= first).select("kid", F.col("other").alias("target")), "kid", "left")
    ids, opened = resolve(pointers, old.select("kid", "cluster_id"), now["next_id"], scratch)
    by_key, _ = scratch.cut(keys.join(ids, "kid").select("kid", h, "weight", "cluster_id"))
    points = join_spread(batch, by_key.select(h, "weight", "cluster_id"), [h], "weight", max(1, seen["rows"]))
    points.select("idx", "cluster_id").write.mode("overwrite").parquet(f"{index.path}/points/batch={number}")
    # A hash of the history is there already, under its first appearance.
    _append(index, by_key.join(old.where("d = 0").select("kid"), "kid", "left_anti"), number)
    last = now["next_pos"] if seen["last"] is None else seen["last"] + shift + 1
    _commit(index, spark, number, name, last, now["next_id"] + opened)
    return _assigned(index, spark, number, now["next_id"], now["next_id"] + opened)


def _assigned(index: BlockIndex, spark: SparkSession, number: int, start: int, after: int) -> Assignment:
    points = spark.read.schema("idx bigint, cluster_id bigint").parquet(f"{index.path}/points/batch={number}")
    return Assignment(points, spark.createDataFrame([(start, after)], "start_id bigint, next_id bigint"))


def touched(index: BlockIndex, keys: DataFrame, number: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows of the index in the blocks of ``keys``, those keys in their blocks). Slots are a bounded number."""
    spark = keys.sparkSession
    mine, _ = scratch.cut(index.blocked(keys))
    slots = [r["slot"] for r in mine.select("slot").distinct().collect()]
    values = mine.select("choice", "value").distinct()
    held = index.read(spark, list(range(1, number)), slots)
    # The index side can be hot in a value: sort-merge with skew splitting, never a broadcast of a growing list.
    return held.join(values.hint("merge"), ["choice", "value"], "left_semi").drop("batch", "slot"), mine.drop("slot")


def _nearest(index: BlockIndex, held: DataFrame, mine: DataFrame, n_keys: int, scratch: Scratch, bucket_limit: int) -> DataFrame:
    """(kid, best): for each ``open`` key of the batch its nearest earlier one, known or new, in parts; all are in their blocks.

    Keys of the batch come after all known ones.
    """
    columns = ["kid", index.space.column, "choice", "value"]
    rows = held.select(*columns, F.lit(False).alias("looks_")).unionByName(mine.select(*columns, F.col("open").alias("looks_")))
    limit = WIDER * bucket_limit
    search = met_blocks(rows.where(some_keys(limit)), index.space, (), scratch, limit)
    return replace(search, n_keys=n_keys).nearest(rows)


def compact(index: BlockIndex, spark: SparkSession, path: str) -> BlockIndex:
    """The index with all batches in one, at a new path; the old one stays until its readers are done.

    Ids of earlier batches stay with the old path.
    """
    now = index.state(spark)
    new = BlockIndex(path, index.space, index.slots)
    rows = index.read(spark, list(range(1, now["number"] + 1)), list(range(index.slots))).drop("batch")
    dealt = rows.repartition("slot", F.pmod(F.xxhash64("kid"), F.lit(WRITERS))).sortWithinPartitions("slot", "choice", "value")
    dealt.write.mode("overwrite").partitionBy("slot").parquet(f"{path}/rows/batch=1")
    _commit(new, spark, 0, "", 0, 1)
    _commit(new, spark, 1, "compacted", now["next_pos"], now["next_id"])
    return new
