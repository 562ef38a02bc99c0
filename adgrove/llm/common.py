"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str) -> Column:
    """crc32 of an id written as text; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow form of a flat DDL schema of scalars and arrays of scalars; needs no session, so tasks can call it."""
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
    }

    def kind(name: str) -> pa.DataType:
        return pa.list_(kind(name[6:-1])) if name.startswith("array<") else kinds[name]

    return pa.schema([(n, kind(t)) for n, t in (field.split() for field in ddl.split(","))])


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A session setting for the jobs started inside, put back afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def delete(spark: SparkSession, uri: str) -> None:
    """Removes a folder that no DataFrame in use reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


Step = Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]


def release() -> None:
    """Gives memory that Arrow keeps for later back to the system: the worker process lives on after the task."""
    pa.default_memory_pool().release_unused()


def map_arrow(df: DataFrame, make: Callable[[], Step], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with state per task: ``make()`` runs once in each task and returns the function for batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield from step(batch)
        release()

    return df.mapInArrow(run, schema)


def map_rows(
    df: DataFrame, keep: Sequence[str], inputs: Sequence[str], make: Callable[[], Callable], ddl: str
) -> DataFrame:
    """Columns ``keep`` of every row, next to new columns that a batch function derives from ``inputs``.

    ``make()`` runs once in each task and returns a function from the input arrays to one list or array for each
    field of ``ddl``, with as many entries as there are rows. Kept columns pass through untouched, whatever their
    names and types are; where a kept column and a new one have the same name, the new one stays. An input ``a.b`` of a
    kept struct ``a`` is read inside it, so it does not travel twice.
    """
    new = T._parse_datatype_string(ddl)
    keep = [c for c in keep if c not in new.names]
    nested = {c: c.split(".") for c in inputs if "." in c and c.split(".")[0] in keep}
    apart = [c for c in inputs if c not in nested]
    packed = df.select(
        F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("_kept"),
        *[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(apart)],
    )
    kinds = arrow_schema(ddl)

    def wrapped() -> Step:
        derive = make()

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            given = dict(zip(apart, batch.columns[1:]))
            made = derive(*[
                pc.struct_field(batch.column(0), nested[c]) if c in nested else given[c] for c in inputs
            ])
            arrays = [m if isinstance(m, pa.Array) else pa.array(m, f.type) for m, f in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["_kept", *kinds.names])

        return step

    schema = T.StructType([packed.schema["_kept"], *new.fields])
    out = map_arrow(packed, wrapped, schema)
    return out.select(*[F.col("_kept").getField(c).alias(c) for c in keep], *new.names)


def map_runs(
    df: DataFrame, keys: Sequence[str], partitions: int | None, make: Callable[[], Step], schema: str | T.StructType
) -> DataFrame:
    """Applies a function to the rows of each key as one batch, many keys in a task.

    Unlike a grouped map there is no call from the JVM for each key. Rows of a key meet in one task, so the caller
    must know a bound for them.
    """
    dealt = df.repartition(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
    count = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, held, last = make(), [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()
                yield from step(whole[0])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(count)]
            change = np.zeros(batch.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            first = tuple(c[0] for c in columns)
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
                if i or first != last:
                    yield from flush()
                    held = []
                if high > low:
                    held.append(batch.slice(low, high - low))
            last = tuple(c[-1] for c in columns)
        yield from flush()
        held = []
        release()

    names = [*keys, *[c for c in dealt.columns if c not in keys]]
    return dealt.select(*names).mapInArrow(run, schema)


MOST_GROUPS = 1000


def bounded_sample(df: DataFrame, group: str, key: str, most: int, seed: int = 7) -> DataFrame:
    """At most ``most`` rows of each value of ``group``, chosen by a hash of ``key``; NULL groups are left out.

    Groups are thinned by a hash threshold from their counts first, so the final ranking sees about twice
    ``most`` rows of each group however large the group is. Groups with fewer rows are taken whole. The counts
    reach the driver, so more than ``MOST_GROUPS`` groups are refused.
    """
    df = df.where(F.col(group).isNotNull())
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows")).limit(MOST_GROUPS + 1).collect()
    if len(counts) > MOST_GROUPS:
        raise ValueError(f"{group} has more than {MOST_GROUPS} values")
    limit = F.when(F.lit(False), F.lit(None).cast("double"))
    for row in counts:
        limit = limit.when(F.col(group) == F.lit(row[group]), F.lit(2.0 * most / row["rows"]))
    h = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    order = F.row_number().over(Window.partitionBy(group).orderBy("_h", key))
    return (
        df.withColumn("_h", h).where(F.col("_h") < limit)
        .withColumn("_n", order).where(F.col("_n") <= most).drop("_h", "_n")
    )
