"""Order statistics without a sort: counts of a shrinking range, and bounded heaps for the smallest values.

A value becomes a 64-bit key in the same order. Each round counts, for every wanted rank, the next bits of the keys that
share the bits found so far; the counts tell which of them hold the rank. Six rounds read the values and move counts only,
whatever the number of rows or their ties.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits that one round finds; 64 in all.
ROUNDS = (11, 11, 11, 11, 11, 9)
#: Groups in which the smallest rows of the tasks meet first.
SHARES = 256


def ordered(values: np.ndarray) -> np.ndarray:
    """Unsigned keys in the order of 64-bit integers or doubles; -0.0 counts as 0.0."""
    if values.dtype == np.int64:
        return values.view(np.uint64) ^ np.uint64(1 << 63)
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits ^ np.uint64(1 << 63))


def restored(key: int, integers: bool) -> int | float:
    """The value of a key."""
    bits = key ^ (1 << 63) if integers or key >> 63 else key ^ ((1 << 64) - 1)
    return np.array([bits], np.uint64).view(np.int64 if integers else np.float64)[0].item()


def select_ranks(rows: DataFrame, group: str, value: str, targets: Sequence[tuple[int, int]]) -> dict[tuple[int, int], int | float | None]:
    """{(group, rank): value} for 0-based ranks of ``value`` inside groups; None beyond a group's rows.

    ``group`` is an integer column, ``value`` a bigint or double; NULL and NaN values take no part. The targets are a
    bounded list, and what reaches the driver are 2^11 counts for each of them.
    """
    integers = dict(rows.dtypes)[value] != "double"
    kind = "bigint" if integers else "double"
    slim = rows.select(F.col(group).cast("bigint").alias("g"), F.col(value).cast(kind).alias("v")).where("v is not null and not isnan(cast(v as double))")
    found = {t: (0, t[1]) for t in targets}  # bits so far, rank among the keys that share them
    known = 0
    for bits in ROUNDS:
        shift, wanted = 64 - known - bits, {t: f for t, f in found.items() if f is not None}

        def run(batches: Iterator[pa.RecordBatch], shift=shift, bits=bits, wanted=wanted, known=known) -> Iterator[pa.RecordBatch]:
            counts = {t: np.zeros(1 << bits, np.int64) for t in wanted}
            for batch in batches:
                g = batch.column(0).to_numpy(zero_copy_only=False)
                key = ordered(batch.column(1).to_numpy(zero_copy_only=False))
                for t, (prefix, _) in wanted.items():
                    own = key[g == t[0]]
                    if known:
                        own = own[own >> np.uint64(64 - known) == np.uint64(prefix)]
                    counts[t] += np.bincount((own >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
            for (at, rank), n in counts.items():
                bins = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bins), v)) for v in (at, rank)] + [pa.array(bins), pa.array(n[bins])],
                    names=["g", "rank", "bin", "n"],
                )

        rows_found = slim.mapInArrow(run, "g bigint, rank bigint, bin bigint, n bigint").groupBy("g", "rank", "bin").agg(F.sum("n").alias("n")).collect()
        for t in wanted:
            prefix, rank = found[t]
            found[t] = None
            for r in sorted((r for r in rows_found if (r["g"], r["rank"]) == t), key=lambda r: r["bin"]):
                if rank < r["n"]:
                    found[t] = (prefix << bits | r["bin"], rank)
                    break
                rank -= r["n"]
        known += bits
    return {t: None if f is None else restored(f[0], integers) for t, f in found.items()}


def smallest(rows: DataFrame, group: str, order: Sequence[str], count: int) -> DataFrame:
    """(group, rows): the ``count`` smallest rows of each group as a sorted array of structs of the ``order`` columns.

    Groups are a bounded number. A task passes on ``count`` rows of each at most; those meet in ``SHARES`` shares, and a
    group's last step sees ``SHARES`` times ``count`` rows.
    """
    names = [group, *order]
    slim = rows.select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for g in table.column(0).unique().to_pylist():
                own = table.filter(pc.equal(table.column(0), pa.scalar(g, table.schema.field(0).type)))
                both = pa.concat_tables([held[g], own]) if g in held else own
                held[g] = both.sort_by([(n, "ascending") for n in order]).slice(0, count).combine_chunks()
        for table in held.values():
            yield from table.to_batches()

    kept = slim.mapInArrow(run, slim.schema).select(group, F.struct(*order).alias("_row"), (F.spark_partition_id() % SHARES).alias("_share"))
    least = F.slice(F.array_sort(F.collect_list("_row")), 1, count)
    first = kept.groupBy(group, "_share").agg(least.alias("_rows"))
    return first.select(group, F.explode("_rows").alias("_row")).groupBy(group).agg(least.alias("rows"))
