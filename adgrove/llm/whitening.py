"""Whitening of vectors by their leading principal components, found by slicing the spectrum.

Vectors become integers, so their counts, sums and second moments are exact and can be added up by Spark in any order: a
task centres each block of vectors on the block's own whole mean, multiplies, and moves the exact products to
the common origin. The covariance that follows is rounded once.

Eigenvalues are found by counting: by Sylvester's law of inertia the positive pivots of L D L' = V - s I are as many as V has
eigenvalues above s. Bisection on these counts isolates the k-th largest eigenvalue, Rayleigh quotient iteration
(the same factorisation, shifted by the quotient) converges to it, and two counts on either side of the result certify
its number. Eigenvalues that counts cannot tell apart in double precision share an interval; any orthonormal vectors of
their common space serve.

Vectors of different lengths have no common covariance: each length is a fit list of its own. What the driver holds is
a basis for each length, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, map_runs, release, table

COMPONENTS = 8
#: Vectors that are multiplied at once.
BLOCK = 4096
#: Integers are held to this size, so that differences of two fit 64 bits.
LARGEST = 1 << 61
#: Bits of the parts into which larger integers are cut for products in double precision.
PART = 20


# Eigenvalues of a symmetric matrix


class Factor:
    """L D L' of ``a`` in a pivoted order, D of blocks of order 1 and 2 chosen by Bunch and Kaufman's rule."""

    def __init__(self, a: np.ndarray, tiny: float):
        a, n = a.copy(), len(a)
        self.order, self.lower, self.pivots = np.arange(n), np.eye(n), []
        turn = (1 + math.sqrt(17)) / 8

        def swap(i: int, j: int, done: int) -> None:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]
            self.lower[[i, j], :done] = self.lower[[j, i], :done]

        k = 0
        while k < n:
            size, below = 1, np.abs(a[k + 1:, k])
            if len(below) and (most := below.max()) > 0 and abs(a[k, k]) < turn * most:
                r = k + 1 + int(below.argmax())
                across = np.abs(a[r, k:])
                across[r - k] = 0
                if abs(a[k, k]) * across.max() >= turn * most * most:
                    pass
                elif abs(a[r, r]) >= turn * across.max():
                    swap(k, r, k)
                else:
                    swap(k + 1, r, k)
                    size = 2
            block = a[k: k + size, k: k + size].copy()
            if size == 1 and abs(block[0, 0]) < tiny:
                block[0, 0] = tiny
            rest = a[k + size:, k: k + size]
            self.lower[k + size:, k: k + size] = step = rest @ np.linalg.inv(block)
            a[k + size:, k + size:] -= step @ rest.T
            self.pivots.append((k, block))
            k += size

    def positive(self) -> int:
        """Number of positive eigenvalues."""
        return sum(int(b[0, 0] > 0) if len(b) == 1 else int((np.linalg.eigvalsh(b) > 0).sum()) for _, b in self.pivots)

    def solve(self, v: np.ndarray) -> np.ndarray:
        x = v[self.order].copy()
        for k in range(len(x) - 1):
            x[k + 1:] -= self.lower[k + 1:, k] * x[k]
        for k, block in self.pivots:
            x[k: k + len(block)] = np.linalg.solve(block, x[k: k + len(block)])
        for k in range(len(x) - 1, 0, -1):
            x[:k] -= self.lower[k, :k] * x[k]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Spectrum(NamedTuple):
    """Eigenvalues in falling order, unit eigenvectors as rows, and whether counts confirmed each number."""

    values: np.ndarray
    vectors: np.ndarray
    certified: np.ndarray
    factorisations: int


def leading(v: np.ndarray, most: int = COMPONENTS) -> Spectrum:
    """The ``most`` largest eigenvalues of a covariance; those that are zero up to rounding are left out."""
    n, scale = len(v), float(np.trace(v))
    if not n or not scale > 0:
        return Spectrum(np.empty(0), np.empty((0, n)), np.empty(0, bool), 0)
    unit = np.finfo(float).eps * scale
    counts, made = {2 * scale: 0}, 0

    def factor(shift: float) -> Factor:
        nonlocal made
        made += 1
        return Factor(v - shift * np.eye(n), unit)

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = factor(shift).positive()
        return counts[shift]

    def apart(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in vectors:
                x = x - (other @ x) * other
        return x / np.linalg.norm(x)

    zero = 4 * n * unit
    values, vectors, certified = [], [], []
    for k in range(1, min(most, n, above(zero)) + 1):
        low = max(s for s, c in counts.items() if c >= k)
        high = min(s for s, c in counts.items() if c < k)
        x = apart(np.random.default_rng(k).standard_normal(n))
        while True:
            narrow = high - low <= 4 * unit
            if narrow or counts[low] - counts[high] == 1:
                shift, rounds = (low + high) / 2, 3 if narrow else 12
                for step in range(rounds):
                    x = apart(factor(shift).solve(x))
                    value = float(x @ v @ x)
                    if narrow or step == 0:
                        continue  # one step with a fixed shift turns towards the wanted vector
                    if np.linalg.norm(v @ x - value * x) <= 4 * unit:
                        break
                    shift = value
                if narrow or low < value <= high:
                    break
            middle = (low + high) / 2
            if above(middle) >= k:
                low = middle
            else:
                high = middle
        sign = np.sign(x[np.abs(x).argmax()])
        values.append(value)
        vectors.append(sign * x)
        certified.append(above(value - zero) >= k > above(value + zero))
    order = np.argsort(-np.array(values), kind="stable")
    return Spectrum(np.array(values)[order], np.array(vectors)[order], np.array(certified)[order], made)


# Exact moments


def integers(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the columns that are used."""
    return df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))


def blocks(batch: pa.RecordBatch, scale: int, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, ``floor(scale * c) + shift`` of their vectors) for each length and at most ``BLOCK`` rows.

    Vectors that are NULL or hold NULL or non-finite entries take no part.
    """
    column = batch.column(batch.schema.get_field_index("v"))
    lengths = np.where(column.is_valid(), column.value_lengths().fill_null(0), -1)
    starts = column.offsets.to_numpy()[:-1]
    values = column.values.to_numpy(zero_copy_only=False)  # NULL entries become NaN
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        for low in range(0, len(rows), BLOCK):
            some = rows[low: low + BLOCK]
            m = values[starts[some][:, None] + np.arange(dim)]
            fine = np.isfinite(m).all(1)
            if fine.any():
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(scale * m[fine]), -LARGEST, LARGEST)
                yield some[fine], x.astype(np.int64) + shift


def products(z: np.ndarray) -> np.ndarray:
    """Exact ``z' z`` as Python integers; z has at most ``BLOCK`` rows."""
    parts, rest = [], z
    while len(parts) == 0 or rest.any():
        last = np.abs(rest).max(initial=0) < 1 << PART
        low = rest if last else rest & ((1 << PART) - 1)
        parts.append(low.astype(np.float64))
        if last:
            break
        rest = rest >> PART
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            # Below 2^(20 + 20 + 12): exact in double precision.
            total += (a.T @ b).astype(np.int64).astype(object) << (PART * (i + j))
    return total


class Moments:
    """Exact count, sums and products of the vectors of one length."""

    def __init__(self, dim: int):
        self.n, self.sums, self.products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)

    def add(self, x: np.ndarray) -> None:
        n = len(x)
        sums = (x >> 30).sum(0).astype(object) * (1 << 30) + (x & ((1 << 30) - 1)).sum(0).astype(object)
        centre = sums // n
        z = x - centre.astype(np.int64)
        moved = sums - n * centre  # sum of z
        self.n += n
        self.sums += sums
        self.products += products(z) + np.outer(moved, centre) + np.outer(centre, moved) + n * np.outer(centre, centre)


MOMENTS = "dim int, i int, j int, n decimal(38,0), high decimal(38,0), low decimal(38,0)"


def moments(df: DataFrame, scale: int, shift: int) -> DataFrame:
    """Exact sums for each length: j = -1 has the sum of entry i, others the sum of products, in 64-bit halves.

    Each task passes on one row for each pair of entries, whatever the number of its vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Moments] = {}
        for batch in batches:
            for _, x in blocks(batch, scale, shift):
                found.setdefault(x.shape[1], Moments(x.shape[1])).add(x)
        for dim, m in found.items():
            i, j = np.tril_indices(dim)
            values = [*m.sums, *m.products[i, j]]
            first, second = [*range(dim), *i.tolist()], [-1] * dim + j.tolist()
            halves = [[Decimal(v >> 64) for v in values], [Decimal(v & ((1 << 64) - 1)) for v in values]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(values), pa.int32()), pa.array(first, pa.int32()), pa.array(second, pa.int32()),
                 *[pa.array(c, pa.decimal128(38, 0)) for c in ([Decimal(m.n)] * len(values), *halves)]],
                names=["dim", "i", "j", "n", "high", "low"],
            )
        release()

    parts = df.select("v").mapInArrow(run, MOMENTS)
    return parts.groupBy("dim", "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])


class Basis(NamedTuple):
    """What whitening the vectors of one length needs: count, sums, eigenvalues and vectors, trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


FIT = "dim int, n decimal(38,0), sums array<string>, eigenvalues array<double>, vectors array<double>, trace double"


def _fit(most: int):
    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dim = batch.column("dim")[0].as_py()
        n = int(batch.column("n")[0].as_py())
        sums, raw = [0] * dim, np.zeros((dim, dim), object)
        rows = zip(*[batch.column(c).to_pylist() for c in ("i", "j", "high", "low")])
        for i, j, high, low in rows:
            value = (int(high) << 64) + int(low)
            if j < 0:
                sums[i] = value
            else:
                raw[i, j] = raw[j, i] = value
        # Whole numbers up to the division, which rounds once.
        exact = n * raw - np.outer(np.array(sums, object), np.array(sums, object))
        found = leading(np.array([[e / (n * n) for e in row] for row in exact]), most)
        trace = sum(exact[k, k] for k in range(dim)) / (n * n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([Decimal(n)], pa.decimal128(38, 0)), pa.array([[str(s) for s in sums]]),
             pa.array([found.values.tolist()], pa.list_(pa.float64())),
             pa.array([found.vectors.reshape(-1).tolist()], pa.list_(pa.float64())), pa.array([trace])],
            names=["dim", "n", "sums", "eigenvalues", "vectors", "trace"],
        )

    return lambda: step


def fit(df: DataFrame, scale: int, shift: int, most: int = COMPONENTS) -> dict[int, Basis]:
    """Basis of each vector length; the eigenvalues of each length are found in one task."""
    rows = map_runs(moments(df, scale, shift), ["dim"], None, _fit(most), FIT).collect()
    return {
        r["dim"]: Basis(
            int(r["n"]), [int(s) for s in r["sums"]], np.array(r["eigenvalues"]),
            np.array(r["vectors"]).reshape(len(r["eigenvalues"]), r["dim"]), r["trace"],
        ) for r in rows
    }


# Whitened vectors


def project(x: np.ndarray, b: Basis) -> np.ndarray:
    """Whitened entries: one column for each component that has variance."""
    centre = np.array([s // b.n for s in b.sums], np.int64)
    rest = np.array([s % b.n / b.n for s in b.sums])
    return ((x - centre) - rest) @ b.vectors.T / np.sqrt(b.values)


def deviations(x: np.ndarray, b: Basis) -> np.ndarray:
    """Exact sum over dimensions of (n x - S)^2: 64-bit sums where they hold, Python integers else."""
    centre = np.array([s // b.n for s in b.sums], np.int64)
    rest = [s % b.n for s in b.sums]
    z = x - centre
    most, room = int(np.abs(z).max(initial=0)) + 1, (1 << 63) // x.shape[1]
    small = most * most < room and most * b.n < room
    z, r = (z, np.array(rest, np.int64)) if small else (z.astype(object), np.array(rest, object))
    squares, mixed = (z * z).sum(1), (z * r).sum(1)
    if not (small and (b.n * most) ** 2 < room // 4):
        squares, mixed = squares.astype(object), mixed.astype(object)
    return b.n * b.n * squares - 2 * b.n * mixed + sum(k * k for k in rest)


def identity_errors(df: DataFrame, bases: dict[int, Basis], scale: int, shift: int) -> dict[int, float]:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, for each length."""
    schema = "dim int, i int, j int, total double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in blocks(batch, scale, shift):
                w = project(x, bases[x.shape[1]])
                part = np.column_stack([w.T @ w, w.sum(0)])
                found[x.shape[1]] = found.get(x.shape[1], 0) + part
        for dim, m in found.items():
            i, j = np.indices(m.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m.size, dim), pa.int32()), pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                 pa.array(m.ravel())], schema=arrow_schema(schema),
            )
        release()

    rows = df.select("v").mapInArrow(run, schema).groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect()
    out = {}
    for dim, b in bases.items():
        k = len(b.values)
        m = np.zeros((k, k + 1))
        for r in rows:
            if r["dim"] == dim:
                m[r["i"], r["j"]] = r["total"]
        m /= b.n
        # Entries were centred before they were multiplied; what is left of their mean is taken out as well.
        out[dim] = float(np.abs(m[:, :k] - np.outer(m[:, k], m[:, k]) - np.eye(k)).max(initial=0))
    return out


RESULT = "vec_id bigint, component int, n bigint, deviation {}, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, scale: int = 1024, shift: int = 100_000, most: int = COMPONENTS) -> DataFrame:
    """A row for each vector of (vec_id, embedding) and component up to ``most``.

    An entry c counts as floor(scale * c) + shift, held to +-2^61. Vectors that are NULL or hold NULL or non-finite entries are left out,
    others have ``n`` and the exact ``deviation`` (decimal; NULL beyond 38 digits) of all vectors of their length.
    ``whitened`` is the centred vector's projection over the root of the eigenvalue, ``explained`` the eigenvalue's share of
    the trace. Components without variance (fewer vectors than dimensions, constant entries) have NULL and 0 there and
    do not enter ``identity_error``. Repeated rows and ids count each time; an empty vector has no component, so no
    row; an empty table gives an empty result. Other columns are not read.
    """
    plain = integers(df)
    bases = fit(plain, scale, shift, most)
    errors = identity_errors(plain, bases, scale, shift)
    schema = RESULT.format("decimal(38,0)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in blocks(batch, scale, shift):
                b, count = bases[x.shape[1]], min(most, x.shape[1])
                live, size = len(b.values), len(x) * count
                whitened = np.full((len(x), count), np.nan)
                whitened[:, :live] = project(x, b)
                explained = np.zeros(count)
                explained[:live] = b.values / b.trace if b.trace else 0
                exact = deviations(x, b)
                if exact.dtype == object:
                    exact = pa.array([Decimal(e) if e < 10 ** 38 else None for e in exact], pa.decimal128(38, 0))
                else:
                    exact = pa.array(exact).cast(pa.decimal128(38, 0))
                again = pa.array(np.repeat(np.arange(len(x)), count))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)).take(again),
                     pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(size, b.n, np.int64)), exact.take(again),
                     pa.array(whitened.ravel(), mask=np.isnan(whitened.ravel())),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(size, errors[x.shape[1]]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )
        release()

    return plain.withColumn("id", F.col("id").cast("bigint")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings; a deviation beyond 64 bits is NULL."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
