"""Distinct keys and their close pairs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adgrove.operators.scratch import Scratch
from adgrove.operators.spaces import A, B, MixedSpace, Space, VectorSpace
from adgrove.operators.vectors import VectorSearch, prepare_vectors

BUCKET_LIMIT = 4096
#: Keys that meet as hints in one group, and keys for each share of a group.
TILE, SHARE = 32, 1 << 18


def distinct_keys(points: DataFrame, space: Space, part: Sequence[str] = ()) -> DataFrame:
    """One row per (part, key) with ``kid`` = smallest index and ``weight`` = number of points.

    Equal keys behave alike in every set-level operator, so copies (however many) meet once, here, with
    partial aggregation, and never as pairs.
    """
    keys = points.groupBy(*part, *space.key_columns).agg(F.min("idx").alias("kid"), F.count(F.lit(1)).alias("weight"))
    return spread_keys(keys)


def spread_keys(keys: DataFrame) -> DataFrame:
    """Keys over all cores, however small their table is: pair work grows faster than bytes."""
    return keys.repartition(keys.sparkSession.sparkContext.defaultParallelism, "kid")


@dataclass(frozen=True)
class PairSearch:
    """Close pairs of one key table. Prepared once, then run over any table with the same keys.

    ``hot`` lists the buckets with more than the limit of keys on a side. Where the space can, their keys are
    spread over sub-buckets by the bits the bucket leaves open. Buckets that stay large (``cuts``) are cut into
    chunks and every left chunk meets every right chunk in a join group of its own. Either way a hot bucket
    becomes many bounded groups and stays complete.
    """

    space: Space
    part: tuple[str, ...]
    hot: DataFrame | None
    cuts: DataFrame | None
    n_keys: int = 0

    @property
    def on(self) -> list[str]:
        return [*self.part, *self.space.bucket_columns]

    def slim(self, keys: DataFrame, carry: Sequence[str]) -> DataFrame:
        return keys.select(*dict.fromkeys([*self.part, "kid", *self.space.key_columns, *carry]))

    def neighbours(self, keys: DataFrame, carry: Sequence[str], looking: str) -> DataFrame:
        """Pairs below eps from each key ``a`` with the condition ``looking`` to every other key ``b``, in that direction."""
        slim = self.slim(keys, carry)
        return self.meet(self.space.left(slim.where(looking)), self.space.right(slim), carry, ordered=False)

    def hints(self, keys: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """Some of the close pairs, in both directions, for little work: keys that agree in half of their bits meet in
        groups of at most ``TILE``. A pair may come once for each ``hint``; of a one-sided space only the near ways."""
        rows = self.space.hinted(self.slim(keys, carry))
        on = [*self.part, *self.space.hint_columns]
        share = F.pmod(F.xxhash64("kid"), F.lit(max(1, self.n_keys // SHARE))).alias("share")
        fields = list(dict.fromkeys(["kid", *self.space.key_columns, *carry]))
        order = F.row_number().over(Window.partitionBy(*on, "share").orderBy("kid"))
        tiles = (
            rows.select("*", share).withColumn("tile", F.floor((order - 1) / TILE)).groupBy(*on, "share", "tile")
            .agg(F.collect_list(F.struct(*fields)).alias("members")).where(F.size("members") > 1)
        )
        each = tiles.select("hint", "members", F.explode("members").alias("x")).select("hint", "x", F.explode("members").alias("y"))
        flat = each.select("hint", *[F.col(f"{v}.{c}").alias(s + c) for c in fields for v, s in (("x", A), ("y", B))])
        way = self.space.directed(A, B) if getattr(self.space, "one_sided", False) else self.space.distance()
        return flat.where((F.col(A + "kid") != F.col(B + "kid")) & (way < self.space.eps)).select(
            "hint", F.col(A + "kid").alias("a"), F.col(B + "kid").alias("b"),
            *[F.col(s + c).alias(f"{c}_{n}") for c in carry for s, n in ((A, "a"), (B, "b"))],
        )

    def close_pairs(self, keys: DataFrame, carry: Sequence[str] = (), larger: str | None = None) -> DataFrame:
        """Unordered pairs of distinct keys below eps: a, b (kids), d, and ``carry`` columns of both sides.

        One-sided spaces add the ways ``d_ab`` and ``d_ba``; at least one of them is below eps.

        The distance and the once-only rule are part of the join condition: candidates are never materialised.
        ``larger`` is a condition on the key with the larger kid; other keys are not even put into right buckets.
        """
        space, slim = self.space, self.slim(keys, carry)
        return self.meet(space.left(slim), space.right(slim if larger is None else slim.where(larger)), carry)

    def meet(self, left: DataFrame, right: DataFrame, carry: Sequence[str] = (), ordered: bool = True) -> DataFrame:
        """The same for two sides that are in their buckets already; without ``ordered`` from every left key to every right one."""
        space, on, once = self.space, self.on, self.space.once(ordered)
        if self.hot is None:
            return self._meet(left, right, on, once, carry)
        if not space.refines:
            return self._meet(left, right, on, once, carry, self.cuts)
        cold = self._meet(left.join(self.hot, on, "left_anti"), right.join(self.hot, on, "left_anti"), on, once, carry)
        fine = self._meet(
            space.refine(left.join(self.hot, on, "left_semi")), space.refine(right.join(self.hot, on, "left_semi")),
            [*on, *space.refined_columns], once & space.refined_once(), carry, self.cuts,
        )
        return cold.unionByName(fine)

    def _meet(
        self, left: DataFrame, right: DataFrame, on: list[str], once: Column, carry: Sequence[str], cuts: DataFrame | None = None
    ) -> DataFrame:
        if cuts is not None:
            left = chunked(left, cuts, on, "cut_left", "cut_right", ("x", "y"))
            right = chunked(right, cuts, on, "cut_right", "cut_left", ("y", "x"))
            on = [*on, "x", "y"]
        left = left.select(*on, *[F.col(c).alias(A + c) for c in left.columns if c not in on])
        right = right.select(*on, *[F.col(c).alias(B + c) for c in right.columns if c not in on])
        # Sort-merge, never broadcast: size estimates do not see how many copies the buckets make of a key.
        met = left.join(right.hint("merge"), on).where(F.col(A + "kid") != F.col(B + "kid")).withColumn("d", self.space.distance())
        ways = []
        if getattr(self.space, "one_sided", False):
            ways = [self.space.directed(A, B).alias("d_ab"), self.space.directed(B, A).alias("d_ba")]
        return met.where(once & (F.col("d") < self.space.eps)).select(
            F.col(A + "kid").alias("a"), F.col(B + "kid").alias("b"), "d", *ways,
            *[F.col(s + c).alias(f"{c}_{n}") for c in carry for s, n in ((A, "a"), (B, "b"))],
        )


def prepare_pairs(
    keys: DataFrame, n_keys: int, space: Space, scratch: Scratch, part: Sequence[str] = (), bucket_limit: int = BUCKET_LIMIT
) -> PairSearch | VectorSearch:
    """Tunes the blocking to the number of keys and finds hot buckets, from counts per bucket."""
    if isinstance(space, VectorSpace):
        return prepare_vectors(keys, n_keys, space, scratch, part)
    meet = n_keys
    if isinstance(space, MixedSpace) and space.agreeing():
        # Only keys that agree meet at all.
        groups = keys.groupBy(*dict.fromkeys([*part, *space.agreeing()])).agg(F.count(F.lit(1)).alias("n"))
        meet = groups.agg(F.max("n")).first()[0] or 0
    space = space.tuned(meet)
    if isinstance(space, MixedSpace):
        space = space.fitted(keys)
    slim = keys.select(*dict.fromkeys([*part, "kid", *space.key_columns]))
    return replace(meeting(space.left(slim), space.right(slim), space, part, scratch, bucket_limit), n_keys=n_keys)


def meeting(
    left: DataFrame, right: DataFrame, space: Space, part: Sequence[str], scratch: Scratch, bucket_limit: int = BUCKET_LIMIT
) -> PairSearch:
    """Search over two sides that are in their buckets already: which of those are hot."""
    on = [*part, *space.bucket_columns]
    hot = oversized(left, right, on, bucket_limit, scratch)
    if hot is None or not space.refines:
        return PairSearch(space, tuple(part), hot, hot)
    hot = hot.select(*on)
    cuts = oversized(
        space.refine(left.join(hot, on, "left_semi")), space.refine(right.join(hot, on, "left_semi")),
        [*on, *space.refined_columns], bucket_limit, scratch,
    )
    return PairSearch(space, tuple(part), hot, cuts)


def oversized(
    left: DataFrame, right: DataFrame, on: list[str], limit: int, scratch: Scratch, most: int | None = None, held: int = 0
) -> DataFrame | None:
    """Buckets above the limit with the number of chunks per side; None when there is none.

    With ``most`` a side has no more chunks than that, unless chunks then held more than ``held`` rows.
    """
    sizes = (
        left.groupBy(*on).agg(F.count(F.lit(1)).alias("n_left"))
        .join(right.groupBy(*on).agg(F.count(F.lit(1)).alias("n_right")), on)
    )

    def chunks(n: str) -> Column:
        each = F.ceil(F.col(n) / limit)
        return (each if most is None else F.greatest(F.least(each, F.lit(most)), F.ceil(F.col(n) / held))).cast("int")

    found, seen = scratch.cut(
        sizes.where((F.col("n_left") > limit) | (F.col("n_right") > limit))
        .select(*on, chunks("n_left").alias("cut_left"), chunks("n_right").alias("cut_right")),
        rows=F.count(F.lit(1)),
    )
    return found if seen["rows"] else None


def chunked(side: DataFrame, hot: DataFrame, on: list[str], own: str, other: str, axes: tuple[str, str]) -> DataFrame:
    """Row's own chunk on one axis, a copy for every chunk of the other side on the other axis."""
    mine, theirs = axes
    return (
        side.join(hot, on, "left")
        .withColumn(mine, F.pmod(F.xxhash64("kid"), F.coalesce(F.col(own), F.lit(1))).cast("int"))
        .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)))
        .drop(own, other)
    )


def degrees(pairs: DataFrame) -> DataFrame:
    """(kid, others): summed weight of the close keys of each key. ``pairs`` carries ``weight``."""
    sides = F.array(
        F.struct(F.col("a").alias("kid"), F.col("weight_b").alias("w")),
        F.struct(F.col("b").alias("kid"), F.col("weight_a").alias("w")),
    )
    return pairs.select(F.explode(sides).alias("s")).groupBy("s.kid").agg(F.sum("s.w").alias("others"))
