"""Distances between two creatives as column expressions. ``a`` and ``b`` are columns of the two sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Landing hosts shared by many advertisers, which say nothing about similarity.
STOP_HOSTS = (
    "h5.gdt.qq.com",
    "m.dianping.com",
    "mp.weixin.qq.com",
    "lp.pinduoduo.com",
    "link.yiche.com",
    "dmp-data.vip.com",
    "aduland.dianping.com",
)


def hash_distance(a: Column, b: Column) -> Column:
    """Differing bits over the bit length of the XOR itself: equal hashes 0, XOR 1 gives 1, XOR 2 gives 0.5."""
    x = a.bitwiseXOR(b)
    return F.bit_count(x) / F.length(F.bin(x))


def url_parts(url: Column) -> Column:
    """Host and path pieces; empty for text without ``//host``."""
    pieces = F.split(url, "/")
    return F.slice(pieces, 3, F.greatest(F.size(pieces) - 2, F.lit(0)))


def url_prefix_distance(a: Column, b: Column, scale: int = 2, shared: Sequence[str] = STOP_HOSTS) -> Column:
    """1 - scale * common prefix / shorter length; unusable or shared hosts give 0 (scale 2) or 1."""
    pa, pb = url_parts(a), url_parts(b)
    shorter = F.least(F.size(pa), F.size(pb))
    equal = F.zip_with(F.slice(pa, 1, shorter), F.slice(pb, 1, shorter), lambda x, y: x == y)
    first_gap = F.array_position(equal, F.lit(False))
    prefix = F.when(first_gap == 0, shorter).otherwise(first_gap - 1)
    unusable = (shorter == 0) | F.get(pa, F.lit(0)).isin(*shared) | F.get(pb, F.lit(0)).isin(*shared)
    return F.when(unusable, F.lit(0.0 if scale == 2 else 1.0)).otherwise(1 - scale * (prefix / F.nullif(shorter, F.lit(0))))


def url_similarity(
    a: Column, b: Column, near: float = 0, far: float = 1, threshold: int = 2, shared: Sequence[str] = STOP_HOSTS
) -> Column:
    """NEAR for equal URLs or few differing pieces, FAR for other hosts or ``threshold`` differing pieces, else 0."""
    pa, pb = url_parts(a), url_parts(b)
    shorter = F.least(F.size(pa), F.size(pb))
    differing = F.size(
        F.filter(F.zip_with(F.slice(pa, 1, shorter), F.slice(pb, 1, shorter), lambda x, y: x != y), lambda t: t)
    )
    near, far, none = (F.lit(float(v)) for v in (near, far, 0))
    return (
        F.when(a == b, near)
        .when(shorter == 0, none)
        .when(F.get(pa, F.lit(0)) != F.get(pb, F.lit(0)), far)
        .when(F.get(pa, F.lit(0)).isin(*shared), none)
        .when((differing >= threshold) & (differing > 0), far)
        .otherwise(near)
    )


def user_distance(a: Column, b: Column, near: float = 0, far: float = 1, symmetric: bool = False) -> Column:
    """0 when the left user is unknown ("0"), else NEAR for the same user and FAR for another.

    ``symmetric`` also treats an unknown right user as 0, which set-level operators need.
    """
    unknown = a == "0"
    if symmetric:
        unknown = unknown | (b == "0")
    return F.when(unknown, 0.0).when(a == b, float(near)).otherwise(float(far))


def company_distance(a: Column, b: Column, near: float = 0, far: float = 1) -> Column:
    return F.when(a == b, float(near)).otherwise(float(far))


def city_distance(a: Column, b: Column) -> Column:
    """Jaccard distance of two comma-separated city sets; 0 when either is empty."""
    x, y = F.split(a, ","), F.split(b, ",")
    jaccard = F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
    return F.when(F.coalesce(a, F.lit("")).eqNullSafe("") | F.coalesce(b, F.lit("")).eqNullSafe(""), 0.0).otherwise(1 - jaccard)


def _fold(a: Column, b: Column, term) -> Column:
    return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda acc, x: acc + x)


def l1(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: F.abs(x - y).cast("double"))


def l1_twelfth(a: Column, b: Column) -> Column:
    return l1(a, b) / 12


def l1_mean(a: Column, b: Column) -> Column:
    return l1(a, b) / F.nullif(F.size(a), F.lit(0))


def squared_l2(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: ((x - y) * (x - y)).cast("double"))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(squared_l2(a, b))


def l2_scaled(a: Column, b: Column) -> Column:
    return l2(a, b) / 128


def l2_mean_square(a: Column, b: Column) -> Column:
    return squared_l2(a, b) / F.nullif(F.size(a), F.lit(0))


def _norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_relative(a: Column, b: Column) -> Column:
    return 2 * l2(a, b) / F.nullif(_norm(a) + _norm(b), F.lit(0.0))


def cosine_distance(a: Column, b: Column) -> Column:
    dot = _fold(a, b, lambda x, y: (x * y).cast("double"))
    return 1 - dot / F.nullif(_norm(a) * _norm(b), F.lit(0.0))


def sign_agreement(a: Column, b: Column) -> Column:
    """Share of dimensions with the same sign; a similarity, not a distance."""
    return _fold(a, b, lambda x, y: F.when(x * y >= 0, 1.0).otherwise(0.0)) / F.nullif(F.size(a), F.lit(0))
