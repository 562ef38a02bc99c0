"""Where close pairs can be: exact blocking rules per distance.

A space names its key columns, its distance between two key rows, and two ways to spread keys over buckets
(``left`` and ``right`` add ``bucket_columns``). Every pair closer than eps shares a bucket, and ``once`` picks one bucket when it
shares several, so joining left and right buckets finds each pair exactly once and loses none.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adgrove.functions import distance as dist

A, B = "a_", "b_"


def _ordered(ordered: bool = True) -> Column:
    """Each pair in one order; else in both."""
    return F.col(A + "kid") < F.col(B + "kid") if ordered else F.lit(True)


def _added(values: Iterable[float], start: float = 0.0) -> float:
    """Sum rounded after each step, as a distance is; ``sum`` keeps more digits."""
    for v in values:
        start += v
    return start


def _up_to(chosen: int) -> int:
    """All blocks up to the last chosen one, as a bit set."""
    return (1 << chosen.bit_length()) - 1


#: Half of the bits, drawn this often, group keys that are probably close.
HINTS = 8
#: What a copy of a key costs next to a candidate, for hashes that are dealt by other parts first.
COPY_COST = 20


@dataclass(frozen=True)
class HashSpace:
    """Hash distance below ``eps`` on one non-negative integer column of ``bits`` bits.

    A pair below eps differs in fewer than eps * bits bits. The bits are cut into ``blocks`` blocks; at most
    ``slack`` of them can differ, so some choice of blocks - slack blocks agrees completely. Buckets are
    (choice, agreeing bits). More blocks mean more copies of a key but finer buckets: ``tuned`` weighs the
    two by the number of distinct hashes, because bucket sizes should not grow with the data.

    With ``reach`` only pairs that differ in at most so many bits are found: all others are at least (reach + 1) / bits apart.
    """

    eps: float
    bits: int = 62
    column: str = "hash"
    blocks: int | None = None
    reach: int | None = None

    @property
    def key_columns(self) -> tuple[str, ...]:
        return (self.column,)

    @property
    def slack(self) -> int:
        # The largest number of differing bits whose share of all bits is below eps, compared as the distance is.
        below = min(math.ceil(self.eps * self.bits), self.bits)
        while below >= 0 and below / self.bits >= self.eps:
            below -= 1
        return max(below, 0) if self.reach is None else max(min(below, self.reach), 0)

    def _block_masks(self, blocks: int) -> list[int]:
        edges = [round(i * self.bits / blocks) for i in range(blocks + 1)]
        return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]

    def tuned(self, n_keys: int, copy_cost: float = 4) -> HashSpace:
        if self.blocks is not None:
            return self
        best, best_cost = self.slack + 1, None
        for m in range(self.slack + 1, min(self.bits, self.slack + 9) + 1):
            copies = math.comb(m, self.slack)
            if copies > 1000:
                break
            width = (self.bits / m) * (m - self.slack)
            cost = copies * (copy_cost + n_keys / 2**width)
            if best_cost is None or cost < best_cost:
                best, best_cost = m, cost
        return replace(self, blocks=max(best, 1))

    def _choices(self) -> list[tuple[int, int]]:
        """(chosen blocks as a bit set, bits that must agree) per choice of blocks."""
        masks = self._block_masks(self.blocks)
        return [
            (sum(1 << j for j in chosen), sum(masks[j] for j in chosen))
            for chosen in combinations(range(self.blocks), max(self.blocks - self.slack, 0))
        ]

    def distance(self, a: str = A, b: str = B) -> Column:
        return dist.hash_distance(F.col(a + self.column), F.col(b + self.column))

    def self_distance(self) -> Column:
        return F.lit(0.0)

    bucket_columns = ("choice", "value")

    def left(self, keys: DataFrame) -> DataFrame:
        cells = F.array(*[
            F.struct(
                F.lit(chosen).alias("choice"), F.lit(_up_to(chosen)).alias("upto"),
                F.col(self.column).bitwiseAND(F.lit(agree).cast("long")).alias("value"),
            )
            for chosen, agree in self._choices()
        ])
        return keys.select("*", F.inline(cells))

    right = left

    hint_columns = ("hint", "hinted")

    def hinted(self, keys: DataFrame) -> DataFrame:
        """Keys by what they hold in some random halves of the bits; those that agree there are probably close."""
        drawn = [random.Random(k).sample(range(self.bits), self.bits // 2) for k in range(HINTS)]
        groups = F.array(*[
            F.struct(F.lit(k).alias("hint"), F.col(self.column).bitwiseAND(F.lit(sum(1 << b for b in some)).cast("long")).alias("hinted"))
            for k, some in enumerate(drawn)
        ])
        return keys.select("*", F.inline(groups))

    def once(self, ordered: bool = True) -> Column:
        """The choice holds the pair's first agreeing blocks: no other agreeing block comes before its last one.

        Short bit arithmetic: the condition stays inside generated code, and that small enough to be compiled.
        """
        x = F.col(A + self.column).bitwiseXOR(F.col(B + self.column))
        agreeing = F.lit(0)
        for j, mask in enumerate(self._block_masks(self.blocks)):
            agreeing = agreeing + F.when(x.bitwiseAND(F.lit(mask).cast("long")) == 0, F.lit(1 << j)).otherwise(F.lit(0))
        first = agreeing.bitwiseAND(F.col(A + "upto")) == F.col("choice")
        # Counting bits is cheaper than the distance and already rules most candidates out.
        return _ordered(ordered) & (F.bit_count(x) <= self.slack) & first

    # Second level, for hot buckets only: their keys agree on the chosen bits, so the differing bits of a pair
    # all lie in the rest. The rest is cut into blocks of its own and the same argument applies again.

    refines = True
    refined_columns = ("at", "sub", "subvalue")

    def _rest_blocks(self) -> tuple[list[list[int]], list[tuple[int, ...]]]:
        """Blocks of the remaining bits per choice, and the sub-choices of blocks that must agree."""
        rests = [[b for b in range(self.bits) if not agree >> b & 1] for _, agree in self._choices()]
        n = min(min(map(len, rests)), self.slack + 3)
        while math.comb(n, self.slack) > 60 and n > self.slack + 1:
            n -= 1
        blocks = []
        for rest in rests:
            edges = [round(i * len(rest) / n) for i in range(n + 1)] if n else []
            blocks.append([sum(1 << b for b in rest[lo:hi]) for lo, hi in zip(edges, edges[1:])])
        return blocks, list(combinations(range(n), max(n - self.slack, 0)))

    @staticmethod
    def _table(rows: list[list[int]]) -> Column:
        # As text: thousands of literals would be as many calls of the driver.
        return F.expr(f"array({', '.join('array(' + ', '.join(f'{v}L' for v in row) + ')' for row in rows)})").cast("array<array<bigint>>")

    def refine(self, rows: DataFrame) -> DataFrame:
        """Rows of hot buckets spread over sub-buckets."""
        blocks, subs = self._rest_blocks()
        masks = self._table([[sum(b[j] for j in sub) for sub in subs] for b in blocks])
        choices = F.array(*[F.lit(chosen) for chosen, _ in self._choices()])
        at = (F.array_position(choices, F.col("choice")) - 1).cast("int")
        located = rows.withColumn("at", at)
        values = F.transform(F.get(masks, F.col("at")), lambda m: F.col(self.column).bitwiseAND(m))
        return located.select("*", F.posexplode(values).alias("sub", "subvalue"))

    def refined_once(self) -> Column:
        """The first agreeing sub-choice, by the rule of :meth:`once`."""
        blocks, subs = self._rest_blocks()
        x = F.col(A + self.column).bitwiseXOR(F.col(B + self.column))
        own = F.get(self._table(blocks), F.col("at"))
        agreeing = F.lit(0)
        for j in range(len(blocks[0])):
            agreeing = agreeing + F.when(x.bitwiseAND(F.get(own, F.lit(j))) == 0, F.lit(1 << j)).otherwise(F.lit(0))
        chosen = [sum(1 << j for j in sub) for sub in subs]
        pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("sub"))
        return agreeing.bitwiseAND(pick([_up_to(c) for c in chosen])) == pick(chosen)


@dataclass(frozen=True)
class VectorSpace:
    """Euclidean distance below ``eps`` on an array column of ``dim`` integers or doubles.

    Vectors are compared as matrix products of blocks (``operators/vectors.py``), cell by cell around pivots.
    ``scale`` divides the distance, for the scaled variants.
    """

    eps: float
    dim: int
    column: str = "vector"
    scale: float = 1.0

    @property
    def key_columns(self) -> tuple[str, ...]:
        return (self.column,)

    def distance(self, a: str = A, b: str = B) -> Column:
        # Written out per dimension: plain arithmetic stays inside generated code, array lambdas do not.
        total = F.lit(0)
        for i in range(self.dim):
            gap = F.col(a + self.column)[i] - F.col(b + self.column)[i]
            total = total + gap * gap
        return F.sqrt(total.cast("double")) / self.scale

    def self_distance(self) -> Column:
        return F.lit(0.0)


@dataclass(frozen=True)
class MixedSpace:
    """Weighted mix of hash, URL, user, company and city distances.

    ``clamp`` is the clamped mix that always uses the hash; without it only parts with a non-zero weight
    count, and the hash only when ``use_hash``. Three exact blocking rules apply, the first that can:

    * a part whose mismatch alone lifts the distance to eps must agree (users, companies). An unknown user ("0")
      matches every user, so this needs ``known_users``. Where the hash counts too, the next rule applies inside;
    * the hash must be below eps minus the most the other parts can subtract;
    * the parts of one of several sets must all agree (:class:`PartRule`): URLs by host and path, cities by a common one,
      users and companies by name, unknown ones with everybody.

    Weights for which none holds are refused: they leave every pair a candidate.

    An unknown user is at distance 0 from every user. With ``one_sided`` only the way from the unknown user is: the
    way to it is FAR, so the two directions of a pair differ. A pair is then looked for by the shorter one.
    """

    eps: float
    url_weight: float = 0
    user_weight: float = 0
    company_weight: float = 0
    city_weight: float = 0
    near: float = 0
    far: float = 1
    url_threshold: int = 2
    clamp: bool = False
    use_hash: bool = False
    known_users: bool = False
    one_sided: bool = False
    bits: int = 62
    blocks: int | None = None
    frequent: tuple[str, ...] = ()
    columns: dict = field(default_factory=lambda: {
        "hash": "hash", "url": "url", "user": "uname", "company": "coname", "city": "city",
    })

    def _parts(self) -> dict[str, float]:
        weights = {"url": self.url_weight, "user": self.user_weight, "company": self.company_weight, "city": self.city_weight}
        return {n: w for n, w in weights.items() if w != 0}

    def _lows(self) -> dict[str, float]:
        """Least value each weighted part can take."""
        def low(name: str, w: float) -> float:
            values = (0.0, 1.0) if name == "city" else (0.0, self.near, self.far)
            return min(w * v for v in values)
        return {n: low(n, w) for n, w in self._parts().items()}

    @property
    def _hashed(self) -> bool:
        return self.clamp or self.use_hash

    @property
    def key_columns(self) -> tuple[str, ...]:
        names = [*(["hash"] if self._hashed else []), *self._parts()]
        if not names:
            raise ValueError("every part of the mix has weight zero")
        return tuple(dict.fromkeys(self.columns[n] for n in names))

    def _must_agree(self) -> list[str]:
        lows = self._lows()
        out = []
        for name in ("user", "company"):
            if name not in lows or (name == "user" and not self.known_users):
                continue
            if _added(w * self.far if n == name else lows[n] for n, w in self._parts().items()) >= self.eps:
                out.append(name)
        return out

    def _hash_space(self) -> HashSpace | None:
        if not self._hashed:
            return None
        # Added up in the order of the distance, so that both round alike.
        close = [k for k in range(self.bits + 1) if _added(self._lows().values(), k / self.bits) < self.eps]
        reach = (max(close, default=0) + 0.5) / self.bits
        space = HashSpace(reach, self.bits, self.columns["hash"], self.blocks)
        return space if space.slack < self.bits else None

    def tuned(self, n_keys: int) -> MixedSpace:
        hashes = self._hash_space()
        if hashes is None:
            return self
        blocks = (hashes.tuned(n_keys, COPY_COST) if self._must_agree() else hashes.tuned(n_keys)).blocks
        return MixedSpace(**{**self.__dict__, "blocks": blocks})

    def distance(self, a: str = A, b: str = B) -> Column:
        there, back = self.directed(a, b), self.directed(b, a)
        return F.least(there, back) if self.one_sided else there

    def directed(self, a: str, b: str) -> Column:
        """The way from ``a`` to ``b``."""
        def col(side: str, name: str) -> Column:
            return F.col(side + self.columns[name])

        def term(name: str) -> Column:
            x, y = col(a, name), col(b, name)
            if name == "url":
                return dist.url_similarity(x, y, self.near, self.far, self.url_threshold)
            if name == "user":
                return dist.user_distance(x, y, self.near, self.far, symmetric=not self.one_sided)
            return dist.company_distance(x, y, self.near, self.far) if name == "company" else dist.city_distance(x, y)

        total = dist.hash_distance(col(a, "hash"), col(b, "hash")) if self._hashed else F.lit(0.0)
        for name, weight in self._parts().items():
            total = total + float(weight) * term(name)
        return F.greatest(total, F.lit(0.0)) if self.clamp else total

    def self_distance(self) -> Column:
        return self.distance("", "")

    # Third rule: parts that agree.

    def _rule(self) -> PartRule | None:
        """The rule of agreeing parts, where neither of the others holds."""
        if self._must_agree() or self._hash_space() is not None:
            return None
        rule = PartRule(self)
        if not rule.sets:
            raise ValueError("these weights and eps leave no part that close ads must share")
        return rule

    def disagreement(self) -> dict[str, float]:
        """What a part adds when it disagrees: names and URLs FAR apart, cities without a common one."""
        return {n: w * (1.0 if n == "city" else self.far) for n, w in self._parts().items()}

    def agreement(self) -> dict[str, float]:
        """The least that a part can add otherwise."""
        least = {"url": (0.0, self.near), "user": (0.0, self.near), "company": (self.near,), "city": (0.0, 1.0)}
        if self.one_sided:
            least["user"] += (self.far,)  # what the way to an unknown user adds, who stands in every bucket
        return {n: min(w * v for v in least[n]) for n, w in self._parts().items()}

    def fitted(self, keys: DataFrame) -> MixedSpace:
        """The same with the most frequent cities of ``keys``, a bounded list: they come last where cities are chosen."""
        rule = self._rule()
        if rule is None or not any("city" in s for s in rule.sets):
            return self
        each = keys.select(F.explode(F.array_distinct(F.split(self.columns["city"], ","))).alias("city"))
        top = each.groupBy("city").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "city").limit(FREQUENT)
        return MixedSpace(**{**self.__dict__, "frequent": tuple(r["city"] for r in top.collect())})

    @property
    def bucket_columns(self) -> tuple[str, ...]:
        same = tuple(f"same_{n}" for n in self._must_agree())
        if self._hash_space() is not None:
            return same + HashSpace.bucket_columns
        return same or PartRule.bucket_columns

    @property
    def refines(self) -> bool:
        return self._hash_space() is not None

    @property
    def hint_columns(self) -> tuple[str, ...]:
        return tuple(f"same_{n}" for n in self._must_agree()) + HashSpace.hint_columns

    def hinted(self, keys: DataFrame) -> DataFrame:
        return self._hash_space().hinted(self._same(keys))

    def agreeing(self) -> list[str]:
        """Key columns that must be equal."""
        return [self.columns[n] for n in self._must_agree()]

    def _same(self, keys: DataFrame) -> DataFrame:
        return keys.select("*", *[F.col(self.columns[n]).alias(f"same_{n}") for n in self._must_agree()])

    refined_columns = HashSpace.refined_columns

    def refine(self, rows: DataFrame) -> DataFrame:
        return self._hash_space().refine(rows)

    def refined_once(self) -> Column:
        return self._hash_space().refined_once()

    def left(self, keys: DataFrame) -> DataFrame:
        return self._bucketed(keys, "left")

    def right(self, keys: DataFrame) -> DataFrame:
        return self._bucketed(keys, "right")

    def _bucketed(self, keys: DataFrame, side: str) -> DataFrame:
        rule, hashes = self._rule(), self._hash_space()
        if rule:
            return rule.bucketed(keys, side)
        return hashes.left(self._same(keys)) if hashes else self._same(keys)

    def once(self, ordered: bool = True) -> Column:
        rule, hashes = self._rule(), self._hash_space()
        if rule:
            return rule.once(ordered)
        return hashes.once(ordered) if hashes else _ordered(ordered)


#: Cities that are known to be frequent, and groups over which the partners of an unknown value are dealt.
FREQUENT, WILD = 1000, 64


class PartRule:
    """Blocking by parts that agree, for a mix whose close pairs can't disagree in all of them.

    A set of parts can disagree together only if the distance stays below eps with all other parts at their least. Every close
    pair disagrees inside one of the largest such sets, so all parts outside it agree: these are the ``sets`` to block by.
    A part is turned into tokens for the left and the right row so that agreeing values have a common one:

    * company, user: the name;
    * URL: host and path piece by place. Fewer than ``threshold`` pieces differ, so of the first ``threshold`` places one
      agrees. A URL with fewer pieces meets its whole host, as does one of a host that many advertisers share;
    * city: the cities at the front of an order of rising frequency, as many as a pair that is similar enough can't do without.

    An unknown value (user "0", URL without host, no city) agrees with all: it meets everybody, dealt over ``WILD`` groups.
    A pair counts in the first set it agrees in and at the first common token of each part.
    """

    bucket_columns = ("rule", "value")

    def __init__(self, space: MixedSpace):
        self.space = space
        apart, near = space.disagreement(), space.agreement()
        names = list(apart)
        possible = [
            frozenset(f) for n in range(len(names) + 1) for f in combinations(names, n)
            if _added(apart[p] if p in f else near[p] for p in names) < space.eps
        ]
        largest = [f for f in possible if not any(f < g for g in possible)]
        # No largest set at all: no pair is close, and any single part will do.
        agree = [tuple(n for n in names if n not in f) for f in largest] or [tuple(names[:1])]
        self.sets = [] if () in agree else agree
        self.parts = [n for n in names if any(n in s for s in self.sets)]

    def _wild(self, known: Column, own: list, side: str) -> Column:
        """Tokens ``own`` of a known value; unknown ones stand in all groups of the other side's rows."""
        everywhere, here = ("*1/", "*2/") if side == "left" else ("*2/", "*1/")
        group = F.concat(F.lit(here), F.pmod(F.xxhash64("kid"), F.lit(WILD)).cast("string"))
        every = F.array(*[F.lit(f"{everywhere}{k}") for k in range(WILD)])
        return F.concat(F.when(known, F.concat(*own)).otherwise(every), F.array(group))

    def _tokens(self, name: str, side: str) -> Column:
        s = self.space
        value = F.col(s.columns[name])
        text = F.array(F.concat(F.lit("="), value))
        if name == "company" or (name == "user" and s.known_users):
            return text
        if name == "user":
            return self._wild(value != "0", [text], side)
        if name == "city":
            return self._wild(value != "", [self._cities(value)], side)
        parts, least = dist.url_parts(value), max(1, s.url_threshold)
        host = F.get(parts, F.lit(0))
        shared, short = host.isin(*dist.STOP_HOSTS), F.size(parts) <= least
        none = F.array().cast("array<string>")
        whole, meets = ("s1:", "s2:") if side == "left" else ("s2:", "s1:")
        pieces = F.array(*[F.concat(F.lit(f"p{k}:"), host, F.lit("/"), F.get(parts, F.lit(k))) for k in range(1, least + 1)])
        own = (
            F.when(shared, F.array(F.concat(F.lit("h:"), host)))
            .otherwise(F.concat(
                F.array(F.concat(F.lit(meets), host)), F.when(short, F.array(F.concat(F.lit(whole), host))).otherwise(pieces)
            ))
        )
        return self._wild(F.size(parts) > 0, [F.coalesce(own, none)], side)

    def _cities(self, value: Column) -> Column:
        s = self.space
        cities = F.array_distinct(F.split(value, ","))
        frequent = F.array(*[F.lit(c) for c in s.frequent]).cast("array<string>")
        # Unlisted cities first, by name; then the listed ones, the most frequent last.
        order = F.array_sort(F.transform(cities, lambda c: F.struct(
            F.when(F.array_contains(frequent, c), -F.array_position(frequent, c)).otherwise(F.lit(-FREQUENT - 1)).alias("at"), c.alias("c")
        )))
        weight, rest = s.city_weight, sum(v for n, v in s.agreement().items() if n != "city")
        similar = max(0.0, 1 - (s.eps - rest) / weight) if weight > 0 else 0.0
        common = F.greatest(F.lit(1), F.ceil(F.size(cities) * similar - 1e-9)).cast("int")
        return F.transform(F.slice(order, 1, F.size(cities) - common + 1), lambda x: F.concat(F.lit("="), x["c"]))

    def bucketed(self, keys: DataFrame, side: str) -> DataFrame:
        """Keys in the buckets of every set: ``value`` has a token of each of its parts."""
        rows = keys.select("*", *[self._tokens(n, side).alias(f"tokens_{n}") for n in self.parts])
        out = None
        for k, names in enumerate(self.sets):
            some = rows.withColumn("rule", F.lit(k))
            values = F.array(F.lit(""))
            for n in names:
                values = self._joined(values, F.col(f"tokens_{n}"))
            some = some.withColumn("value", F.explode(values))
            out = some if out is None else out.unionByName(some)
        return out

    @staticmethod
    def _joined(values: Column, tokens: Column) -> Column:
        """Every value with every token behind it; the token's length keeps different ones apart."""
        def one(v: Column) -> Column:
            return F.transform(tokens, lambda t: F.concat(v, F.length(t).cast("string"), F.lit(":"), t))

        return F.flatten(F.transform(values, one))

    def once(self, ordered: bool = True) -> Column:
        first = {
            n: F.array_min(F.array_intersect(F.col(f"{A}tokens_{n}"), F.col(f"{B}tokens_{n}"))) for n in self.parts
        }
        earlier, chosen = F.lit(False), F.lit(False)
        for k, names in enumerate(self.sets):
            value = F.concat(*[x for n in names for x in (F.length(first[n]).cast("string"), F.lit(":"), first[n])])
            chosen = chosen | ((F.col("rule") == k) & ~earlier & (F.col("value") == value))
            agrees = F.lit(True)
            for n in names:
                agrees = agrees & first[n].isNotNull()
            earlier = earlier | agrees
        return _ordered(ordered) & F.coalesce(chosen, F.lit(False))


Space = HashSpace | VectorSpace | MixedSpace
