"""Benchmark passages in documents, by greedy string tiling.

Documents and benchmark items are sequences of tokens: runs of letters and digits in lower case. A join on hashes
of ``MATCH`` consecutive tokens finds the pairs that share any; the tokens of an item that shared seeds cover bound what
tiles can cover, so most pairs end there. The others are tiled: common runs of unmarked tokens are found by
Karp-Rabin hashes of shrinking length, the longest are marked first, and what a mark leaves of a run is taken up again.
The share of an item's tokens under tiles does not depend on their order in the document, so passages that were
cut up and rearranged count in full.

The benchmark is a stated query set: it meets all documents in blocks of bounded size, one pass of the documents each.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, map_arrow, map_rows, table
from adgrove.llm.words import Hasher, inside, letter_table, lower_text, split_words, steps, text_bytes

#: Fewest tokens of a tile; an item with fewer tokens is matched as a whole.
MATCH = 5
#: Share of an item's tokens under tiles from which a document counts as contaminated by it.
COVERAGE = 0.5
#: Tokens of benchmark items that meet the documents at once.
BLOCK = 1 << 20
#: Length at which tiling starts to search.
SEARCH = 32


class Tokens:
    """Token hashes of texts in lower case."""

    def __init__(self):
        self.hasher, self.letters = Hasher(41), letter_table()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = split_words(data, offsets, self.letters)
        return self.hasher.words(w), w.first


def common_runs(
    doc: np.ndarray, item: np.ndarray, doc_free: np.ndarray, item_free: np.ndarray, length: int, hasher: Hasher
) -> list[tuple[int, int, int]]:
    """(length, doc start, item start) of all maximal common runs of free tokens with at least ``length`` tokens."""

    def windows(tokens: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(tokens) < length:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        taken = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(taken[length:] == taken[:-length])
        return at, hasher.windows(tokens, length)[at]

    (i, hi), (j, hj) = windows(doc, doc_free), windows(item, item_free)
    order = np.argsort(hj, kind="stable")
    low, high = np.searchsorted(hj[order], hi, "left"), np.searchsorted(hj[order], hi, "right")
    n = high - low
    if not n.sum():
        return []
    place = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    i, j = np.repeat(i, n), j[order[place]]
    by_diagonal = np.lexsort((i, i - j))
    i, j = i[by_diagonal], j[by_diagonal]
    new = np.ones(len(i), bool)
    new[1:] = (np.diff(i - j) != 0) | (np.diff(i) != 1)
    starts = np.flatnonzero(new)
    lengths = np.diff(np.concatenate([starts, [len(i)]])) + length - 1
    return list(zip(lengths.tolist(), i[starts].tolist(), j[starts].tolist()))


def tile(doc: np.ndarray, item: np.ndarray, least: int, hasher: Hasher) -> list[tuple[int, int, int]]:
    """Tiles (doc start, item start, length) of two token sequences, longest first; no token is in two of them."""
    doc_free, item_free = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles, length = [], max(least, min(SEARCH, len(item)))
    while True:
        runs = common_runs(doc, item, doc_free, item_free, length, hasher)
        longest = max((r[0] for r in runs), default=0)
        if longest > 2 * length:
            length = longest
            continue
        queue = [(-n, j, i) for n, i, j in runs]
        heapq.heapify(queue)
        while queue:
            n, j, i = heapq.heappop(queue)
            free = doc_free[i: i - n] & item_free[j: j - n]
            if free.all():
                doc_free[i: i - n] = item_free[j: j - n] = False
                tiles.append((i, j, -n))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if b - a >= length:
                    heapq.heappush(queue, (a - b, j + a, i + a))
        if length <= least or not item_free.any():
            return tiles
        length = max(least, length // 2)


class Block(NamedTuple):
    """Benchmark items: ids, token hashes cut by ``first``, and their seeds sorted by hash."""

    ids: np.ndarray
    first: np.ndarray
    tokens: np.ndarray
    seeds: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    sizes: list[int]


def block_of(items: list[tuple[int, str]], match: int) -> Block:
    tokens = Tokens()
    data, at = text_bytes(lower_text(pa.array([t for _, t in items], pa.string())))
    h, first = tokens(data, at)
    count = np.diff(first)
    # An item with fewer tokens than a seed has one seed of its own length.
    own = np.minimum(count, match)
    seeds, owner, place, sizes = [], [], [], sorted({int(n) for n in own if n})
    for n in sizes:
        starts = inside(first, n)
        row = np.searchsorted(first, starts, "right") - 1
        starts, row = starts[own[row] == n], row[own[row] == n]
        seeds.append(tokens.hasher.windows(h, n)[starts])
        owner.append(row)
        place.append(starts - first[row])
    flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (seeds, owner, place)]
    order = np.argsort(flat[0], kind="stable")
    ids = np.array([i for i, _ in items], np.int64)
    return Block(ids, first, h, flat[0][order].astype(np.uint64), flat[1][order], flat[2][order], sizes)


def blocks(benchmark: DataFrame, match: int, limit: int = BLOCK) -> Iterator[Block]:
    """The items in blocks of about ``limit`` characters at least; items without id or text are left out."""
    held, size = [], 0
    rows = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    for row in rows.toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= limit:
            yield block_of(held, match)
            held, size = [], 0
    if held:
        yield block_of(held, match)


PAIRS = "doc_id bigint, item_id bigint, n_tokens int, n_covered int, coverage double, tiles array<int>"


class Matcher:
    """Finds the items of a block that texts contain."""

    def __init__(self, block: Block, match: int, least: float):
        self.block, self.match, self.least = block, match, least
        self.tokens = Tokens()
        self.count = np.diff(block.first)
        self.distinct = np.unique(block.seeds)

    def candidates(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(row, item, places in h under seeds of the item) of the pairs that seeds do not rule out."""
        block, found = self.block, []
        for n in block.sizes:
            at = inside(first, n)
            seed = self.tokens.hasher.windows(h, n)[at]
            known = np.searchsorted(self.distinct, seed)
            hit = self.distinct[np.minimum(known, len(self.distinct) - 1)] == seed
            at, seed = at[hit], seed[hit]
            low, high = np.searchsorted(block.seeds, seed, "left"), np.searchsorted(block.seeds, seed, "right")
            k = high - low
            if not k.sum():
                continue
            entry = np.repeat(low - np.concatenate([[0], np.cumsum(k)[:-1]]), k) + np.arange(k.sum())
            owner = block.owner[entry]
            ok = np.minimum(self.count[owner], self.match) == n
            found.append((np.repeat(at, k)[ok], owner[ok], block.place[entry][ok], np.full(ok.sum(), n)))
        if not found:
            return
        where, item, place, size = (np.concatenate(x) for x in zip(*found))
        row = np.searchsorted(first, where, "right") - 1
        order = np.lexsort((where, item, row))
        where, item, place, size, row = (x[order] for x in (where, item, place, size, row))
        new = np.ones(len(row), bool)
        new[1:] = (np.diff(row) != 0) | (np.diff(item) != 0)
        cuts = np.concatenate([np.flatnonzero(new), [len(row)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            n, i = int(size[a]), int(item[a])
            covered = np.zeros(self.count[i], bool)
            covered[np.unique(place[a:b])[:, None] + np.arange(n)] = True
            if covered.sum() >= self.least * self.count[i]:
                yield int(row[a]), i, np.unique(where[a:b][:, None] + np.arange(n))

    def find(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, list[int]]]:
        """(row, item, item tokens, covered tokens, tiles) of the pairs that reach the threshold."""
        data, at = text_bytes(lower_text(texts))
        for low, high in steps(at):
            h, first = self.tokens(data, at[low: high + 1])
            for row, i, places in self.candidates(h, first):
                # Only tokens under seeds can be in tiles; a zero keeps apart what the text does.
                gap = np.flatnonzero(np.diff(places) > 1) + 1
                doc, origin = np.insert(h[places], gap, 0), np.insert(places, gap, 0)
                item = self.block.tokens[self.block.first[i]: self.block.first[i + 1]]
                tiles = tile(doc, item, min(self.match, len(item)), self.tokens.hasher)
                n = sum(t[2] for t in tiles)
                if n >= self.least * len(item):
                    spans = [x for a, b, k in sorted(tiles, key=lambda t: t[1]) for x in (int(origin[a] - first[row]), b, k)]
                    yield low + row, i, len(item), n, spans


def _pairs(block: Block, match: int, least: float):
    def make():
        matcher, schema = Matcher(block, match, least), arrow_schema(PAIRS)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids = batch.column("doc_id")
            rows = [(ids[r].as_py(), int(block.ids[i]), size, n, n / size, spans)
                    for r, i, size, n, spans in matcher.find(batch.column("text"))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        return step

    return make


def _flags(block: Block, match: int, least: float):
    def make():
        matcher = Matcher(block, match, least)

        def derive(texts: pa.Array) -> list:
            found = np.zeros(len(texts), bool)
            found[[r for r, *_ in matcher.find(texts)]] = True
            return [pa.array(found)]

        return derive

    return make


def find_passages(
    docs: DataFrame, benchmark: DataFrame, least: float = COVERAGE, match: int = MATCH, block: int = BLOCK
) -> DataFrame:
    """(doc_id, item_id, n_tokens, n_covered, coverage, tiles) of the pairs with ``coverage`` of at least ``least``.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text). ``tiles`` holds doc token, item token and length of
    every tile, in the item's order. Texts that are NULL or without tokens are in no pair; every row of either
    table is matched on its own, so repeated rows give repeated pairs. Items without an id are left out.
    """
    texts = docs.select("doc_id", "text")
    out = docs.sparkSession.createDataFrame([], PAIRS)
    for part in blocks(benchmark, match, block):
        if part.sizes:
            out = out.unionByName(map_arrow(texts, _pairs(part, match, least), PAIRS))
    return out


def without_passages(
    docs: DataFrame, benchmark: DataFrame, least: float = COVERAGE, match: int = MATCH, block: int = BLOCK
) -> DataFrame:
    """The rows of ``docs`` (a column ``text`` and any others) that contain no item: no join, one pass a block."""
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    for part in blocks(benchmark, match, block):
        if part.sizes:
            out = map_rows(out, ["row"], ["row.text"], _flags(part, match, least), "found boolean").where("not found").select("row")
    return out.select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it contains, with the share of the item that tiles cover."""
    pairs = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.withColumn("n_tiles", (F.size("tiles") / 3).cast("int")).drop("tiles")
