"""Near-duplicate documents: one-permutation MinHash, banded buckets, star edges, exact confirmation.

1. One pass over the texts gives every document its set size, a 128-bit hash of its shingle set and the hashes of its
   signature's bands. Signatures come from one hash of each shingle: the smallest value in each bin, empty bins filled
   by optimal densification.
2. Documents with equal sets are one class, represented by their smallest id.
3. In each bucket (a band value) every representative gets one edge, to the bucket's smallest id. Components of these
   candidate edges are groups: two documents that share a bucket are in one group, and pair counts stay linear.
4. Inside a group links are decided on full shingle sets by a search that tests a document only against those no link
   has reached yet. Nothing but each document's root is written. Groups above ``GROUP`` shingles are cut into blocks:
   all blocks first meet a block of common centres, then each other unless they lie in one component already.
5. Components of confirmed links, joined back to the documents through their classes, give the result.

Two documents with similarity s share no bucket with probability (1 - s^ROWS)^BANDS: 1.2e-7 at the threshold of 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, map_arrow, map_runs, table
from adgrove.llm.words import Hasher, Words, inside, lowered, mix, signed, split_words, steps, text_bytes
from adgrove.operators.components import connected_components
from adgrove.operators.scratch import Scratch
from adgrove.operators.skew import join_spread

#: Documents are linked from this similarity on, in hundredths.
PERCENT = 80
BANDS, ROWS = 40, 5
BINS = BANDS * ROWS
#: Shingles of one group, or of two blocks of it, that a task compares at once.
GROUP = 1 << 18


class Shingler:
    """Distinct shingles of texts as 64-bit numbers."""

    def __init__(self, words: int):
        self.size, self.hasher = words, Hasher(21)

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, shingle) of every distinct shingle, sorted by row and shingle.

        Words are runs of bytes other than white space, A-Z in lower case. A text with fewer words than a shingle has
        one, the whole sequence; a text without words has none.
        """
        w: Words = split_words(data, offsets)
        w = w._replace(data=lowered(w.data))
        h, count = self.hasher.words(w), np.diff(w.first)
        starts = inside(w.first, self.size)
        row = np.repeat(np.arange(len(count)), np.maximum(count - self.size + 1, 0))
        found, rows = [self.hasher.windows(h, self.size)[starts]], [row]
        for n in range(1, self.size):
            short = np.flatnonzero(count == n)
            if len(short):
                found.append(self.hasher.windows(h, n)[w.first[short]])
                rows.append(short)
        x, row = mix(np.concatenate(found) * np.uint64(0x9E3779B97F4A7C15)), np.concatenate(rows)
        order = np.lexsort((x, row))
        x, row = x[order], row[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
        return row[new], x[new]


def signatures(row: np.ndarray, x: np.ndarray, texts: int) -> np.ndarray:
    """Smallest value of each bin of each text; an empty bin takes that of the first filled bin of its own order."""
    sig = np.zeros((texts, BINS), np.uint64)
    filled = np.zeros((texts, BINS), bool)
    place = ((x >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    place = place.astype(np.int64)
    first = np.ones(len(x), bool)
    first[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1])
    sig[row[first], place[first]] = x[first]
    filled[row[first], place[first]] = True
    text, at = np.nonzero(~filled & filled.any(1)[:, None])
    attempt = 0
    while len(text):
        attempt += 1
        donor = (mix((at.astype(np.uint64) << np.uint64(32)) + np.uint64(attempt)) % np.uint64(BINS)).astype(np.int64)
        ok = filled[text, donor]
        sig[text[ok], at[ok]] = sig[text[ok], donor[ok]]
        text, at = text[~ok], at[~ok]
    return sig


SIGNATURES = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def _signer(words: int):
    def make():
        shingler, schema = Shingler(words), arrow_schema(SIGNATURES)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            data, at = text_bytes(batch.column("text"))
            for low, high in steps(at):
                n = high - low
                row, x = shingler.sets(data, at[low: high + 1])
                size = np.bincount(row, minlength=n)
                ends = np.cumsum(size)
                sums = []
                for salt in (0x51ED270B35A5F1D3, 0x2545F4914F6CDD1D):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(x ^ np.uint64(salt)))])
                    sums.append(mix(total[ends] - total[ends - size] + size.astype(np.uint64)))
                sig = signatures(row, x, n).reshape(n, BANDS, ROWS)
                band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (n, BANDS)).copy()
                for k in range(ROWS):
                    band = mix(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1) * BANDS, pa.int32()), signed(np.ascontiguousarray(band).reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, n), pa.array(size), signed(sums[0]), signed(sums[1]), bands],
                    schema=schema,
                )

        return step

    return make


def linked(first: np.ndarray, shingle: np.ndarray, percent: int) -> np.ndarray:
    """Root of every document by links of full sets; ``first`` cuts ``shingle`` into the documents' sets.

    A document is tested only against those not reached yet, so a group that hangs together costs little; what
    cannot be linked is tested against everything.
    """
    n, size = len(first) - 1, np.diff(first)
    root = np.full(n, -1)
    vocabulary, flat = np.unique(shingle, return_inverse=True)
    mark = np.zeros(len(vocabulary), np.uint8)
    left, part, cuts = np.arange(n), flat, first[:-1]
    alive, waiting = np.ones(n, bool), []
    while True:
        if waiting:
            i = waiting.pop()
        else:
            if not alive.any():
                return root
            k = int(alive.argmax())
            i = int(left[k])
            alive[k], root[i] = False, i
        if not alive.any():
            continue
        own = flat[first[i]: first[i + 1]]
        mark[own] = 1
        both = np.add.reduceat(mark[part], cuts, dtype=np.int64)
        mark[own] = 0
        ok = alive & (100 * both >= percent * (size[i] + size[left] - both))
        hit = left[ok]
        root[hit] = root[i]
        waiting += hit.tolist()
        alive &= ~ok
        if 2 * alive.sum() < len(alive):
            left = left[alive]
            alive = np.ones(len(left), bool)
            if len(left):
                part = np.concatenate([flat[first[j]: first[j + 1]] for j in left])
                cuts = np.concatenate([[0], np.cumsum(size[left])[:-1]])


def _links(percent: int):
    """Star links (a: document, b: root) of each run of (…, doc_id, shingles) rows."""

    def make():
        schema = arrow_schema("a bigint, b bigint")

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids = batch.column("doc_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            sets = batch.column("shingles").take(pa.array(order)).to_pylist()
            first = np.concatenate([[0], np.cumsum([len(s) // 8 for s in sets])])
            root = linked(first, np.frombuffer(b"".join(sets), np.uint64), percent)
            ids = ids[order]
            child = ids != ids[root]
            if child.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[child]), pa.array(ids[root][child])], schema=schema)

        return step

    return make


LABELS = "grp bigint, doc_id bigint, size bigint, h bigint, label bigint, own boolean"


def _labels(percent: int):
    """Label of each document of a block: the smallest centre that links lead to, else the smallest document."""

    def make():
        schema = arrow_schema(LABELS)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            order = pa.array(np.argsort(batch.column("doc_id").to_numpy(), kind="stable"))
            batch = batch.take(order)
            ids = batch.column("doc_id").to_numpy()
            sets = batch.column("shingles").to_pylist()
            first = np.concatenate([[0], np.cumsum([len(s) // 8 for s in sets])])
            root = linked(first, np.frombuffer(b"".join(sets), np.uint64), percent)
            label = ids[root]
            centre = np.flatnonzero(batch.column("centre").to_numpy(zero_copy_only=False))[::-1]
            by_root = np.full(len(ids), -1)
            by_root[root[centre]] = centre
            known = by_root[root] >= 0
            label[known] = ids[by_root[root[known]]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) if n != "label" else pa.array(label) for n in schema.names], schema=schema
            )

        return step

    return make


def _setter(words: int):
    def make():
        shingler = Shingler(words)
        schema = arrow_schema("grp bigint, doc_id bigint, size bigint, shingles binary")

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            data, at = text_bytes(batch.column("text"))
            for low, high in steps(at):
                n = high - low
                row, x = shingler.sets(data, at[low: high + 1])
                size = np.bincount(row, minlength=n)
                cuts = np.concatenate([[0], np.cumsum(size)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grp").slice(low, n), batch.column("doc_id").slice(low, n), pa.array(size),
                     pa.array([x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], schema=schema,
                )

        return step

    return make


LINKS = "a bigint, b bigint"


def _large_links(sets: DataFrame, large: DataFrame, percent: int, limit: int, scratch: Scratch) -> DataFrame | None:
    """Links in groups whose sets do not fit one task; ``large`` has (grp, shingles_of). None if there are none."""
    large, seen = scratch.cut(large.select("grp", "shingles_of"), rows=F.count(F.lit(1)), total=F.sum("shingles_of"))
    if not seen["rows"]:
        return None
    half = limit // 2
    members, _ = scratch.cut(
        join_spread(sets, large.withColumn("weight", F.col("shingles_of")), ["grp"], "weight", seen["total"])
        .withColumn("h", F.xxhash64("doc_id"))
    )

    def deal(weight: str) -> Column:
        return F.pmod("h", F.ceil(F.col(weight) / half).cast("bigint")).cast("int")

    # First round: every block meets the same centres, a share of the group that fills a quarter of a task. A document
    # linked to a centre takes the centre's id as label, so equal labels are one component in whatever blocks they are.
    share = F.pmod("h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    centre = (share < F.lit(half / 2) / F.col("shingles_of")).alias("centre")
    columns = ["doc_id", "size", "h", "shingles"]
    met = members.select("grp", deal("shingles_of").alias("block"), *columns, centre, F.lit(True).alias("own"))
    blocks = F.explode(F.sequence(F.lit(0), F.ceil(F.col("shingles_of") / half).cast("int") - 1)).alias("block")
    met = met.unionByName(members.where(centre).select("grp", blocks, *columns, F.lit(True).alias("centre"), F.lit(False).alias("own")))
    labelled, counted = scratch.cut(
        map_runs(met, ["grp", "block"], None, _labels(percent), LABELS), rows=F.count(F.lit(1))
    )
    first = labelled.select(F.col("doc_id").alias("a"), F.col("label").alias("b")).where("a <> b")
    placed = labelled.where("own").select("grp", "doc_id", "size", "h", "label").distinct()
    # Second round: blocks of one label each, or of small labels mixed; blocks that differ in label meet.
    weights = placed.groupBy("grp", "label").agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("weight"))
    named, _ = scratch.cut(
        join_spread(placed, weights, ["grp", "label"], "weight", counted["rows"])
        .withColumn("pure", F.when(F.col("w") >= half // 2, F.col("label")))
    )
    loose = named.where("pure is null")
    mixed = loose.groupBy("grp").agg(F.sum("size").alias("w_mixed"), F.count(F.lit(1)).alias("weight"))
    seat = F.concat_ws("-", F.coalesce(F.col("pure").cast("string"), F.lit("mixed")), "piece")
    blocks, _ = scratch.cut(
        named.where("pure is not null").select("grp", "doc_id", "pure", deal("w").alias("piece")).unionByName(
            join_spread(loose, mixed, ["grp"], "weight", counted["rows"])
            .select("grp", "doc_id", "pure", deal("w_mixed").alias("piece"))
        ).withColumn("block", seat)
    )
    known = blocks.groupBy("grp", "block").agg(F.first("pure").alias("pure"))
    other = known.select("grp", F.col("block").alias("block_2"), F.col("pure").alias("pure_2"))
    meet = (
        known.join(other, "grp")
        .where("(block < block_2 or (block = block_2 and pure is null)) and not (pure <=> pure_2 and pure is not null)")
        .withColumn("pair", F.concat_ws("|", "block", "block_2"))
    )
    seats = meet.select("grp", "block", "pair").unionByName(
        meet.where("block < block_2").select("grp", F.col("block_2").alias("block"), "pair")
    )
    rows = (
        blocks.select("grp", "block", "doc_id").join(seats, ["grp", "block"])
        .join(members.select("grp", "doc_id", "shingles"), ["grp", "doc_id"])
        .select("grp", "pair", "doc_id", "shingles")
    )
    return first.unionByName(map_runs(rows, ["grp", "pair"], None, _links(percent), LINKS))


def components(
    docs: DataFrame, words: int = 5, percent: int = PERCENT, limit: int = GROUP, scratch: Scratch | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Two documents are linked where ``100 * |intersection| >= percent * |union|`` of their sets of distinct
    ``words``-word shingles. ``component_id`` is the smallest id that links lead to, ``kept`` marks it. A text that
    is NULL, empty or without words has an empty set and is linked with nothing. Every row is judged by its text, so
    repeated rows repeat their result; an id that stands for several texts as their smallest joins them. A row with a
    NULL id is linked with nothing, has a NULL component and is kept.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    signed_docs, seen = scratch.cut(map_arrow(docs.select("doc_id", "text"), _signer(words), SIGNATURES),
                                    rows=F.count(F.lit(1)))
    sized = signed_docs.where("doc_id is not null and n_shingles > 0")
    classes, stats = scratch.cut(
        sized.groupBy("set_a", "set_b")
        .agg(F.min(F.struct("doc_id", "bands")).alias("least"), F.count(F.lit(1)).alias("weight"))
        .select("set_a", "set_b", F.col("least.doc_id").alias("rep"), F.col("least.bands").alias("bands"), "weight"),
        rows=F.count(F.lit(1)),
    )
    seats = classes.select("rep", F.explode("bands").alias("band"))
    buckets = (
        seats.groupBy("band").agg(F.min("rep").alias("star"), F.count(F.lit(1)).alias("weight")).where("weight > 1")
    )
    stars = (
        join_spread(seats, buckets, ["band"], "weight", max(1, stats["rows"] * BANDS))
        .where("rep <> star").select(F.col("rep").alias("a"), F.col("star").alias("b")).distinct()
    )
    groups = connected_components(stars, scratch).select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))
    wanted = docs.select("doc_id", "text").hint("merge").join(groups, "doc_id").select("grp", "doc_id", "text")
    sets, _ = scratch.cut(
        map_arrow(wanted, _setter(words), "grp bigint, doc_id bigint, size bigint, shingles binary").where("size > 0")
    )
    sizes, _ = scratch.cut(sets.groupBy("grp").agg(F.sum("size").alias("shingles_of"), F.count(F.lit(1)).alias("weight")))
    is_large = F.col("shingles_of") > limit
    small = sets.join(sizes.where(is_large).select("grp"), "grp", "left_anti").select("grp", "doc_id", "shingles")
    edges = map_runs(small, ["grp"], None, _links(percent), LINKS)
    large = _large_links(sets, sizes.where(is_large), percent, limit, scratch)
    if large is not None:
        edges = edges.unionByName(large)
    found = connected_components(edges, scratch).withColumnRenamed("node", "rep")
    placed = classes.drop("bands").join(found, "rep", "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("component"), "weight"
    )
    of_rows = join_spread(
        sized.select("doc_id", "n_shingles", "set_a", "set_b"), placed, ["set_a", "set_b"], "weight", max(1, seen["rows"])
    )
    alone = signed_docs.where("doc_id is null or n_shingles = 0")
    return of_rows.select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept")
    ).unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles."""
    return components(table(spark, sf_dir, "documents"), words=4)
