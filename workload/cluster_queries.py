"""Clustering, distance and text queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.functions import dates
from adgrove.functions import text as tx
from adgrove.operators import block_index, embeddings, text_model, words
from adgrove.operators.assign import assign_incremental
from adgrove.operators.dbscan import dbscan
from adgrove.operators.pairs import degrees, distinct_keys, prepare_pairs
from adgrove.operators.scratch import Scratch
from adgrove.operators.skew import join_spread
from adgrove.operators.spaces import HashSpace, MixedSpace, Space, VectorSpace
from adgrove.plans import clusters
from workload import cluster_sql as s
from workload import views as v

HASHES = HashSpace(s.EPS, v.HASH_BITS)
VECTORS = VectorSpace(s.VECTOR_EPS, v.DIM)
MIXED = MixedSpace(
    s.MIXED_EPS, user_weight=s.USER, company_weight=s.COMPANY, city_weight=s.CITY, near=-1, far=1, clamp=True, bits=v.HASH_BITS,
)
URL_LED = MixedSpace(s.LED_EPS, url_weight=1, user_weight=1, company_weight=1)
ONE_SIDED = MixedSpace(s.MIXED_EPS, user_weight=s.ONE_SIDED_USER, use_hash=True, one_sided=True, bits=v.HASH_BITS)
CITY_LED = MixedSpace(s.CITY_EPS, url_weight=s.CITY_URL, city_weight=1)
INDUSTRY = "en"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.floor(F.col(n) * 1e6 + 0.5) / 1e6 for n in names})


def _dbscan(noise: str):
    return lambda spark, d: dbscan(v.creatives(spark, d), HASHES, s.MIN_POINTS, noise).points


def _summary(spark, d):
    return dbscan(v.creatives(spark, d), HASHES, s.MIN_POINTS).summary


def _vectors(spark, d):
    return clusters.cluster_embeddings(v.vectors(spark, d), VECTORS, s.VECTOR_MIN)[0]


def _industry(spark, d):
    return clusters.cluster_ads(v.creatives(spark, d), HASHES, s.MIN_POINTS, INDUSTRY, 1, start_id=10)[0]


def _industries(spark, d):
    """All industries in one job, ids running on from one to the next."""
    rows, _ = clusters.cluster_industries(v.creatives(spark, d), HASHES, s.INDUSTRIES, s.MIN_POINTS, 1, start_id=10)
    return rows.select("idx", F.col("cluster_id").cast("bigint").alias("cluster_id"))


def _industries_summary(spark, d):
    return clusters.cluster_industries(v.creatives(spark, d), HASHES, s.INDUSTRIES, s.MIN_POINTS, 1, start_id=10, start_noise=3)[1]


def _cluster_file(spark: SparkSession, d: str) -> DataFrame:
    """Cluster file with the language as cluster: few clusters, the largest holding most rows."""
    ads = v.creatives(spark, d)
    return ads.select(
        "idx", "aid", "uid", "uname", F.lit("0").alias("rho"), F.lit("0").alias("delta"),
        F.get("industry_type", F.lit(1)).alias("cluster_id"), F.lit("0").alias("neighbor"),
        F.concat_ws(",", "wordlist").alias("wordlist"), "url", F.col("hash").cast("string").alias("simhash_emb"), "city",
    )


def _refine(spark, d):
    space = MixedSpace(0.15, user_weight=1, use_hash=True, known_users=True, bits=v.HASH_BITS)
    return clusters.refine_clusters(_cluster_file(spark, d), space, 2)[0].select("idx", "cluster_id")


def _mixed(spark, d):
    """Clusters by the clamped mix of hash, user, company and city distances."""
    return dbscan(v.creatives(spark, d), MIXED, s.MIN_POINTS).points


def _one_sided(spark, d):
    """Clusters where an ad without a user is near all users, and they are far from it."""
    ads = v.creatives(spark, d)
    return dbscan(ads.withColumn("uname", F.when(F.col("idx") % 3 == 0, "0").otherwise(F.col("uname"))), ONE_SIDED, s.MIN_POINTS).points


def _names(spark, d):
    return clusters.refine_by_name(_cluster_file(spark, d)).select("idx", "cluster_id")


def neighbourhood(points: DataFrame, space: Space) -> tuple[DataFrame, DataFrame]:
    """Points with their key id, and the close pairs of keys with weights."""
    scratch = Scratch(points.sparkSession)
    keys, seen = scratch.cut(distinct_keys(points, space), rows=F.count(F.lit(1)))
    pairs = prepare_pairs(keys, seen["rows"], space, scratch).close_pairs(keys, ["weight"])
    own = keys.select(*space.key_columns, "kid", "weight", F.col("weight").alias("rows"))
    total = keys.agg(F.sum("weight")).first()[0] or 1
    members = join_spread(points.select("idx", *space.key_columns), own, list(space.key_columns), "rows", total)
    return members, pairs


def _counts(points: Callable, space: Space):
    def run(spark, d):
        members, pairs = neighbourhood(points(spark, d), space)
        return members.join(degrees(pairs), "kid", "left").select(
            "idx", (F.col("weight") + F.coalesce("others", F.lit(0))).alias("neighbours")
        )
    return run


def _nearest(spark, d):
    """Nearest other point below eps: among copies the first, else the first point of the nearest key."""
    members, pairs = neighbourhood(v.creatives(spark, d), HASHES)
    both = F.array(
        F.struct(F.col("a").alias("kid"), F.struct("d", F.col("b").alias("other")).alias("best")),
        F.struct(F.col("b").alias("kid"), F.struct("d", F.col("a").alias("other")).alias("best")),
    )
    best = pairs.select(F.explode(both).alias("s")).groupBy("s.kid").agg(F.min("s.best").alias("best"))
    second = members.where("idx > kid").groupBy("kid").agg(F.min("idx").alias("second"))
    twin = F.when(F.col("idx") > F.col("kid"), F.col("kid")).otherwise(F.col("second"))
    return (
        members.join(best, "kid", "left").join(second, "kid", "left")
        .select("idx", F.coalesce(twin, F.col("best.other")).alias("nearest"),
                F.when(twin.isNotNull(), F.lit(0.0)).otherwise(F.col("best.d")).alias("d"))
        .where("nearest is not null")
    )


def _assign(spark, d):
    ads, _ = Scratch(spark).cut(v.creatives(spark, d).select("idx", "hash"))  # history and batch read it
    labels = v.table(spark, d, "labels").withColumnRenamed("doc_id", "idx")
    history = ads.join(labels, "idx").select(
        F.col("idx").alias("pos"), "hash", (F.col("quality") * 10 + F.col("toxic") + 1).alias("cluster_id")
    )
    batch = ads.join(labels, "idx", "left_anti")
    return assign_incremental(batch, history, HashSpace(s.ASSIGN_EPS, v.HASH_BITS)).points


def _assign_stored(spark, d):
    """The same in two batches against a stored index of blocks: the earlier half of the items first."""
    ads, _ = Scratch(spark).cut(v.creatives(spark, d).select("idx", "hash"))  # history and batch read it
    labels = v.table(spark, d, "labels").withColumnRenamed("doc_id", "idx")
    history = ads.join(labels, "idx").select(
        F.col("idx").alias("pos"), "hash", (F.col("quality") * 10 + F.col("toxic") + 1).alias("cluster_id")
    )
    batch, seen = Scratch(spark).cut(ads.join(labels, "idx", "left_anti"), rows=F.count(F.lit(1)), half=F.avg("idx"))
    index = block_index.create_index(spark, Scratch(spark).folder, HashSpace(s.ASSIGN_EPS, v.HASH_BITS), seen["rows"], slots=32)
    block_index.load_history(index, history)
    early = F.col("idx") <= F.lit(seen["half"])
    first = block_index.assign_batch(index, batch.where(early), "first").points
    return first.unionByName(block_index.assign_batch(index, batch.where(~early), "second").points)


def _profile(spark, d):
    return rounded(clusters.distance_profile(v.creatives(spark, d), HASHES), "total", "mean")


def _ranks(spark, d):
    return clusters.distance_ranks(v.vectors(spark, d), VECTORS, 7)


def _successors(ids: DataFrame, name: str) -> DataFrame:
    return ids.select(F.col(name).alias("left_id"), (F.col(name) + 1).alias("right_id"))


def _explain(spark, d):
    ads = v.page_ads(spark, d)
    return clusters.explain_pairs(ads, _successors(ads, "aid"))


def _vector_pairs(spark, d):
    vectors = v.vectors(spark, d)
    return clusters.vector_distances(vectors, _successors(vectors, "idx"))


def _word_lists(spark, d):
    return v.table(spark, d, "documents").selectExpr("doc_id", "split(text, ' ') as wordlist")


def _idf(spark, d):
    return rounded(words.idf_from_documents(_word_lists(spark, d), s.WORD), "idf")


def _frequencies(texts: DataFrame) -> DataFrame:
    return texts.select(F.explode(F.split("text", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("value"))


def _idf_override(spark, d):
    local = _frequencies(v.table(spark, d, "benchmark")).withColumn("value", F.col("value") / 100)
    counts = _frequencies(v.table(spark, d, "documents"))
    return rounded(words.idf_from_counts(counts, local, s.WORD), "idf")


def _label_rows(spark, d):
    levels = ["'x'", "'y'"] + [e.format(text="string") for e in s.LEVELS.values()]
    return v.table(spark, d, "documents").selectExpr("doc_id", "text as tokens", f"array({', '.join(levels)}) as labels")


def _token_parse(spark, d):
    docs = v.table(spark, d, "documents")
    return docs.select("doc_id", F.concat_ws(" ", tx.token_words(F.col("text"))).alias("wordlist"))


def _label_lines(spark, d):
    return words.labelled_texts(_label_rows(spark, d), 3).select("doc_id", "label", "line")


def _next_partition(spark, d):
    ts = v.table(spark, d, "events")
    return ts.select(
        "event_id",
        dates.next_partition_time(F.date_format("ts", "yyyyMMdd"), 3).alias("next_day"),
        dates.next_partition_time(F.date_format("ts", "yyyyMMddHH"), 30).alias("next_hour"),
    )


def _categories(spark, d):
    category = F.col("o_custkey") + F.lit(tx.CATEGORY_OFFSET)
    return v.table(spark, d, "orders").select(
        "o_orderkey", tx.category_level_one(category).alias("level_one"),
        tx.category_level_one(category, whole=False).alias("level_one_plain"), tx.category_level_two(category).alias("level_two"),
    )


def _text_embedding(spark, d):
    rows = words.labelled_texts(_label_rows(spark, d), 3).withColumn("words", F.split("wordlist", " "))
    return embeddings.text_vectors(rows.select("doc_id", "label", "words"), "doc_id").select("doc_id", "label", "vector")


def _label_quality(spark, d):
    docs = v.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("label"), F.split("text", " ").alias("words")
    )
    vectors, _ = Scratch(spark).cut(embeddings.text_vectors(docs, "id").drop("words"))
    return embeddings.label_quality(vectors)


def _text_model(spark, d):
    """A text model learned from four fifths of the documents, judged on the rest."""
    docs = v.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("label"), F.split("text", " ").alias("words")
    )
    held_out = F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 0
    model = text_model.train(docs.where(~held_out), epochs=8)
    return text_model.quality(model, docs.where(held_out))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "dbscan_singleton": (_dbscan("singleton"), s.dbscan_hash("singleton")),
    "dbscan_shared_noise": (_dbscan("shared"), s.dbscan_hash("shared")),
    "dbscan_summary": (_summary, s.dbscan_summary()),
    "dbscan_embeddings": (_vectors, s.dbscan_vectors()),
    "cluster_industry": (_industry, s.cluster_industry(INDUSTRY)),
    "cluster_industries": (_industries, s.cluster_industries()),
    "cluster_industries_summary": (_industries_summary, s.cluster_industries(summary=True)),
    "dbscan_refine": (_refine, s.refine()),
    "dbscan_mixed": (_mixed, s.dbscan_mixed()),
    "dbscan_url_led": (lambda spark, d: dbscan(v.creatives(spark, d), URL_LED, s.MIN_POINTS).points, s.dbscan_url_led()),
    "dbscan_city_led": (lambda spark, d: dbscan(v.creatives(spark, d), CITY_LED, s.MIN_POINTS).points, s.dbscan_city_led()),
    "dbscan_one_sided": (_one_sided, s.dbscan_one_sided()),
    "name_refine": (_names, s.refine_names()),
    "assign_incremental": (_assign, s.assignment()),
    "assign_stored_index": (_assign_stored, s.assignment()),
    "neighbour_counts": (_counts(v.creatives, HASHES), s.neighbour_counts()),
    "neighbour_counts_vectors": (_counts(v.vectors, VECTORS), s.vector_neighbour_counts()),
    "nearest_neighbour": (_nearest, s.nearest()),
    "distance_profile": (_profile, s.profile()),
    "distance_ranks": (_ranks, s.ranks(7)),
    "pair_explanation": (_explain, s.explain()),
    "vector_pair_distances": (_vector_pairs, s.vector_pairs()),
    "idf_occurrence": (_idf, s.idf()),
    "idf_override": (_idf_override, s.idf_override()),
    "idf_diagnostics": (
        lambda spark, d: words.word_diagnostics(_word_lists(spark, d), s.WORD), s.idf_diagnostics()),
    "token_parse": (_token_parse, s.token_parse()),
    "label_fallback": (_label_lines, s.label_lines()),
    "label_diagnostics": (
        lambda spark, d: words.label_diagnostics(_label_rows(spark, d), 3), s.label_diagnostics()),
    "text_embedding": (_text_embedding, s.text_embedding()),
    "label_model_quality": (_label_quality, s.label_quality()),
    "text_model_quality": (_text_model, None),  # trained; tests/test_text_model.py has a plain version
    "partition_next_time": (_next_partition, s.next_partition()),
    "category_levels": (_categories, s.categories()),
}

