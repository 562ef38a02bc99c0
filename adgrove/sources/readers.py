"""Readers: day partitions, ad JSON, tab-separated cluster, hash, embedding and word files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adgrove.sources.schemas import AD_JSON, CLUSTER_COLUMNS


def read_day(spark: SparkSession, path: str, day: int, column: str = "partition_date", view: str | None = None) -> DataFrame:
    """One day of a day-partitioned table; the filter prunes directories. Optionally registered as a view."""
    df = spark.read.parquet(path).where(F.col(column) == day)
    if view:
        df.createOrReplaceTempView(view)
    return df


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): text lines with their 0-based number in file order, without moving a line.

    A first pass counts the lines of each file split. Inside a split lines are read in order, so a line's number is the
    number of lines in the splits before its own, plus its place in the split; the second pass adds the two where it reads.
    Splits are one row each, in one window and broadcast: a row for every ``spark.sql.files.maxPartitionBytes`` of text.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    splits = lines.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_lines"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first")
    offsets = splits.select("_file", "_start", shift.alias("_shift"))
    numbered = lines.join(F.broadcast(offsets), ["_file", "_start"])
    return numbered.select((F.col("_pos") + F.col("_shift")).alias("line"), "value")


def zip_lines(left: DataFrame, right: DataFrame) -> DataFrame:
    """Line-aligned files side by side: line, left, right. A length mismatch is an error when rows are read."""

    def present(name: str) -> Column:
        missing = F.raise_error(F.concat(F.lit("files differ in length at line "), F.col("line").cast("string")))
        return F.when(F.col(f"_has_{name}").isNull(), missing.cast("string")).otherwise(F.col(name)).alias(name)

    sides = [
        df.select("line", F.col("value").alias(n), F.lit(True).alias(f"_has_{n}"))
        for df, n in ((left, "left"), (right, "right"))
    ]
    return sides[0].join(sides[1], "line", "full_outer").select("line", present("left"), present("right"))


def _fields(lines: DataFrame, names: dict[str, int]) -> DataFrame:
    parts = F.split("value", "\t")
    return lines.select("line", *[F.get(parts, F.lit(i)).alias(n) for n, i in names.items()])


def read_ads(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Ad objects from a JSON array file; missing texts become ``"null"``, a missing word list an empty one.

    An array is one piece for one task. Large inputs come with an object a line (``lines``), which splits.
    """
    ads = spark.read.schema(AD_JSON).json(path, multiLine=not lines)
    texts = ("aid", "uid", "uname", "coname", "url", "city")
    return ads.withColumns({n: F.coalesce(n, F.lit("null")) for n in texts}).withColumn(
        "wordlist", F.coalesce("wordlist", F.array().cast("array<string>"))
    )


def read_hashes(spark: SparkSession, path: str) -> DataFrame:
    """aid, url, hash in line order; rows whose hash is "0" are dropped."""
    rows = _fields(numbered_lines(spark, path), {"aid": 0, "url": 1, "hash": 2})
    return rows.where("hash <> '0'").select(F.col("line").alias("idx"), "aid", "url", F.col("hash").cast("long").alias("hash"))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Cluster file rows, ``idx`` in line order."""
    names = {n: i for i, n in enumerate(CLUSTER_COLUMNS)}
    return _fields(numbered_lines(spark, path), names).withColumnRenamed("line", "idx")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Known clusters for assignment: pos, hash, cluster_id."""
    return _fields(numbered_lines(spark, path), {"hash": 9, "cluster_id": 5}).select(
        F.col("line").alias("pos"), F.col("hash").cast("long").alias("hash"), F.col("cluster_id").cast("long").alias("cluster_id")
    )


def read_embeddings(spark: SparkSession, path: str, aid: int = 0, url: int = 1, vector: int = 3) -> DataFrame:
    """idx, aid, url, vector from comma-joined floats."""
    rows = _fields(numbered_lines(spark, path), {"aid": aid, "url": url, "text": vector})
    return rows.select(
        F.col("line").alias("idx"), "aid", "url", F.split("text", ",").cast("array<double>").alias("vector")
    )


def read_word_values(spark: SparkSession, path: str) -> DataFrame:
    """word, value pairs of a tab-separated map file."""
    return spark.read.schema("word string, value double").csv(path, sep="\t", quote="")
