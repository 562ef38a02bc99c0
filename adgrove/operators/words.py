"""Word weights and label preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adgrove.functions import text as tx

# Logarithm base of the weights and the document count of the file variant.
IDF_BASE = 30000.0
FILE_DOCUMENTS = 32711


def _idf(documents: Column | int, count: Column) -> Column:
    return F.log(documents / count) / F.log(F.lit(IDF_BASE))


def word_counts(docs: DataFrame, pattern: str = tx.CJK_WORD) -> DataFrame:
    """word, count. Every occurrence counts, also repeats inside one document."""
    words = docs.select(F.explode("wordlist").alias("word")).where(F.col("word").rlike(pattern))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def idf_from_documents(docs: DataFrame, pattern: str = tx.CJK_WORD) -> DataFrame:
    """word, idf over word lists; the number of documents is a scalar subquery of the same job."""
    documents = docs.select(F.count(F.lit(1)).alias("n")).scalar()
    return word_counts(docs, pattern).select("word", _idf(documents, F.col("count")).alias("idf"))


def idf_from_counts(
    counts: DataFrame, local: DataFrame, pattern: str = tx.CJK_WORD, documents: int = FILE_DOCUMENTS
) -> DataFrame:
    """word, idf from a (word, value) frequency table; a word in ``local`` (word, value) takes that value."""
    kept = counts.where(F.col("word").rlike(pattern)).select("word", F.col("value").alias("count"))
    return kept.join(local.withColumnRenamed("value", "local"), "word", "left").select(
        "word", F.coalesce(F.col("local"), _idf(F.lit(float(documents)), F.col("count"))).alias("idf")
    )


def word_diagnostics(docs: DataFrame, pattern: str = tx.CJK_WORD) -> DataFrame:
    """Documents, dropped tokens, distinct words and the largest count, in one row."""
    tokens = docs.select(F.explode("wordlist").alias("word"))
    by_word = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count")).withColumn("kept", F.col("word").rlike(pattern))
    documents = docs.select(F.count(F.lit(1)).alias("n")).scalar()
    return by_word.agg(
        F.sum(F.when(~F.col("kept"), F.col("count")).otherwise(0)).alias("dropped_tokens"),
        F.count_if("kept").alias("words"),
        F.max(F.when(F.col("kept"), F.col("count"))).alias("max_count"),
    ).select(documents.alias("documents"), "dropped_tokens", "words", "max_count")


def labelled_texts(rows: DataFrame, level: int) -> DataFrame:
    """Rows (tokens, labels, …) with ``wordlist``, chosen ``label`` and training ``line``; rows without a label go."""
    words = F.concat_ws(" ", tx.token_words(F.col("tokens")))
    return (
        rows.withColumn("wordlist", words)
        .withColumn("label", tx.choose_label(F.col("labels"), level))
        .where("label is not null")
        .withColumn("line", tx.training_line(F.col("wordlist"), F.col("label")))
    )


def label_diagnostics(rows: DataFrame, level: int) -> DataFrame:
    """How many labels of ``level`` are "0", end in "00" or are empty, and how many rows are dropped."""
    own, parent = F.get("labels", F.lit(level)), F.get("labels", F.lit(level - 1))
    return rows.agg(
        F.count_if(own == "0").alias("zero"),
        F.count_if(own.endswith("00")).alias("double_zero"),
        F.count_if(own == "").alias("empty"),
        F.count_if(tx.unusable_label(own) & tx.unusable_label(parent)).alias("removed"),
    )
