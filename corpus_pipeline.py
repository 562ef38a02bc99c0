"""Training-data pipeline: documents to token ids.

Stages run in order, each on what its predecessor kept, written as Parquet and read again:

1. toxicity: documents that the classifier rejects go.
2. near duplicates: one document of each group stays (5-word shingles, similarity from 0.8 on), repeated rows once.
3. repeated passages: words of 50-word windows that an earlier document has are cut; what is left empty goes.
4. benchmark passages: documents that contain a benchmark item go.
5. tokens: ids of the texts that are left.

A row with a NULL id can be in no group and is no source of passages; it passes stages 2 and 3 unchanged. NULL and
empty texts are clean in every stage, and have no ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.llm import decontaminate, neardup, pieces, substrings, toxicity
from adgrove.llm.common import id_crc, table
from adgrove.operators.scratch import Scratch


def _whole(docs: DataFrame) -> DataFrame:
    """Rows as one column next to the columns that stages read, so that no name of theirs can clash with a new one."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(id_crc("doc_id") % 5 != 0)
    scored = toxicity.classify(_whole(docs), toxicity.learn(docs, labels), ["row"], "row.text")
    return scored.where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = neardup.components(docs.select("doc_id", "text"), words=5)
    gone = found.where("not kept").select("doc_id").distinct()
    # Whole texts meet a list that grows with the corpus: the same join at every size, and one shuffle for both steps.
    return docs.hint("merge").join(gone, "doc_id", "left_anti").select(docs.columns).distinct()


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeated(_whole(docs), ["row"], inside="row").where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("left")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.char_length("left").cast(kind)).otherwise(F.col("row.n_chars"))
    return cut.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = pieces.load(f.read())
    out = pieces.encode(docs, model)
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeated_passages),
    ("benchmark passages", drop_benchmark),
    ("tokens", to_tokens),
]

#: No SQL: a trained classifier and a merge tokenizer. tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the documents in ``sf_dir``."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs, _ = scratch.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
