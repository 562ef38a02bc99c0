"""Sources and sinks over the driver tables: written to the shared folder, read back, compared with the source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adgrove.operators.scratch import Scratch
from adgrove.plans import history
from adgrove.sources import readers, schemas, writers
from workload import cluster_sql as c
from workload import report_sql as r
from workload import views as v
from workload.report_queries import BRANDS, detail, rounded


def _folder(spark: SparkSession) -> str:
    return Scratch(spark).folder


FACT = ["partition_date", "advertiser_id", "product_id", "adgroup_id", "real_cost_micros"]
RERUN, DROPPED = 19960401, 19970301


def _day_table(spark, d):
    """Delivery fact by month: one month written twice, one dropped, one read alone, and an emptied copy."""
    path, fact = _folder(spark), v.ad_fact(spark, d).select(*FACT)
    writers.write_days(fact, f"{path}/fact")
    writers.write_days(fact.where(F.col("partition_date") == RERUN), f"{path}/fact")
    writers.drop_day(spark, f"{path}/fact", DROPPED)
    writers.write_days(fact, f"{path}/empty")
    writers.truncate(spark, f"{path}/empty", "partition_date")
    readers.read_day(spark, f"{path}/fact", RERUN, view="rerun_day")
    whole = spark.read.parquet(f"{path}/fact").select(F.lit("whole").alias("part"), *FACT)
    alone = spark.sql("select * from rerun_day").select(F.lit("day").alias("part"), *FACT)
    empty = spark.read.schema(fact.schema).parquet(f"{path}/empty")
    return whole.unionByName(alone).unionByName(empty.select(F.lit("empty").alias("part"), *FACT))


def _day_table_sql() -> str:
    columns = ", ".join(FACT)
    return f"""with fact as ({v.fact_sql(True)})
    select 'whole' as part, {columns} from fact where partition_date <> {DROPPED}
    union all select 'day', {columns} from fact where partition_date = {RERUN}"""


def _appended(spark, d):
    """Same-day history appended to its warehouse table in two runs."""
    path = f"{_folder(spark)}/history"
    report = history.same_day_history(v.ad_fact(spark, d), v.accounts(spark, d))
    for half in (0, 1):
        writers.append_report(report.where(F.col("partition_date") % 200 >= 100 if half else F.col("partition_date") % 200 < 100),
                              path, schemas.MULTI_TRACE)
    return rounded(spark.read.parquet(path))


def _debug(spark, d):
    """Account days of some brands through the debug text dump."""
    path = f"{_folder(spark)}/debug"
    rows = v.accounts(spark, d).select("imp_date", "account_id", F.col("op_sub_brand").alias("sub_brand"))
    writers.write_debug(rows, path, BRANDS)
    return spark.read.schema("imp_date int, account_id bigint, sub_brand string").csv(path)


def _debug_sql() -> str:
    names = ", ".join(f"'{b}'" for b in BRANDS)
    return f"""select imp_date, account_id, op_sub_brand as sub_brand from ({v.accounts_sql(True)}) a
    where op_sub_brand in ({names})"""


DEBUG_ADS = ("partition_date", "op_industry", "advertiser_id", "sub_brand", "product_id", "adgroup_id", "costs", "gmvc")


def _debug_ads(spark, d):
    """Joined ads of some brands, with their industry and weighted costs, through the debug text dump."""
    path = f"{_folder(spark)}/debug"
    rows = rounded(detail(spark, d).select(*DEBUG_ADS))
    writers.write_debug(rows, path, BRANDS)
    return spark.read.schema(rows.schema).csv(path)


def _debug_ads_sql() -> str:
    names = ", ".join(f"'{b}'" for b in BRANDS)
    return f"select {', '.join(DEBUG_ADS)} from ({r.detail()}) d where sub_brand in ({names})"


ADS = ("aid", "uid", "uname", "coname", "url", "hash", "wordlist", "city")


def _ad_json(spark, d):
    """Ads as JSON lines; every seventh without a user name."""
    path = f"{_folder(spark)}/ads"
    ads = v.creatives(spark, d)
    ads.withColumn("uname", F.when(F.col("idx") % 7 != 0, F.col("uname"))).select(*ADS, "industry_type").write.json(path)
    return readers.read_ads(spark, path, lines=True).select(*ADS)


def _ad_json_sql() -> str:
    return f"""select aid, uid, case when idx % 7 = 0 then 'null' else uname end as uname, coname, url, hash,
      string_split(text, ' ') as wordlist, city from ({v.creatives_sql()}) c join documents on doc_id = idx"""


def _hash_file(spark, d):
    """aid, url, hash lines in index order; every fifth hash is "0" and dropped by the reader."""
    path = f"{_folder(spark)}/hashes"
    ads = v.creatives(spark, d).withColumn("hash", F.when(F.col("idx") % 5 != 0, F.col("hash")).otherwise(0))
    lines = ads.repartitionByRange("idx").sortWithinPartitions("idx").select(F.concat_ws("\t", "aid", "url", "hash").alias("value"))
    lines.write.text(path)
    return readers.read_hashes(spark, path)


def _hash_file_sql() -> str:
    return f"""select * from (select row_number() over (order by idx) - 1 as idx, aid, url, hash, idx % 5 as m
      from ({v.creatives_sql()}) c) t where m <> 0 and hash <> 0""".replace("select * from", "select idx, aid, url, hash from", 1)


def _cluster_file(spark, d) -> str:
    path = f"{_folder(spark)}/clusters"
    ads = v.creatives(spark, d)
    writers.write_clusters(ads.select(
        "idx", "aid", "uid", "uname", F.lit("0").alias("rho"), F.lit("0").alias("delta"), (F.col("idx") % 13).alias("cluster_id"),
        F.lit("0").alias("neighbor"), F.lit("w").alias("wordlist"), "url", F.col("hash").alias("simhash_emb"), "city",
    ), path)
    return path


def _clusters(spark, d):
    return readers.read_clusters(spark, _cluster_file(spark, d))


def _clusters_sql() -> str:
    return f"""select row_number() over (order by idx) - 1 as idx, aid, uid, uname, '0' as rho, '0' as delta,
      cast(idx % 13 as varchar) as cluster_id, '0' as neighbor, 'w' as wordlist, url, cast(hash as varchar) as simhash_emb, city
    from ({v.creatives_sql()}) c"""


def _history(spark, d):
    return readers.read_history(spark, _cluster_file(spark, d))


def _history_sql() -> str:
    return f"select row_number() over (order by idx) - 1 as pos, hash, idx % 13 as cluster_id from ({v.creatives_sql()}) c"


def _embedding_file(spark, d):
    path = f"{_folder(spark)}/vectors"
    writers.write_embeddings(v.vectors(spark, d), path)
    back = readers.read_embeddings(spark, path, vector=2)
    return back.select("aid", "url", F.col("vector").cast("array<bigint>").alias("vector"))


def _short_clusters(spark, d):
    path = f"{_folder(spark)}/short"
    writers.write_short_clusters(v.vectors(spark, d).withColumn("cluster_id", F.col("idx") % 9), path)
    return spark.read.schema("aid string, url string, cluster_id bigint").csv(path, sep="\t")


def _word_file(spark, d):
    """Frequencies of plain words through the word map file."""
    path = f"{_folder(spark)}/words"
    words = v.table(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("word")).where(F.col("word").rlike(c.WORD))
    writers.write_word_values(words.groupBy("word").agg(F.count(F.lit(1)).alias("value")), path)
    return readers.read_word_values(spark, path).withColumn("value", F.col("value").cast("bigint"))


def _word_file_sql() -> str:
    return f"""select word, count(*) as value from (select unnest(string_split(text, ' ')) as word from documents) t
    where regexp_matches(word, '{c.WORD}') group by word"""


def _zipped(spark, d):
    """Two files with a line for each document, side by side."""
    path = f"{_folder(spark)}/zip"
    docs = v.table(spark, d, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    for name, column in (("left", F.col("doc_id").cast("string")), ("right", F.concat_ws("-", "lang", "source"))):
        docs.select(column.alias("value")).write.text(f"{path}/{name}")
    left, right = (readers.numbered_lines(spark, f"{path}/{name}") for name in ("left", "right"))
    return readers.zip_lines(left, right)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "io_day_table": (_day_table, _day_table_sql()),
    "io_append_history": (_appended, r.same_day(1, "gdt")),
    "io_debug_dump": (_debug, _debug_sql()),
    "io_debug_ads": (_debug_ads, _debug_ads_sql()),
    "io_ad_json": (_ad_json, _ad_json_sql()),
    "io_hash_file": (_hash_file, _hash_file_sql()),
    "io_cluster_file": (_clusters, _clusters_sql()),
    "io_history_file": (_history, _history_sql()),
    "io_embedding_file": (_embedding_file, f"select aid, url, vector from ({v.vectors_sql()}) e"),
    "io_short_clusters": (_short_clusters, f"select aid, url, idx % 9 as cluster_id from ({v.vectors_sql()}) e"),
    "io_word_file": (_word_file, _word_file_sql()),
    "io_zip_lines": (
        _zipped, "select row_number() over (order by doc_id) - 1 as line, cast(doc_id as varchar) as \"left\", "
                 "lang || '-' || source as \"right\" from documents"),
}
