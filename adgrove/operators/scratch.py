"""Lineage cuts: intermediate tables in the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``. Only a local-master session may fall back to a temporary folder."""
    folder = spark.conf.get(_CONF, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CONF} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="adgrove-")
    spark.conf.set(_CONF, folder)
    return folder


class Scratch:
    """Writes a DataFrame as a table and reads it back, so later stages restart from files, not from lineage.

    A table on shared storage survives lost executors, keeps its columns prunable and costs one pass.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/adgrove-{uuid.uuid4().hex}"
        self.tables = 0

    def cut(self, df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
        """Materialised ``df`` and the requested aggregate metrics, collected during the same write."""
        self.tables += 1
        path = f"{self.folder}/{self.tables:04d}"
        if metrics:
            seen = Observation(f"cut-{uuid.uuid4().hex}")
            df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).write.parquet(path)
            values = seen.get
        else:
            df.write.parquet(path)
            values = {}
        return self.spark.read.schema(df.schema).parquet(path), values

    def release(self) -> None:
        """Deletes this owner's tables; call it when no DataFrame read from them is needed any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Stored bytes for each task of a wide shuffle, and files whose sizes are asked for one by one.
TASK_BYTES, MOST_FILES = 8 << 20, 1000


def wide_tasks(df: DataFrame, each: int = TASK_BYTES) -> int | None:
    """Tasks for a shuffle of ``df``'s rows, by the size of the files it reads; None where the session's number will do.

    A fixed number of tasks would let each one's share, and the memory it takes, grow with the input.
    """
    spark, files = df.sparkSession, df.inputFiles()
    if len(files) > MOST_FILES:
        files = sorted({f.rpartition("/")[0] for f in files})
    size = 0
    for name in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    tasks = -(-size // each)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None
