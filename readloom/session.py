"""Session helpers: where lineage is cut, and how tables are loaded."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``; one of our own only where that is unset and
    the executors are this machine's. On a cluster an unset folder is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="readloom-"))
    return sc.getCheckpointDir()


#: Tables kept by this process.
_KEPT: list[str] = []


def drop_kept(spark: SparkSession) -> int:
    """Deletes the tables kept so far, and tells how many; results that read them must be written before."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    n = len(_KEPT)
    while _KEPT:
        path = hadoop(_KEPT.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def cut(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` computed once, written as a table in the shared folder, and read from there: lineage ends.

    The rows outlive the executors that made them, and later plans scan only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    _KEPT.append(path)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer tasks than cores (a small file is one task) spread over the cores; a larger scan as it is."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


#: Tables on which work is done row by row, and which grow.
_GROWING = {"read_pairs", "documents"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in _GROWING else df
