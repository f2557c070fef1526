"""The stateless read filter, and deliveries by window, over newly landed read pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from readloom.operators.kmers import mark_reads

#: The state store that holds more than memory does.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_pairs(spark, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(path)


def stream_filter(pairs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Newly landed pairs of which a mate holds a wanted k-mer; the k-mers are fixed when the stream starts."""
    return mark_reads(pairs, wanted, k).where("hit").drop("hit")


def deliveries(pairs: DataFrame, *, window: str = "1 hour", late: str = "2 days") -> DataFrame:
    """``(source, start, n)``: rows received by source and window; rows later than ``late`` are not waited for."""
    timed = pairs.where("received_at is not null").withColumn("at", F.col("received_at").cast("timestamp")).withWatermark("at", late)
    counted = timed.groupBy("source", F.window("at", window).alias("w")).agg(F.count("*").alias("n"))
    return counted.select("source", F.col("w.start").alias("start"), "n")


def first_deliveries(pairs: DataFrame) -> DataFrame:
    """The first row of each read_id as it lands, whatever its time; later deliveries are dropped, however late.

    Every read_id seen stays in the state, which RocksDB keeps on the executors' disks.
    """
    pairs.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return pairs.where("read_id is not null").dropDuplicates(["read_id"])


def land(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that is there now, written once; a restart goes on where the checkpoint ends."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
