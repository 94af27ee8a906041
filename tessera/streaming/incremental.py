"""Incremental runs: new files since the last run, processed once, with a status log beside the ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_texts(spark: SparkSession, path: str, suffix: str = "*.json") -> DataFrame:
    """``file_path, value`` of whole files that arrive below a folder."""
    reader = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", suffix).option("recursiveFileLookup", True)
    return reader.load(path).select(F.col("_metadata.file_path").alias("file_path"), "value")


def process_new(source: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, log: str, checkpoint: str, key: str = "file_path") -> StreamingQuery:
    """Process what is new and stop: results and a status log ``key, status, batch_id`` are appended per batch.

    A batch that is run again after a failure writes to the same batch folder, so nothing is counted twice.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        done = work(df).persist()
        done.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        ok = done.select(key).distinct().withColumn("ok", F.lit(True))
        status = df.select(key).distinct().join(ok, key, "left").select(key, F.when(F.col("ok"), 1).otherwise(2).alias("status"), F.lit(batch_id).alias("batch_id"))
        status.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        done.unpersist()
        df.unpersist()

    return source.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start()


def latest_status(spark: SparkSession, log: str, key: str = "file_path") -> DataFrame:
    return spark.read.parquet(log).groupBy(key).agg(F.max_by("status", "batch_id").alias("status"))
