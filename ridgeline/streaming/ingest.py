"""Resumable incremental ingest with Structured Streaming: each file once, whatever fails in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str, transform=None) -> None:
    """Reads new Parquet files of a folder and adds them to a target folder, then stops. The checkpoint is the done manifest; a
    restart goes on where the last run ended, and a batch that is run again replaces its own folder `batch=<number>`. Of
    repeated keys within a batch one row is written; no state is kept between batches.
    """

    def write(rows: DataFrame, number: int) -> None:
        rows.dropDuplicates([key]).write.mode("overwrite").parquet(f"{target}/batch={number}")

    rows = spark.readStream.schema(schema).parquet(source)
    rows = transform(rows) if transform else rows
    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def progress_changes(rows: DataFrame, key: str, value: str, time: str, late: str = "10 minutes") -> DataFrame:
    """A progress stream that emits a value of a key once while it is at most `late` old; state older than that is dropped."""
    return rows.select(key, value, time).where(F.col(value).isNotNull()).withWatermark(time, late).dropDuplicatesWithinWatermark([key, value])
