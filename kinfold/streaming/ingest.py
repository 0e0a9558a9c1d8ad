"""Counts of strings kept up to date as files of catalogue rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.operators.ingest import cells, field_hash_counts, valid_records


def incremental_counts(spark: SparkSession, source: str, schema: T.StructType, record: str, target: str, checkpoint: str, files_per_batch: int = 10) -> DataFrame:
    """(hash, field, n) after all files there now; files of earlier calls with the same checkpoint are not read again.

    Each micro-batch writes its partial counts into a folder of its own batch number, overwriting what an interrupted
    attempt left there, so each file counts exactly once. The result adds the partial counts up.
    """

    def write(batch: DataFrame, number: int) -> None:
        field_hash_counts(cells(valid_records(batch, record), record)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.option("basePath", target).parquet(target).groupBy("hash", "field").agg(F.sum("n").alias("n"))


def windowed_arrivals(events: DataFrame, time: str, kind: str, value: str, window: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """(start, kind, n, total): arrivals by window of event time, for batch and stream alike; rows later than `late` are dropped by a stream's watermark."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    grouped = rows.groupBy(F.window(time, window).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return grouped.select(F.col("w.start").alias("start"), kind, "n", "total")
