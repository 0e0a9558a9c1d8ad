"""The streaming twin of the ingest counts, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.plans import ingest_queries as base
from kinfold.plans.tables import table
from kinfold.scratch import Scratch
from kinfold.streaming.ingest import incremental_counts, windowed_arrivals


def stream_field_hash_counts(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "stream")
    # a pattern, as the table may be a file or a folder of files
    return incremental_counts(spark, f"{d}/catalog_records.parque[t]", table(spark, d, "catalog_records").schema, "personid", f"{scratch.root}/partial", f"{scratch.root}/progress")


def hourly_arrivals(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = windowed_arrivals(e, "ts", "event_type", "value")
    return w.select(F.unix_seconds("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (stream_field_hash_counts, hourly_arrivals)}
SQL: dict[str, str] = {
    "stream_field_hash_counts": base.SQL["field_hash_counts"],
    "hourly_arrivals": "SELECT (epoch_us(ts) // 3600000000) * 3600 AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
}
