"""Windowed aggregates over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, pattern: str = "events.parquet", files_each: int = 1) -> DataFrame:
    """A folder's events as a stream, with time-zoned timestamps, which watermarks ask for."""
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_each).parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; state older than the watermark is dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")
