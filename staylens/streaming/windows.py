"""Streams of events and of landed review files. An extension: the batch operators on an unbounded input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def hourly(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Counts and sums by hour and type; the state of an hour goes once the watermark has passed it."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def hourly_batch(events: DataFrame) -> DataFrame:
    """The same aggregation on a table, in plain columns."""
    found = hourly(events)
    return found.select(F.date_format("window.start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).parquet(folder)


def first_seen(reviews: DataFrame, late: str = "31 days") -> DataFrame:
    """Reviews without those whose user and text came before within the watermark (event time column ``at``)."""
    return reviews.withWatermark("at", late).dropDuplicatesWithinWatermark(["review_name", "text"])


def each_batch(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Applies a batch operator to every micro-batch and appends its rows; a repeated batch rewrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
