"""Departures as an event stream: counts and headways in windows, with late events dropped behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_departures(spark: SparkSession, folder: str, schema: str, *, files_a_trigger: int = 100) -> DataFrame:
    """Parquet files of a growing folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def headways(departures: DataFrame, *, time: str = "ts", keys: list[str], window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """start, keys, n, first, last, headway_s for each window: the mean gap of its departures in seconds.

    Works on a stream and on a table alike. On a stream a window is final once the latest time seen is ``late`` past its
    end; events behind that are dropped, which bounds the state to the open windows of the keys. A window of one
    departure has no headway; events without a time fall out.
    """
    timed = departures.where(F.col(time).isNotNull())
    if timed.isStreaming:
        timed = timed.withWatermark(time, late)
    seconds = F.unix_micros(F.col(time)) / 1e6
    grouped = timed.groupBy(F.window(time, window).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("first"), F.max(time).alias("last"), F.min(seconds).alias("_a"), F.max(seconds).alias("_b"))
    gap = F.when(F.col("n") > 1, (F.col("_b") - F.col("_a")) / (F.col("n") - 1))
    return grouped.select(F.col("w.start").alias("start"), *keys, "n", "first", "last", gap.alias("headway_s"))


def write_final(stream: DataFrame, folder: str, checkpoint: str):
    """Final windows appended to Parquet files, all that is there in one go; returns the query."""
    return stream.writeStream.outputMode("append").format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
