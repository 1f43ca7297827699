"""Frequency windows and headways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed values of the feed.
PEAKS = [(7 * 3600, 10 * 3600), (17 * 3600, 20 * 3600)]
DAY, END_PAD = 86_400, 60


def is_peak(second: Column) -> Column:
    out = F.lit(False)
    for start, end in PEAKS:
        out = out | ((second >= start) & (second < end))
    return out


def frequency_windows(df: DataFrame, keys: list[str], first: str, last: str, peak_s: str, off_s: str) -> DataFrame:
    """keys, start_s, end_s, headway_s: the service window cut at peak edges, equal neighbours joined.

    A last service not after the first is on the next day; the end has a minute's pad.
    A missing headway takes the other side's.
    """
    a = F.col(first)
    b = F.when(F.col(last) <= a, F.col(last) + DAY).otherwise(F.col(last)) + END_PAD
    edges = F.filter(F.array(*[F.lit(x) for p in PEAKS for x in p]), lambda x: (x > a) & (x < b))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(a, b), edges)))
    starts = df.withColumn("_cuts", cuts).select(*keys, F.coalesce(peak_s, off_s).alias("_p"), F.coalesce(off_s, peak_s).alias("_o"), "_cuts", F.posexplode(F.slice("_cuts", 1, F.size("_cuts") - 1)).alias("_i", "start_s"))
    parts = starts.select(*keys, "start_s", F.col("_cuts")[F.col("_i") + 1].alias("end_s"), F.when(is_peak(F.col("start_s")), F.col("_p")).otherwise(F.col("_o")).alias("headway_s"))
    w = Window.partitionBy(*keys).orderBy("start_s")
    marked = parts.withColumn("_new", F.coalesce((F.col("headway_s") != F.lag("headway_s").over(w)).cast("int"), F.lit(1)))
    islands = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "_island").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.first("headway_s").alias("headway_s")).drop("_island")


def departures(start: Column, end: Column, headway: Column) -> Column:
    return F.floor((end - start) / headway)


def mean_headway(peak: Column, off: Column) -> Column:
    """Mean of the headways that are known, in tenths (integer)."""
    total = F.coalesce(peak, F.lit(0)) + F.coalesce(off, F.lit(0))
    known = peak.isNotNull().cast("int") + off.isNotNull().cast("int")
    return F.floor(total * 10 / F.nullif(known, F.lit(0))).cast("long")


def span_headway(first: Column, last: Column, n: Column, least: float = 30.0, most: float = 240.0) -> Column:
    """Span over count within limits; a single trip gives the upper one."""
    return F.when(n <= 1, F.lit(most)).otherwise(F.least(F.greatest((last - first) / n, F.lit(least)), F.lit(most)))
