"""The driver's tables in transit roles, with positions derived from keys.

orders are trips, lineitem their stop times, supplier the stops, nation the
agencies, part the names, events the departures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS, ORDER = ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lat_of(key: Column) -> Column:
    return F.lit(22.3) + (key * 7919 % 8000) / F.lit(10000.0)


def lon_of(key: Column) -> Column:
    return F.lit(88.0) + (key * 104729 % 7000) / F.lit(10000.0)


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("stop_id"), "s_name", "s_nationkey", lat_of(F.col("s_suppkey")).alias("lat"), lon_of(F.col("s_suppkey")).alias("lon"))


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop times with their stop's position: derived from the key, so no join is needed."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.withColumns({"lat": lat_of(F.col("l_suppkey")), "lon": lon_of(F.col("l_suppkey"))})


def departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "ts", (F.hour("ts") * 60 + F.minute("ts")).alias("minute"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))


# The same in SQL
LAT = "(CAST(22.3 AS DOUBLE) + (({k}) * 7919 % 8000) / CAST(10000 AS DOUBLE))"
LON = "(CAST(88.0 AS DOUBLE) + (({k}) * 104729 % 7000) / CAST(10000 AS DOUBLE))"


def sql_haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = f"(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))"
    return f"(2 * 6371000.0 * asin(CASE WHEN {h} > 1 THEN CAST(1 AS DOUBLE) ELSE sqrt({h}) END))"


SQL_STOPS = f"stops AS (SELECT s_suppkey AS stop_id, s_name, s_nationkey, {LAT.format(k='s_suppkey')} AS lat, {LON.format(k='s_suppkey')} AS lon FROM supplier)"
SQL_TIMES = f"times AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {LAT.format(k='l_suppkey')} AS lat, {LON.format(k='l_suppkey')} AS lon FROM lineitem)"
SQL_ORDER = "PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey"
SQL_DEPARTURES = "deps AS (SELECT event_id, user_id, event_type, ts, CAST(hour(ts) * 60 + minute(ts) AS BIGINT) AS minute, epoch_us(ts) AS us FROM events)"
