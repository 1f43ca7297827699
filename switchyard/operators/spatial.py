"""Spatial joins on a grid: explode the cells near one side, equi-join, then measure.

The distance condition alone would plan as a nested loop over all pairs. With cell
keys it is an equi-join whose rows are near each other already; AQE splits dense cells.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchyard.functions.geo import grid_cell, haversine_m
from switchyard.storage import discard, materialize

_M_PER_DEGREE = 111_195.0


def radius_join(left: DataFrame, right: DataFrame, metres: float, *, on: list[str] | None = None, max_lat: float = 60.0) -> DataFrame:
    """Pairs of ``left(id, lat, lon, ...)`` and ``right(id2, lat2, lon2, ...)`` within ``metres``, with ``distance_m``.

    Both sides' other columns stay; columns ``on`` of both sides must be equal too. Positions must lie within
    ``max_lat`` degrees of the equator.
    """
    size = metres / _M_PER_DEGREE / math.cos(math.radians(max_lat))
    near = [F.lit(d) for d in (-1, 0, 1)]
    a = left.withColumns({"_x": grid_cell(F.col("lat"), size), "_y": grid_cell(F.col("lon"), size)})
    b = right.withColumns({"_x": grid_cell(F.col("lat2"), size), "_y": grid_cell(F.col("lon2"), size)})
    b = b.withColumn("_dx", F.explode(F.array(*near))).withColumn("_dy", F.explode(F.array(*near)))
    b = b.withColumns({"_x": F.col("_x") + F.col("_dx"), "_y": F.col("_y") + F.col("_dy")}).drop("_dx", "_dy")
    pairs = a.join(b, ["_x", "_y", *(on or [])]).drop("_x", "_y")
    return pairs.withColumn("distance_m", haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))).where(F.col("distance_m") <= metres)


def nearest(pairs: DataFrame, key: str, *best: str) -> DataFrame:
    """Of joined pairs, the one of least ``best`` columns for each ``key`` (partial aggregation, no sort)."""
    others = [c for c in pairs.columns if c != key]
    rank = F.struct(*best, *[c for c in others if c not in best])
    return pairs.groupBy(key).agg(F.min(rank).alias("_best")).select(key, *[F.col("_best")[c].alias(c) for c in others])


def snap_with_slack(pairs: DataFrame, key: str, slack_m: float) -> DataFrame:
    """Of joined pairs, all that are within ``slack_m`` of the key's nearest."""
    least = pairs.groupBy(key).agg(F.min("distance_m").alias("_least"))
    return pairs.join(least, key).where(F.col("distance_m") <= F.col("_least") + slack_m).drop("_least")


def thinned(points: DataFrame, order: list[str], metres: float, key: list[str] | None = None) -> DataFrame:
    """Rows of ``points(lat, lon, ...)`` without an earlier kept one (of the same ``key``) within ``metres``.

    ``order`` is a total order. The rows kept are those of a walk in that order, found by rounds: a row that has no
    earlier neighbour left stays, its later neighbours go. Pairs are those within ``metres``, by grid.
    """
    key = key or []
    place = F.struct(*order)
    a = points.select(*key, place.alias("_a"), "lat", "lon")
    b = points.select(*[F.col(k).alias(f"_{k}2") for k in key], place.alias("_b"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    near = radius_join(a, b, metres).where(F.col("_a") < F.col("_b"))
    for k in key:
        near = near.where(F.col(k).eqNullSafe(F.col(f"_{k}2")))
    pairs = materialize(near.select("_a", "_b"), "thinned-pairs")
    gone = pairs.select("_b").limit(0)
    left = pairs
    while left.take(1):
        first = left.select("_a").join(left.select(F.col("_b").alias("_a")).distinct(), "_a", "left_anti").distinct()
        lost = materialize(left.join(first, "_a", "left_semi").select("_b").distinct(), "thinned-lost")
        gone = gone.unionByName(lost)
        # a row that went takes nothing with it; one that stays has done its work
        rest = left.join(first, "_a", "left_anti").join(lost, "_b", "left_anti").join(lost.select(F.col("_b").alias("_a")), "_a", "left_anti")
        last, left = left, materialize(rest, "thinned-pairs")
        discard(last)
    return points.withColumn("_b", place).join(gone, "_b", "left_anti").drop("_b")
