"""Bounded iterative searches: least-cost paths and round-based journeys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.storage import discard, materialize


def shortest_costs(sources: DataFrame, edges: DataFrame, limit: int, max_rounds: int = 200) -> DataFrame:
    """node, cost from any of ``sources(node)`` over ``edges(src, dst, w)``, costs up to ``limit``.

    Min-plus relaxation: only nodes whose cost fell go on, and each round is written.
    """
    best = materialize(sources.select("node", F.lit(0).cast("long").alias("cost")).distinct(), "path")
    front = best
    for _ in range(max_rounds):
        step = front.join(edges, front["node"] == edges["src"]).select(F.col("dst").alias("node"), (F.col("cost") + F.col("w")).cast("long").alias("cost"))
        step = step.where(F.col("cost") <= limit).groupBy("node").agg(F.min("cost").alias("cost"))
        old = best.select("node", F.col("cost").alias("_old"))
        both = materialize(old.join(step, "node", "full").select("node", F.least("cost", "_old").alias("cost"), (F.col("_old").isNull() | (F.col("cost") < F.col("_old"))).alias("fell")), "path")
        discard(best)
        best, front = both.select("node", "cost"), both.where("fell").select("node", "cost")
        best._stored_at = both._stored_at
        if not front.take(1):
            return best
    raise RuntimeError(f"paths did not settle in {max_rounds} rounds")


def boarding(headway: Column, penalty: Column | int = 0) -> Column:
    """Cost of boarding a pattern: half its headway in minutes, 15 at most, 3 more and the route's penalty."""
    return F.least(headway / 2, F.lit(15.0)) + 3 + penalty


def ride_round(labels: DataFrame, pattern_stops: DataFrame, board_cost: int | str) -> DataFrame:
    """One round of rides: board a pattern at any labelled stop, alight at any later one.

    ``labels(stop, cost)``, ``pattern_stops(pattern, pos, stop, minutes)``; returns the improved labels.
    ``board_cost`` is one cost for all, or the column of ``pattern_stops`` that holds each pattern's (see :func:`boarding`).
    Only patterns that a labelled stop touches are scanned.
    """
    touched = pattern_stops.join(labels, "stop", "left_semi").select("pattern").distinct()
    scan = pattern_stops.join(touched, "pattern", "left_semi").join(labels, "stop", "left")
    w = Window.partitionBy("pattern").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    board = F.col(board_cost) if isinstance(board_cost, str) else F.lit(board_cost)
    base = F.min(F.col("cost") + board - F.col("minutes")).over(w)
    arrive = scan.withColumn("new", base + F.col("minutes")).where("new IS NOT NULL").select("stop", F.col("new").alias("cost"))
    return labels.unionByName(arrive).groupBy("stop").agg(F.min("cost").alias("cost"))


def walk_round(labels: DataFrame, footpaths: DataFrame, weight: int = 2) -> DataFrame:
    """Walks from every label over ``footpaths(a, b, minutes)``, all from the labels before the walk."""
    walked = labels.join(footpaths, labels["stop"] == footpaths["a"]).select(F.col("b").alias("stop"), (F.col("cost") + weight * F.col("minutes")).alias("cost"))
    return labels.unionByName(walked).groupBy("stop").agg(F.min("cost").alias("cost"))
