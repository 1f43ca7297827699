"""Connected components of an edge list, as alternating star contractions.

Each round is two grouped minima and two equi-joins, so it needs no per-node
state on one machine; the number of rounds is logarithmic in practice. Node ids
may be of any orderable type. The round's edges go to shared storage, so the
plan does not grow and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchyard.storage import discard, materialize


def _canonical(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, from the larger node ``u`` to the smaller ``v``."""
    return (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour that is larger than a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("low"))
    return both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    joined = edges.join(low, "u")
    return joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select("u", F.col("low").alias("v")))


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Nodes of ``edges(u, v)`` with the smallest node of their component.

    Returns ``node, component`` for every node that has an edge to another
    node. Nulls and self-loops are dropped; no edge gives an empty result.
    Raises if ``max_rounds`` do not suffice rather than return wrong classes.
    """
    now = materialize(_canonical(edges.select("u", "v").where("u IS NOT NULL AND v IS NOT NULL")), "cc")
    seen = _print_of(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        following = materialize(_canonical(_small_star(_canonical(_large_star(now)))), "cc")
        mark = _print_of(following)
        discard(now)
        now, before, seen = following, seen, mark
        if before == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
