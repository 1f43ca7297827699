"""One name for places far apart: contexts of a stop on its routes, and ids of their own for the far ones.

``calls(route_id, pos, stop_id)`` are the routes' stop lists, ``pos`` unique in a route, ``points(stop_id, lat, lon)``
the known positions. A stop that its routes see in several places keeps its id where its position (or most routes)
says, and every other place gets the id with the next free number behind it: ``gate``, ``gate_2``, ``gate_3`` ...

A round judges all stops by the same state. A stop whose evidence is another stop that would be split too waits for it
if the other's id is smaller: new ids have no position, so the next round judges by what is left. The smallest id never
waits and every split takes a route away from a stop, so the rounds end. Ids are minted from a stop's
own id and the numbers taken behind it, so no two tasks can mint the same one.

Ids are strings. Stops without a position, routes of one call and stops called at twice are all defined: a context is
that of the first call that has one; without any, a route says nothing of the stop and stays with its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.operators import validation
from switchyard.operators.clustering import first_fit
from switchyard.operators.validation import km
from switchyard.storage import materialize

# Kilometres between neighbours that agree, from a context to its group, from a position to a far context;
# stops to a close neighbour; passed tests that make a neighbour count.
AGREE_KM, SAME_KM, FAR_KM, FAR_AGREE_KM, CLOSE, SUPPORT = 6.0, 15.0, 15.0, 10.0, 2, 2


def _at(points: DataFrame) -> DataFrame:
    known = points.where("lat IS NOT NULL AND lon IS NOT NULL")
    return known.select(F.col("stop_id").cast("string").alias("stop_id"), F.struct("lat", "lon").alias("at"))


def _ready(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """``candidates(stop_id, ...)`` but those with a smaller candidate among ``evidence(stop_id, other)``."""
    waits = evidence.where("other < stop_id").join(candidates.select(F.col("stop_id").alias("other")).distinct(), "other", "left_semi")
    return candidates.join(waits.select("stop_id").distinct(), "stop_id", "left_anti")


def _calls(calls: DataFrame) -> DataFrame:
    return calls.select("route_id", "pos", F.col("stop_id").cast("string").alias("stop_id"))


def contexts(calls: DataFrame, points: DataFrame) -> DataFrame:
    """route_id, stop_id, lat, lon, beside (ids of the stops it is seen by): where a route sees a stop. Half way between the stops right before and after it, if
    they lie within six kilometres of each other; at a route's end, the one stop beside it."""
    w = Window.partitionBy("route_id").orderBy("pos")
    known = _at(points).select("stop_id", F.struct("at.lat", "at.lon", F.col("stop_id").alias("id")).alias("at"))
    rows = _calls(calls).join(known, "stop_id", "left")
    rows = rows.withColumns({"b": F.lag("at").over(w), "a": F.lead("at").over(w), "first": F.lag(F.lit(1)).over(w).isNull(), "last": F.lead(F.lit(1)).over(w).isNull()})
    b, a = F.col("b"), F.col("a")
    middle = F.struct(((b["lat"] + a["lat"]) / 2).alias("lat"), ((b["lon"] + a["lon"]) / 2).alias("lon"), F.array(b["id"], a["id"]).alias("beside"))
    one = lambda c: F.struct(c["lat"].alias("lat"), c["lon"].alias("lon"), F.array(c["id"]).alias("beside"))
    seen = F.when(km(b, a) <= AGREE_KM, middle).when(F.col("first") & a.isNotNull(), one(a)).when(F.col("last") & b.isNotNull(), one(b))
    met = rows.withColumn("seen", seen).where("seen IS NOT NULL").groupBy("route_id", "stop_id").agg(F.min_by("seen", "pos").alias("seen"))
    return met.select("route_id", "stop_id", "seen.*")


def _minted(wanted: DataFrame, calls: DataFrame, points: DataFrame) -> DataFrame:
    """``wanted(stop_id, nth)`` with ``new_id``: the nth number from 2 on that no id of the stop's form has yet."""
    ids = _calls(calls).select("stop_id").union(points.select(F.col("stop_id").cast("string"))).distinct()
    form = r"^(.*)_([1-9]\d{0,8})$"
    taken = ids.select(F.regexp_extract("stop_id", form, 1).alias("stop_id"), F.regexp_extract("stop_id", form, 2).alias("n"))
    taken = taken.where("n <> '' AND n <> '1'").groupBy("stop_id").agg(F.array_sort(F.collect_set(F.col("n").cast("long"))).alias("taken"))
    met = wanted.join(taken, "stop_id", "left")
    number = F.aggregate(F.coalesce("taken", F.array().cast("array<bigint>")), (F.col("nth") + 1).cast("long"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    return met.withColumn("new_id", F.concat("stop_id", F.lit("_"), number.cast("string"))).drop("taken")


def context_moves(calls: DataFrame, points: DataFrame) -> DataFrame:
    """stop_id, route_id, new_id, km: routes that see a stop over fifteen kilometres from where it stays.

    Contexts join, in the order of routes, the first group of the stop whose first context is within fifteen kilometres.
    The group nearest the stop's position keeps the id; without a position, the one of most routes.
    """
    seen = first_fit(contexts(calls, points), "stop_id", ["route_id"], SAME_KM * 1000, moving=False).withColumn("c", F.struct("lat", "lon"))
    seen = materialize(seen.select("stop_id", "route_id", "cluster", "c", "beside"), "homonym-contexts")
    groups = seen.groupBy("stop_id", "cluster").agg(F.count(F.lit(1)).alias("routes"), F.min_by("c", "route_id").alias("centre"))
    far = _ready(groups.where("cluster > 0").select("stop_id").distinct(), seen.select("stop_id", F.explode("beside").alias("other")))
    groups = groups.join(far, "stop_id", "left_semi").join(_at(points), "stop_id", "left")
    w = Window.partitionBy("stop_id").orderBy(F.coalesce(km(F.col("centre"), F.col("at")), -F.col("routes").cast("double")), "cluster")
    ranked = groups.withColumns({"nth": F.row_number().over(w) - 1, "home": F.first("centre").over(w)})
    moved = _minted(ranked.where("nth > 0").select("stop_id", "cluster", "nth", km(F.col("home"), F.col("centre")).alias("km")), calls, points)
    return seen.join(moved, ["stop_id", "cluster"]).select("stop_id", "route_id", "new_id", "km")


def tested_moves(calls: DataFrame, points: DataFrame) -> DataFrame:
    """stop_id, route_id, new_id, km: routes that a stop's position fails strongly while it fits others, and whose own
    neighbours, each passing two tests or more, place the stop fifteen kilometres away or farther.

    That is: located neighbours at most two calls away on both sides and within ten kilometres of each other; else one
    such neighbour. All such routes of a stop get one new id.
    """
    known = _at(points)
    plain = known.select("stop_id", "at.lat", "at.lon")
    results = materialize(validation.route_results(_calls(calls), plain), "homonym-results")
    routes = results.groupBy("stop_id", "route_id").agg(F.max("ok").alias("fits"), F.max(~F.col("ok") & F.col("strong")).alias("off"))
    fitting = routes.where("fits").select("stop_id").distinct()
    off = routes.where("off AND NOT fits").join(fitting, "stop_id", "left_semi").select("stop_id", "route_id")
    near = validation.neighbours(_calls(calls), plain).join(off, ["stop_id", "route_id"], "left_semi")
    first = near.groupBy("stop_id", "route_id").agg(F.min_by(F.struct("pos", "before", "after"), "pos").alias("n")).select("stop_id", "route_id", "n.*").join(known, "stop_id")
    col, sides = F.col, ("before", "after")
    measured = {f"{s}_close": F.coalesce(F.abs(col(f"{s}.pos") - col("pos")) <= CLOSE, F.lit(False)) for s in sides} | {f"{s}_km": km(col("at"), col(s)) for s in sides}
    # written, so that the distances are worked out once and not in every use below
    first = materialize(first.withColumns(measured | {"between_km": km(col("before"), col("after"))}), "homonym-measured")
    close, away = ({s: col(f"{s}_{what}") for s in sides} for what in ("close", "km"))
    both = close["before"] & close["after"] & (col("between_km") <= FAR_AGREE_KM) & (F.least(away["before"], away["after"]) >= FAR_KM)

    def pair(a: str, b: str) -> Column:
        return F.struct(col(f"{a}.stop_id").alias("a"), col(f"{b}.stop_id").alias("b"), F.least(away[a], away[b]).alias("km"))

    one = [close[s] & (away[s] >= FAR_KM) for s in sides]
    pick = F.when(both, pair("before", "after")).when(one[0], pair("before", "before")).when(one[1], pair("after", "after"))
    far = first.withColumn("p", pick).where("p IS NOT NULL").select("stop_id", "route_id", "p.*")
    good = validation.verdicts(results).where(col("passes") >= SUPPORT).select("stop_id")
    far = far.join(good.toDF("a"), "a", "left_semi").join(good.toDF("b"), "b", "left_semi")
    far = materialize(far, "homonym-far")
    far = _ready(far, far.select("stop_id", F.explode(F.array("a", "b")).alias("other")))
    minted = _minted(far.select("stop_id").distinct().withColumn("nth", F.lit(1)), calls, points).select("stop_id", "new_id")
    return far.join(minted, "stop_id").select("stop_id", "route_id", "new_id", "km")


def moved(calls: DataFrame, moves: DataFrame) -> DataFrame:
    """``calls`` with the new ids of the routes that moved."""
    met = calls.withColumn("stop_id", F.col("stop_id").cast("string")).join(moves.select("stop_id", "route_id", "new_id"), ["stop_id", "route_id"], "left")
    return met.withColumn("stop_id", F.coalesce("new_id", "stop_id")).select(*calls.columns)


def still_standing(calls: DataFrame, points: DataFrame, stops: DataFrame) -> DataFrame:
    """``points`` but those of ``stops`` that the routes left to them speak against; one that no route tests stays."""
    kept = _at(points)
    asked = kept.join(stops.select("stop_id").distinct(), "stop_id", "left_semi").select("stop_id", F.lit(0).alias("ord"), "at.lat", "at.lon")
    routes = calls.join(stops.select("stop_id").distinct(), "stop_id", "left_semi").select("route_id").distinct()
    near = calls.join(routes, "route_id", "left_semi")
    fallen = validation.verdicts(validation.route_results(near, kept.select("stop_id", "at.lat", "at.lon"), asked)).where("NOT accepted")
    return kept.select("stop_id", "at.lat", "at.lon").join(fallen, "stop_id", "left_anti")


def split(calls: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls with ids split, points that still stand, splits(stop_id, new_id, routes, km, by, round)).

    By contexts until no stop has two, then by tests; and again until a round of both splits nothing.
    """
    calls = materialize(_calls(calls), "homonym-calls")
    points = materialize(_at(points).select("stop_id", "at.lat", "at.lon"), "homonym-points")
    splits, number, quiet = None, 0, 0
    while quiet < 2:
        by, find = ("contexts", context_moves) if quiet == 0 or by == "tests" else ("tests", tested_moves)
        number += 1
        moves = materialize(find(calls, points), "homonym-moves")
        made = moves.groupBy("stop_id", "new_id").agg(F.count(F.lit(1)).alias("routes"), F.max("km").alias("km")).withColumns({"by": F.lit(by), "round": F.lit(number)})
        if moves.take(1):
            calls = materialize(moved(calls, moves), "homonym-calls")
            if by == "contexts":
                points = materialize(still_standing(calls, points, moves), "homonym-points")
            splits, quiet = made if splits is None else splits.unionByName(made), 0
        else:
            quiet += 1
    return calls, points, made if splits is None else splits
