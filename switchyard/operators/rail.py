"""Rail lines out of train calls: corridors, positions along the line, station order, figures of service."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Windows in minutes of the day.
PEAK, OFF_PEAK = [(420, 600), (1020, 1200)], [(660, 960)]


def first_match(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The name of the first rule that holds."""
    out = None
    for condition, name in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def calls_at(stations: Column, all_of: list[str] = (), any_of: list[str] = (), none_of: list[str] = ()) -> Column:
    """A set predicate over a train's stations."""
    out = F.lit(True)
    for s in all_of:
        out = out & F.array_contains(stations, s)
    if any_of:
        out = out & F.arrays_overlap(stations, F.array(*map(F.lit, any_of)))
    if none_of:
        out = out & ~F.arrays_overlap(stations, F.array(*map(F.lit, none_of)))
    return out


def station_positions(calls: DataFrame, hubs: DataFrame, passes: int = 6) -> DataFrame:
    """route_id, code, position: km from the route's hub, carried from train to train through stations they share.

    ``calls(route_id, trip_id, seq, code, km)``, ``hubs(route_id, hub)``. In each pass every train, in order of its
    id, takes its direction from the first and last of its stations that are placed, and places the others. A route
    is one group: its stations bound the state, its trains are walked in order.
    """

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        found = {rows["hub"].iloc[0]: 0.0}
        trains = [list(zip(t["code"], t["km"])) for _, t in rows.sort_values(["trip_id", "seq"]).groupby("trip_id", sort=True)]
        for _ in range(passes):
            before = len(found)
            for train in trains:
                at = dict(train)
                placed = [c for c in at if c in found]
                if not placed:
                    continue
                a, b = placed[0], placed[-1]
                if len(placed) > 1:
                    away = (at[b] - at[a]) * (found[b] - found[a]) >= 0
                else:
                    away = train[0][0] == a or at[a] == min(at.values())
                sign = 1 if away else -1
                for code, k in at.items():
                    found.setdefault(code, found[a] + sign * (k - at[a]))
            if len(found) == before:
                break
        return pd.DataFrame({"route_id": rows["route_id"].iloc[0], "code": list(found), "position": list(found.values())})

    kinds = dict(calls.dtypes)
    joined = calls.select("route_id", "trip_id", "seq", "code", F.coalesce(F.col("km").cast("double"), F.lit(0.0)).alias("km")).join(hubs, "route_id")
    return joined.groupBy("route_id").applyInPandas(place, f"route_id {kinds['route_id']}, code {kinds['code']}, position double")


def station_order(calls: DataFrame, positions: DataFrame) -> DataFrame:
    """route_id, code, place, cyclic: stations in an order that keeps every train's, ties by position, then code.

    Trains that run towards the hub count reversed. Stations that a cycle holds back follow, by position.
    Only distinct neighbours reach a route's task.
    """
    at = positions.withColumnRenamed("code", "_code")
    placed = calls.join(at, (calls["route_id"] == at["route_id"]) & (calls["code"] == at["_code"]), "left").select(calls["route_id"], "trip_id", "seq", "code", F.coalesce("position", F.lit(0.0)).alias("position"))
    whole = Window.partitionBy("route_id", "trip_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turned = placed.withColumn("_turn", F.last("position").over(whole) < F.first("position").over(whole))
    line = Window.partitionBy("route_id", "trip_id").orderBy(F.when(F.col("_turn"), -F.col("seq")).otherwise(F.col("seq")))
    pairs = turned.withColumn("after", F.lead("code").over(line)).select("route_id", "code", "position", "after").distinct()

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        key = {c: (p, c) for c, p in zip(rows["code"], rows["position"])}
        following: dict = {c: set() for c in key}
        waits = dict.fromkeys(key, 0)
        for a, b in zip(rows["code"], rows["after"]):
            if b is not None and b == b and b not in following[a]:
                following[a].add(b)
                waits[b] += 1
        order, ready = [], sorted((c for c, n in waits.items() if not n), key=key.get)
        while ready:
            now = ready.pop(0)
            order.append(now)
            for b in following[now]:
                waits[b] -= 1
                if not waits[b]:
                    ready.append(b)
            ready.sort(key=key.get)
        rest = sorted(set(key) - set(order), key=key.get)
        return pd.DataFrame({"route_id": rows["route_id"].iloc[0], "code": order + rest, "place": range(len(key)), "cyclic": [False] * len(order) + [True] * len(rest)})

    kinds = dict(calls.dtypes)
    return pairs.groupBy("route_id").applyInPandas(sort, f"route_id {kinds['route_id']}, code {kinds['code']}, place int, cyclic boolean")


def trimmed(order: DataFrame, ends: DataFrame) -> DataFrame:
    """``order(route_id, code, place)`` between the two terminals of ``ends(route_id, a, b)``, turned to run from a to b.

    A route without both terminals in its order stays whole. ``place`` runs from 0.
    """
    met = order.join(ends, "route_id", "left")
    whole = Window.partitionBy("route_id")
    met = met.withColumns({"_a": F.max(F.when(F.col("code") == F.col("a"), F.col("place"))).over(whole), "_b": F.max(F.when(F.col("code") == F.col("b"), F.col("place"))).over(whole)})
    has = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    kept = met.where(~has | F.col("place").between(F.least("_a", "_b"), F.greatest("_a", "_b")))
    new = F.when(has & (F.col("_a") > F.col("_b")), F.col("_a") - F.col("place")).when(has, F.col("place") - F.col("_a")).otherwise(F.col("place"))
    return kept.select("route_id", "code", new.alias("place"))


def running_minutes(calls: DataFrame, first: DataFrame) -> DataFrame:
    """route_id, direction, code, minutes: median (cut to whole minutes) from the departure at the first station.

    ``calls(route_id, direction, trip_id, code, arrival, departure)`` in unwrapped minutes, ``first(route_id, direction,
    first_code)``. Only trains that call at the first station count.
    """
    at_first = calls.join(first, ["route_id", "direction"]).where(F.col("code") == F.col("first_code"))
    starts = at_first.groupBy("route_id", "direction", "trip_id").agg(F.min("departure").alias("start"))
    timed = calls.join(starts, ["route_id", "direction", "trip_id"])
    return timed.groupBy("route_id", "direction", "code").agg(F.median(F.col("arrival") - F.col("start")).cast("int").alias("minutes"))


def busiest(calls: DataFrame, keys: list[str], column: str = "code") -> DataFrame:
    """The value with most rows for each key, the least of equals, and its ``n``."""
    counted = calls.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("least"), F.col(column).alias("name"))).alias("b"))
    return best.select(*keys, F.col("b.name").alias(column), (-F.col("b.least")).alias("n"))


def column_summary(calls: DataFrame, keys: list[str], minute: str) -> DataFrame:
    """first, last, n departures for each key."""
    return calls.groupBy(*keys).agg(F.min(minute).alias("first"), F.max(minute).alias("last"), F.count(minute).alias("n"))


def clip_report(trips: DataFrame, line: DataFrame) -> DataFrame:
    """route_id, trips, clipped, clip_ends, beyond of ``trips(route_id, codes, clipped)`` against ``line(route_id, stations)``.

    clip_ends are first and last stations of clipped trains; beyond counts trains with a station outside the line.
    """
    ends = F.when(F.col("clipped"), F.array(F.try_element_at("codes", F.lit(1)), F.try_element_at("codes", F.lit(-1)))).otherwise(F.array().cast("array<string>"))
    met = trips.join(line, "route_id", "left").withColumn("_ends", ends).withColumn("_beyond", F.size(F.array_except("codes", F.coalesce("stations", F.array().cast("array<string>")))) > 0)
    grouped = met.groupBy("route_id").agg(F.count(F.lit(1)).alias("trips"), F.count_if("clipped").alias("clipped"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("_ends")))).alias("clip_ends"), F.count_if("_beyond").alias("beyond"))
    return grouped


def longest_span(trips: DataFrame) -> DataFrame:
    """route_id, span_km: the longest way of a train from its first to its last call (``trips(route_id, first_km, last_km)``)."""
    km = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return trips.groupBy("route_id").agg(F.max(km("last_km") - km("first_km")).alias("span_km"))


def match_stations(stations: DataFrame, mapped: DataFrame, max_km: float = 3.0) -> DataFrame:
    """code, lat, lon, how of ``stations(code, name_key, lat, lon)`` against ``mapped(ref, name_key, lat, lon)``.

    By code; else the nearest of like name within ``max_km`` (degrees x 111, both alike); else its own position.
    """
    by_code = mapped.where("ref IS NOT NULL").groupBy(F.col("ref").alias("code")).agg(F.min(F.struct("lat", "lon")).alias("exact"))
    named = mapped.where("name_key <> ''").select("name_key", F.struct("lat", "lon").alias("there"))
    far = F.hypot(F.col("there.lat") - F.col("lat"), F.col("there.lon") - F.col("lon")) * 111
    near = stations.join(named, "name_key").withColumn("d", far).where(F.col("d") < max_km)
    near = near.groupBy("code").agg(F.min(F.struct("d", "there")).alias("n")).select("code", F.col("n.there").alias("near"))
    met = stations.join(by_code, "code", "left").join(near, "code", "left")
    at = F.coalesce("exact", "near", F.struct("lat", "lon"))
    how = F.when(F.col("exact").isNotNull(), "code").when(F.col("near").isNotNull(), "name").otherwise("own")
    return met.select("code", at["lat"].alias("lat"), at["lon"].alias("lon"), how.alias("how"))


def expanded_pairs(calls: DataFrame, asked: DataFrame) -> DataFrame:
    """u, v: neighbouring stations on any train that ``asked(u, v)`` doesn't hold in either order."""
    following = F.lead("code").over(Window.partitionBy("trip_id").orderBy("seq"))
    pairs = calls.withColumn("_n", following).where(F.col("_n").isNotNull() & (F.col("_n") != F.col("code"))).select(F.least("code", "_n").alias("u"), F.greatest("code", "_n").alias("v")).distinct()
    return pairs.join(asked.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), ["u", "v"], "left_anti")


def window_gaps(departures: DataFrame, keys: list[str], minute: str, windows: list[tuple[int, int]], least: int | None = None, most: int | None = None) -> DataFrame:
    """``headway``: median gap of neighbouring departures whose both ends lie in one window; gaps between bounds only."""
    w = Window.partitionBy(*keys).orderBy(minute)
    gaps = departures.withColumn("_from", F.lag(minute).over(w)).withColumn("_gap", F.col(minute) - F.col("_from"))
    inside = F.lit(False)
    for begin, end in windows:
        inside = inside | ((F.col("_from") >= begin) & (F.col(minute) <= end))
    kept = gaps.where(F.col("_gap").isNotNull() & inside)
    if least is not None:
        kept = kept.where((F.col("_gap") > least) & (F.col("_gap") < most))
    return kept.groupBy(*keys).agg(F.median("_gap").alias("headway"))


