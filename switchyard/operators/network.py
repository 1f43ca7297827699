"""Networks out of feeds and maps: patterns and their variants, track graphs, paths on track, hop shapes, areas."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.functions.geo import haversine_m
from switchyard.functions.lines import encode_polyline, simplify
from switchyard.functions.names import place_key
from switchyard.operators.clustering import first_fit
from switchyard.operators.spatial import nearest, radius_join, snap_with_slack

# Cost of service track, tolerances in metres and factors of the straight way.
SERVICE_COST, SNAP_M, SNAP_SLACK_M, DETOUR, DETOUR_M, SIMPLIFY_M = 3.0, 800.0, 120.0, 2.0, 1000.0, 6.0
VARIANTS, LEAST_HEADWAY, MOST_HEADWAY = 3, 30.0, 240.0
MODE_RANK = {"rail": 6, "metro": 5, "ferry": 4, "tram": 3, "bus": 2, "minibus": 2, "auto": 1}


def track_edges(ways: DataFrame) -> DataFrame:
    """mode, src, dst, w of ``ways(mode, service, nodes)`` with nodes as struct(id, lat, lon): both ways, in metres, service track dearer."""
    steps = ways.select("mode", "service", F.explode(F.arrays_zip(F.slice("nodes", 1, F.size("nodes") - 1).alias("a"), F.slice("nodes", 2, F.size("nodes")).alias("b"))).alias("s"))
    metres = haversine_m(F.col("s.a.lat"), F.col("s.a.lon"), F.col("s.b.lat"), F.col("s.b.lon"))
    one = steps.select("mode", F.col("s.a.id").alias("src"), F.col("s.b.id").alias("dst"), (metres * F.when(F.col("service"), SERVICE_COST).otherwise(1.0)).alias("w"))
    both = one.unionByName(one.select("mode", F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.groupBy("mode", "src", "dst").agg(F.min("w").alias("w"))


def shortest_paths(tasks: DataFrame, edges: DataFrame) -> DataFrame:
    """task, path, cost: the least-cost path from any source to any target of each task, up to its limit.

    ``tasks(task, region, sources, targets, limit)``, ``edges(region, src, dst, w)``. Regions are independent graphs
    of bounded size (a mode's track); all tasks of a region share one task of Spark. A task without a path gives no row.
    """
    node, task = (dict(t.dtypes)[c] for t, c in ((edges, "src"), (tasks, "task")))

    def run(key: tuple, asked: pd.DataFrame, graph: pd.DataFrame) -> pd.DataFrame:
        near: dict = {}
        for a, b, w in zip(graph["src"], graph["dst"], graph["w"]):
            near.setdefault(a, []).append((b, w))
        out = []
        for name, sources, targets, limit in zip(asked["task"], asked["sources"], asked["targets"], asked["limit"]):
            goal, cost, came = set(targets), dict.fromkeys(sorted(sources), 0.0), {}
            queue = [(0.0, s) for s in cost]
            while queue:
                c, u = heapq.heappop(queue)
                if c > cost[u]:
                    continue
                if u in goal:
                    path = [u]
                    while path[-1] in came:
                        path.append(came[path[-1]])
                    out.append((name, path[::-1], c))
                    break
                if c > limit:
                    continue
                for v, w in near.get(u, ()):
                    if c + w < cost.get(v, float("inf")):
                        cost[v], came[v] = c + w, u
                        heapq.heappush(queue, (c + w, v))
        return pd.DataFrame(out, columns=["task", "path", "cost"])

    return tasks.groupBy("region").cogroup(edges.groupBy("region")).applyInPandas(run, f"task {task}, path array<{node}>, cost double")


def hop_shapes(hops: DataFrame, stops: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """mode, a, b, shape: an encoded line on track for each undirected hop that has one.

    ``hops(mode, a, b)`` of ``stops(stop, lat, lon)``; ``nodes(mode, node, lat, lon)`` of ``edges(mode, src, dst, w)``.
    Ends snap to all nodes within 120 m of the nearest (800 m at most); hops whose ends share a node, or whose way on
    track is over twice the straight one and a kilometre, get none.
    """
    pairs = hops.select("mode", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    used = pairs.select("mode", F.explode(F.array("a", "b")).alias("stop")).distinct().join(stops, "stop")
    near = radius_join(used.withColumn("key", F.struct("mode", "stop")), nodes.select(F.col("mode").alias("mode2"), "node", F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), SNAP_M, max_lat=30.0).where("mode = mode2")
    snapped = snap_with_slack(near, "key", SNAP_SLACK_M).groupBy("mode", "stop").agg(F.sort_array(F.collect_set("node")).alias("ends"))
    at = stops.select("stop", F.struct("lat", "lon").alias("at"))
    end = lambda c: snapped.select("mode", F.col("stop").alias(c), F.col("ends").alias(f"{c}_ends")).join(at.select(F.col("stop").alias(c), F.col("at").alias(f"{c}_at")), c)
    asked = pairs.join(end("a"), ["mode", "a"]).join(end("b"), ["mode", "b"]).where(~F.arrays_overlap("a_ends", "b_ends"))
    straight = haversine_m(F.col("a_at.lat"), F.col("a_at.lon"), F.col("b_at.lat"), F.col("b_at.lon"))
    asked = asked.withColumn("most", straight * DETOUR + DETOUR_M)
    tasks = asked.select(F.to_json(F.struct("mode", "a", "b")).alias("task"), F.col("mode").alias("region"), F.col("a_ends").alias("sources"), F.col("b_ends").alias("targets"), (F.col("most") * SERVICE_COST).alias("limit"))
    paths = shortest_paths(tasks, edges.withColumnRenamed("mode", "region"))
    along = paths.select("task", F.posexplode("path").alias("i", "node"))
    asked = asked.withColumn("task", F.to_json(F.struct("mode", "a", "b")))
    placed = along.join(asked.select("task", "mode"), "task").join(nodes, ["mode", "node"]).groupBy("task").agg(F.array_sort(F.collect_list(F.struct("i", "lat", "lon"))).alias("points"))
    line = F.concat(F.array("a_at"), F.transform("points", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))), F.array("b_at"))
    met = asked.join(placed, "task").withColumn("line", line)
    inner = lambda i: haversine_m(F.get("points", i)["lat"], F.get("points", i)["lon"], F.get("points", i + 1)["lat"], F.get("points", i + 1)["lon"])
    real = F.when(F.size("points") > 1, F.aggregate(F.transform(F.sequence(F.lit(0), F.size("points") - 2), inner), F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)
    return met.where(real <= F.col("most")).select("mode", "a", "b", encode_polyline(simplify(F.col("line"), SIMPLIFY_M)).alias("shape"))


def variants(trips: DataFrame, main: DataFrame, most: int = VARIANTS) -> DataFrame:
    """route, direction, stops, n, headway, minutes: patterns that the main one doesn't cover, most frequent first.

    ``trips(route, direction, trip, stops, minutes)``, ``main(route, direction, stops)``. A pattern within a more
    frequent kept one adds nothing. Its minutes are those of the upper median trip by duration, its headway the span of departures
    by their number, 30 to 240 minutes. Only patterns, not trips, reach a direction's fold.
    """
    outside = trips.join(main.withColumnRenamed("stops", "main_stops"), ["route", "direction"], "left").where(F.size(F.array_except("stops", F.coalesce("main_stops", F.array().cast(dict(trips.dtypes)["stops"])))) > 0)
    first, last = F.element_at("minutes", 1), F.element_at("minutes", -1)
    by_length = Window.partitionBy("route", "direction", "stops").orderBy(last - first, "trip")
    placed = outside.withColumns({"_n": F.row_number().over(by_length) - 1, "_all": F.count(F.lit(1)).over(Window.partitionBy("route", "direction", "stops"))})
    median = F.max(F.when(F.col("_n") == F.floor(F.col("_all") / 2), F.col("minutes")))
    grouped = placed.groupBy("route", "direction", "stops").agg(F.count(F.lit(1)).alias("n"), (F.max(first) - F.min(first)).alias("span"), median.alias("minutes"))
    headway = F.when(F.col("n") > 1, F.least(F.greatest(F.lit(LEAST_HEADWAY), F.col("span") / F.col("n")), F.lit(MOST_HEADWAY))).otherwise(MOST_HEADWAY)
    listed = grouped.withColumn("headway", F.bround(headway, 0)).groupBy("route", "direction").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "stops", "headway", "minutes"))).alias("all"))
    covered = lambda out, p: F.exists(out, lambda k: F.size(F.array_except(p["stops"], k["stops"])) == 0)
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda out, p: F.when(covered(out, p) | (F.size(out) >= most), out).otherwise(F.concat(out, F.array(p))))
    return listed.select("route", "direction", F.inline(kept)).select("route", "direction", "stops", (-F.col("less")).alias("n"), "headway", F.transform("minutes", lambda m: m - F.element_at("minutes", 1)).alias("minutes"))


def dense_transfers(transfers: DataFrame, index: DataFrame) -> DataFrame:
    """a, b, minutes of ``transfers(from_stop, to_stop, minutes)`` by the stops' numbers in ``index(stop, number)``; both ends must be there."""
    end = lambda c, n: index.select(F.col("stop").alias(c), F.col("number").alias(n))
    return transfers.join(end("from_stop", "a"), "from_stop").join(end("to_stop", "b"), "to_stop").select("a", "b", "minutes")


def area_hints(places: DataFrame, areas: DataFrame, max_m: float = 3000.0, town_factor: float = 1.6) -> DataFrame:
    """id, area: the nearest area of each place within 3 km; a town counts as 1.6 times as far.

    ``places(id, name, lat, lon)``, ``areas(area, area_name, is_town, lat, lon)``. Not the place itself, nor an area
    whose key is in the place's.
    """
    right = areas.select("area", "area_name", "is_town", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    pairs = radius_join(places, right, max_m, max_lat=30.0)
    far = F.col("distance_m") * F.when(F.col("is_town"), town_factor).otherwise(1.0)
    pairs = pairs.where((F.col("id") != F.col("area")) & ~F.contains(place_key(F.col("name")), place_key(F.col("area_name"))))
    return nearest(pairs.withColumn("far", far).where(F.col("far") < max_m).select("id", "far", "area"), "id", "far", "area").select("id", "area")


def without_near(places: DataFrame, stops: DataFrame, metres: float) -> DataFrame:
    """``places(id, key, lat, lon)`` without those that have a stop of the same key within ``metres``."""
    right = stops.select("key", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    close = radius_join(places.select("id", "key", "lat", "lon"), right, metres, on=["key"]).select("id").distinct()
    return places.join(close, "id", "left_anti")


def in_region(places: DataFrame, stops: DataFrame, core: tuple[float, float, float, float], metres: float = 4000.0) -> DataFrame:
    """``places(id, lat, lon)`` in the core box (south, west, north, east), or within ``metres`` of a stop."""
    south, west, north, east = core
    inside = places.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    outside = places.where(~(F.col("lat").between(south, north) & F.col("lon").between(west, east)))
    near = radius_join(outside.select("id", "lat", "lon"), stops.select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), metres, max_lat=30.0).select("id").distinct()
    return inside.unionByName(outside.join(near, "id", "left_semi"))


def named_lengths(ways: DataFrame, least_m: float = 1000.0) -> DataFrame:
    """name, metres of ``ways(name, points)`` with points as struct(lat, lon): summed by name, short ones out."""
    leg = lambda i: haversine_m(F.get("points", i)["lat"], F.get("points", i)["lon"], F.get("points", i + 1)["lat"], F.get("points", i + 1)["lon"])
    metres = F.when(F.size("points") > 1, F.aggregate(F.transform(F.sequence(F.lit(0), F.size("points") - 2), leg), F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)
    return ways.groupBy("name").agg(F.sum(metres).alias("metres")).where(F.col("metres") >= least_m)


def stop_groups(stops: DataFrame, radius_m: float = 1000.0) -> DataFrame:
    """name, group, lat, lon, modes, n: stops of one lower-cased name within a kilometre, at their highest-ranked stop.

    ``stops(stop, name, lat, lon, modes)``; groups form in order of ``stop``.
    """
    rank = F.create_map(*[F.lit(x) for pair in MODE_RANK.items() for x in pair])
    best = F.coalesce(F.array_max(F.transform("modes", lambda m: F.coalesce(rank[m], F.lit(0)))), F.lit(0))
    keyed = stops.withColumns({"key": F.lower("name"), "rank": best})
    grouped = first_fit(keyed, "key", ["stop"], radius_m, moving=False)
    top = F.min(F.struct((-F.col("rank")).alias("r"), "stop", "lat", "lon", "name"))
    out = grouped.groupBy("key", "cluster").agg(top.alias("t"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("modes")))).alias("modes"), F.count(F.lit(1)).alias("n"))
    return out.select(F.col("t.name").alias("name"), F.col("t.lat").alias("lat"), F.col("t.lon").alias("lon"), "modes", "n")


def way_order(platforms: DataFrame, chain: DataFrame, max_km: float = 0.3, least_points: int = 10) -> DataFrame:
    """route, stop, place: platforms by the nearest point of the route's way chain.

    ``platforms(route, stop, place, lat, lon)``, ``chain(route, i, lat, lon)``. A route whose chain is short, or with
    a platform further than ``max_km`` off, keeps its order.
    """
    points = chain.select("route", "i", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    pairs = platforms.join(points, "route").withColumn("d", haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")))
    near = pairs.groupBy("route", "stop", "place").agg(F.min(F.struct("d", "i")).alias("n"), F.count(F.lit(1)).alias("points"))
    whole = Window.partitionBy("route")
    met = platforms.join(near, ["route", "stop", "place"], "left")
    good = F.min(F.coalesce((F.col("n.d") <= max_km * 1000) & (F.col("points") >= least_points), F.lit(False))).over(whole)
    met = met.withColumn("_good", good)
    key = F.when(F.col("_good"), F.col("n.i")).otherwise(F.lit(0))
    return met.select("route", "stop", F.row_number().over(whole.orderBy(key, "place")).alias("place"))


def stops_along(line: DataFrame, points: DataFrame, metres: float = 40.0) -> DataFrame:
    """route, point, d: points within ``metres`` of a vertex of the route's line, by distance from its first vertex.

    ``line(route, i, lat, lon)``, ``points(point, lat, lon)``.
    """
    near = radius_join(points, line.select("route", "i", F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), metres, max_lat=30.0).select("route", "point", "lat", "lon").distinct()
    start = line.groupBy("route").agg(F.min(F.struct("i", "lat", "lon")).alias("s"))
    far = haversine_m(F.col("lat"), F.col("lon"), F.col("s.lat"), F.col("s.lon"))
    return near.join(start, "route").select("route", "point", far.alias("d")).withColumn("place", F.row_number().over(Window.partitionBy("route").orderBy("d", "point")))


def sampled(points: Column, most: int = 24) -> Column:
    """At most ``most`` evenly spaced points, both ends among them."""
    n = F.size(points)
    at = lambda i: F.get(points, F.floor(i * (n - 1) / (most - 1) + 0.5).cast("int"))
    return F.when(n <= most, points).otherwise(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), at))
