"""Assembly of a feed: which stops, directions, routes and trips go in, and why others don't."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.functions.clock import mask_valid
from switchyard.functions.geo import haversine_m, in_box
from switchyard.operators.sequence import along, drop_repeats, so_far

# Order of modes, kilometres an hour, detour, least hop, and headways where none is given.
MODES = ["metro", "rail", "bus", "tram", "ferry", "auto"]
SPEED_KMH = {"bus": 15.0, "minibus": 15.0, "auto": 18.0, "tram": 10.0, "ferry": 10.0, "metro": 33.0}
DETOUR, LEAST_HOP_S = 1.3, 30.0
DEFAULT_HEADWAY = {"bus": 15, "minibus": 15, "auto": 10, "tram": 20, "ferry": 20, "metro": 10}
DEFAULT_ALLOWED = ["bus", "minibus", "auto"]
BOX = (21.0, 87.0, 24.0, 90.0)


def sourced(peak: Column, offpeak: Column, first: Column, last: Column) -> Column:
    """Whether a row brings a headway and both ends of its service window."""
    given = lambda c: F.trim(F.coalesce(c.cast("string"), F.lit(""))) != ""
    return (given(peak) | given(offpeak)) & given(first) & given(last)


def union_modes(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables with ``mode`` and ``mode_order``, in the modes' fixed order; a table may lack columns."""
    parts = [t.withColumns({"mode": F.lit(m), "mode_order": F.lit(MODES.index(m))}) for m, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def admit_stops(stops: DataFrame, order: str) -> DataFrame:
    """``status`` of each row of ``stops(stop_id, mode_order, lat, lon, coord_method)``; ``order`` is the row's place in its file.

    A repeated id is a duplicate but for its first mode's first row; then interpolated, unlocated, outside
    (of the open box) or located.
    """
    first = F.row_number().over(Window.partitionBy("stop_id").orderBy("mode_order", order)) == 1
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    status = (
        F.when(F.trim(F.coalesce("coord_method", F.lit(""))) == "interpolated", "interpolated").when(lat.isNull() | lon.isNull(), "unlocated")
        .when(~in_box(lat, lon, *BOX, closed=False), "outside").otherwise("located")
    )
    return stops.withColumn("_first", first).withColumn("status", F.when(F.col("_first"), status).otherwise("duplicate")).drop("_first")


def located_directions(rows: DataFrame, keys: list[str], order: list[str], located: Column, stop: str) -> DataFrame:
    """Rows of located stops, repeats in a row once, of the sequences that keep two or more; ``seq`` from 1."""
    kept = drop_repeats(rows.where(located), keys, order, stop)
    whole = Window.partitionBy(*keys)
    return kept.withColumn("_n", F.count(F.lit(1)).over(whole)).where("_n >= 2").drop("_n")


def route_status(routes: DataFrame, periods: DataFrame) -> DataFrame:
    """``status`` of ``routes(route_id, mode, peak, offpeak, first_service, last_service)``.

    periods (some sourced period of a valid mask), given (its own figures), default (modes that may run on default
    figures), else excluded.
    """
    good = periods.where(mask_valid(F.col("mask")) & sourced(F.col("peak"), F.col("offpeak"), F.col("first_service"), F.col("last_service")))
    has = good.select("route_id").distinct().withColumn("_period", F.lit(True))
    own = sourced(F.col("peak"), F.col("offpeak"), F.col("first_service"), F.col("last_service"))
    status = F.when(F.col("_period"), "periods").when(own, "given").when(F.col("mode").isin(DEFAULT_ALLOWED), "default").otherwise("excluded")
    return routes.join(has, "route_id", "left").withColumn("status", status).drop("_period")


def estimated_seconds(df: DataFrame, keys: list[str], order: list[str], speed_kmh: Column | float) -> DataFrame:
    """``estimate``: seconds from the first stop, each hop at the mode's speed with a detour, at least half a minute."""
    w = along(keys, order)
    metres = haversine_m(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")) * DETOUR
    speed = (speed_kmh if isinstance(speed_kmh, Column) else F.lit(speed_kmh)) / 3.6
    hop = F.when(metres.isNotNull(), F.greatest(metres / speed, F.lit(LEAST_HOP_S))).otherwise(0.0)
    return df.withColumn("_hop", hop).withColumn("estimate", F.sum("_hop").over(so_far(keys, order))).drop("_hop")


def rail_trips(calls: DataFrame, routes: DataFrame, days: DataFrame) -> DataFrame:
    """trip_id, route_id, mask, n_located, status of each trip of ``calls(trip_id, route_id, seq, located)``.

    The first call names the route. unknown route, no days, bad mask and under two located calls leave a trip out,
    in this order; other trips are ok.
    """
    trips = calls.groupBy("trip_id").agg(F.min_by("route_id", F.struct("seq", "route_id")).alias("route_id"), F.count_if("located").alias("n_located"))
    known = routes.select("route_id").distinct().withColumn("_known", F.lit(True))
    masks = days.groupBy("trip_id").agg(F.min(F.trim("mask")).alias("mask"), F.lit(True).alias("_days"))
    met = trips.join(known, "route_id", "left").join(masks, "trip_id", "left")
    status = (
        F.when(F.col("_known").isNull(), "unknown route").when(F.col("_days").isNull(), "no days").when(~F.coalesce(mask_valid(F.col("mask")), F.lit(False)), "bad mask")
        .when(F.col("n_located") < 2, "too short").otherwise("ok")
    )
    return met.select("trip_id", "route_id", "mask", "n_located", status.alias("status"))


def trips_by_mask(trips: DataFrame) -> DataFrame:
    """mask, services, trips: how many trips run on each set of days, over how many routes."""
    return trips.groupBy("mask").agg(F.count_distinct("route_id").alias("services"), F.count(F.lit(1)).alias("trips"))


def defaults_used(routes: DataFrame) -> DataFrame:
    """kind, mode, n: routes that run on a default headway or window, by mode (``routes`` of :func:`route_status`)."""
    kinds = F.array(F.when(F.col("peak").isNull() & F.col("offpeak").isNull(), F.lit("headway")), F.when(F.col("first_service").isNull() | F.col("last_service").isNull(), F.lit("window")))
    used = routes.where("status = 'default'").select("mode", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("kind"))
    return used.groupBy("kind", "mode").agg(F.count(F.lit(1)).alias("n"))


def rolled_over(times: Column) -> Column:
    """Fold over ordered struct(arrival, departure) in minutes: a day more while arrival is before the last
    departure, and while departure is before arrival. A missing one takes the other's value."""
    start = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast("array<struct<arrival:long,departure:long>>").alias("out"))
    up = lambda value, floor: value + 1440 * F.greatest(F.lit(0), F.ceil((floor - value) / F.lit(1440.0))).cast("long")

    def step(state: Column, row: Column) -> Column:
        given = F.coalesce(row["arrival"], row["departure"]).cast("long")
        arrival = F.when(state["last"].isNull(), given).otherwise(up(given, state["last"]))
        departure = up(F.coalesce(row["departure"], row["arrival"]).cast("long"), arrival)
        return F.struct(departure.alias("last"), F.concat(state["out"], F.array(F.struct(arrival.alias("arrival"), departure.alias("departure")))).alias("out"))

    return F.aggregate(times, start, step, lambda s: s["out"])


def flat_fare(low: Column, high: Column, mode: Column, flat_modes: list[str]) -> Column:
    """A fare for the feed, with two decimals: only where both ends are the same number, in modes of flat fares."""
    a, b = low.try_cast("double"), high.try_cast("double")
    return F.when((a == b) & mode.isin(flat_modes), F.format_string("%.2f", a))
