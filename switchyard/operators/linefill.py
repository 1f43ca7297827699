"""Positions for stops without one, taken from their route's line between located neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchyard.operators import validation
from switchyard.operators.spatial import radius_join
from switchyard.operators.validation import km, on_lines, vertices
from switchyard.storage import materialize

# Kilometres and calls between the located neighbours, kilometres to the line, between what routes say.
SPAN_KM, GAP, SNAP_KM, AGREE_KM = 3.0, 3, 0.5, 0.5
#: Kilometres within which a guess has a vertex: half the span and a kilometre, widened for the earth's curve.
REACH_KM = 1.1 * (SPAN_KM / 2 + validation.LINE_KM)


def guesses(calls: DataFrame, points: DataFrame, lines: DataFrame) -> DataFrame:
    """stop_id, route_id, pos, before, after, snapped, off_km: what each route says of each stop without a position.

    The route has a line; the located neighbours are at most three calls and three kilometres apart, both within a
    kilometre of the line, and not interpolated themselves (``points.method``). The point at the stop's share of the
    calls between them goes to the line's nearest vertex (of equally near ones the first), ``off_km`` away.
    """
    known = points.where("lat IS NOT NULL AND lon IS NOT NULL")
    blank = calls.join(known, "stop_id", "left_anti").select("stop_id").distinct()
    routes = calls.join(blank, "stop_id", "left_semi").select("route_id").distinct().join(lines.select("route_id"), "route_id", "left_semi")
    near = validation.neighbours(calls.join(routes, "route_id", "left_semi"), known).join(blank, "stop_id", "left_semi")
    col = F.col
    gap = col("after.pos") - col("before.pos")
    near = near.where((gap <= GAP) & (km(col("before"), col("after")) <= SPAN_KM))
    made = known.where("method = 'interpolated'").select("stop_id")
    for side in ("before", "after"):
        near = near.join(made.toDF("_made"), col(f"{side}.stop_id") == col("_made"), "left_anti")
    near = materialize(near, "line-near")
    vouched = on_lines(near.select("route_id", F.inline(F.array(*[F.struct(f"{side}.lat", f"{side}.lon") for side in ("before", "after")]))), lines)
    vouched = materialize(vouched.select(col("route_id").alias("_route"), col("lat").alias("_lat"), col("lon").alias("_lon")), "line-ends")
    met = near
    for side in ("before", "after"):
        met = met.join(vouched, (col("route_id") == col("_route")) & (col(f"{side}.lat") == col("_lat")) & (col(f"{side}.lon") == col("_lon")), "left_semi")
    share = (col("pos") - col("before.pos")) / (col("after.pos") - col("before.pos"))
    between = lambda c: col(f"before.{c}") + share * (col(f"after.{c}") - col(f"before.{c}"))
    asked = met.select("route_id", "pos", between("lat").alias("lat"), between("lon").alias("lon"))
    # a guess is within half the span of an end, and that within a kilometre of a vertex
    top = asked.agg(F.max(F.abs("lat"))).first()[0]
    reached = radius_join(asked, vertices(lines), 1000 * REACH_KM, on=["route_id"], max_lat=min((top or 0.0) + 0.1, 89.9))
    nearest = reached.groupBy("route_id", "pos").agg(F.min(F.struct((col("distance_m") / 1000).alias("km"), "i", col("lat2").alias("lat"), col("lon2").alias("lon"))).alias("b"))
    met = met.join(nearest, ["route_id", "pos"], "left")
    return met.select("stop_id", "route_id", "pos", "before", "after", F.struct("b.lat", "b.lon").alias("snapped"), F.coalesce("b.km", F.lit(float("inf"))).alias("off_km"))


def interpolated(calls: DataFrame, points: DataFrame, lines: DataFrame) -> DataFrame:
    """stop_id, lat, lon, routes, route_id, before_id, after_id, method, confidence: stops placed on a route's line.

    Every guess must snap within half a kilometre, all lie within half a kilometre of each other, and their mean (to
    five decimals) pass every test of every route that lists the stop, its line's included. The neighbours named are
    those of the first route. A stop that fails any of this gets no row, as does one without a guess.

    ``lines(route_id, line)`` holds one array of struct(lat, lon) a route. Guesses of a stop are compared only where the
    box around them fits the distance, each place once, so what a row holds is vertices of lines in half a kilometre.
    """
    said = guesses(calls, points, lines)
    first = F.min(F.struct("route_id", "pos", F.col("before.stop_id").alias("before_id"), F.col("after.stop_id").alias("after_id")))
    lat, lon = F.col("snapped.lat"), F.col("snapped.lon")
    by_stop = said.groupBy("stop_id").agg(
        F.max("off_km").alias("off"), F.avg(lat).alias("lat"), F.avg(lon).alias("lon"), F.min(lat).alias("s"), F.max(lat).alias("n"), F.min(lon).alias("w"), F.max(lon).alias("e"),
        F.count(F.lit(1)).alias("routes"), first.alias("first"))
    tall = km(F.struct(F.col("s").alias("lat"), F.col("w").alias("lon")), F.struct(F.col("n").alias("lat"), F.col("w").alias("lon")))
    boxed = by_stop.where((F.col("off") <= SNAP_KM) & (tall <= AGREE_KM))
    places = said.join(boxed.select("stop_id"), "stop_id", "left_semi").groupBy("stop_id").agg(F.collect_set("snapped").alias("places"))
    apart = F.exists("places", lambda a: F.exists("places", lambda b: km(a, b) > AGREE_KM))
    offers = boxed.join(places.where(~apart).select("stop_id"), "stop_id").select("stop_id", F.lit(0).alias("ord"), F.bround("lat", 5).alias("lat"), F.bround("lon", 5).alias("lon"), "routes", "first.*")
    asked = offers.select("stop_id", "ord", "lat", "lon")
    routes = calls.join(asked, "stop_id", "left_semi").select("route_id").distinct()
    here = calls.join(routes, "route_id", "left_semi")
    failed = validation.route_results(here, points.where("lat IS NOT NULL AND lon IS NOT NULL"), asked, lines).where("NOT ok").select("stop_id").distinct()
    out = offers.join(failed, "stop_id", "left_anti").select("stop_id", "lat", "lon", "routes", "route_id", "before_id", "after_id")
    return out.withColumns({"method": F.lit("interpolated"), "confidence": F.lit("low")})
