"""Queries on the assembly of a feed: stops, directions, routes, trips, calendars, names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchyard.functions import labels
from switchyard.operators import feed, rail, sequence
from switchyard.plans import roles
from switchyard.plans.registry import query
from switchyard.plans.roles import KEYS, ORDER, SQL_ORDER, SQL_TIMES, sql_haversine


def _feed_stops(spark, d) -> DataFrame:
    def of(table: str, key: str, modulus: int) -> DataFrame:
        k = F.col(key)
        lat = F.when(k % 13 != 0, 20.6 + (k * 7919 % 40000) / F.lit(10000.0))
        return roles.table(spark, d, table).select(k.alias("key"), (k % modulus).alias("stop_id"), lat.alias("lat"), (87.5 + (k * 104729 % 20000) / F.lit(10000.0)).alias("lon"), F.when(k % 11 == 0, "interpolated").alias("coord_method"))

    return feed.admit_stops(feed.union_modes({"metro": of("supplier", "s_suppkey", 80), "bus": of("customer", "c_custkey", 900)}), "key")


_STOP_SIDE = """SELECT '{mode}' AS mode, {order} AS mode_order, {k} AS key, {k} % {m} AS stop_id, CASE WHEN {k} % 13 <> 0 THEN 20.6 + ({k} * 7919 % 40000) / CAST(10000 AS DOUBLE) END AS lat,
CAST(87.5 AS DOUBLE) + ({k} * 104729 % 20000) / CAST(10000 AS DOUBLE) AS lon, {k} % 11 = 0 AS interpolated FROM {t}"""


@query(f"""WITH s AS ({_STOP_SIDE.format(mode='metro', order=0, k='s_suppkey', m=80, t='supplier')} UNION ALL {_STOP_SIDE.format(mode='bus', order=2, k='c_custkey', m=900, t='customer')}),
r AS (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY mode_order, key) AS i FROM s)
SELECT mode, key, stop_id, CASE WHEN i > 1 THEN 'duplicate' WHEN interpolated THEN 'interpolated' WHEN lat IS NULL THEN 'unlocated'
WHEN NOT (lat > 21 AND lat < 24 AND lon > 87 AND lon < 90) THEN 'outside' ELSE 'located' END AS status FROM r""")
def q_feed_stops(spark, d):
    """Which stops of all modes are admitted, and why others are not."""
    return _feed_stops(spark, d).select("mode", "key", "stop_id", "status")


@query(f"""WITH k AS (SELECT *, l_suppkey % 7 AS stop FROM lineitem WHERE l_suppkey % 7 <> 3),
g AS (SELECT *, lag(stop) OVER ({SQL_ORDER}) AS was FROM k), c AS (SELECT * FROM g WHERE was IS NULL OR was <> stop),
n AS (SELECT l_orderkey AS trip_id, CAST(row_number() OVER ({SQL_ORDER}) AS INTEGER) AS seq, stop, count(*) OVER (PARTITION BY l_orderkey) AS n FROM c)
SELECT trip_id, seq, stop FROM n WHERE n >= 2""")
def q_feed_patterns(spark, d):
    """Directions of located stops, repeats once, with two stops or more."""
    rows = roles.stop_times(spark, d).withColumn("stop", F.col("l_suppkey") % 7)
    return feed.located_directions(rows, KEYS, ORDER, F.col("stop") != 3, "stop").select(F.col("l_orderkey").alias("trip_id"), "seq", "stop")


def _routes(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    mode = F.element_at(F.array(*[F.lit(m) for m in feed.MODES]), (k % 6 + 1).cast("int"))
    routes = roles.table(spark, d, "orders").select(
        k.alias("route_id"), mode.alias("mode"), F.when(k % 5 != 0, "10").alias("peak"), F.when(k % 3 != 0, "15").alias("offpeak"),
        F.when(k % 7 != 0, "06:00").alias("first_service"), F.when(k % 4 != 0, "21:00").otherwise(" ").alias("last_service"))
    c = F.col("c_custkey")
    mask = F.when(c % 4 == 0, "1111100").when(c % 4 == 1, "0000011").when(c % 4 == 2, "0000000").otherwise("1010101")
    periods = roles.table(spark, d, "customer").select((c * 7).alias("route_id"), mask.alias("mask"), F.lit("12").alias("peak"), F.lit(None).cast("string").alias("offpeak"), F.lit("06:00").alias("first_service"), F.when(c % 5 != 0, "20:00").alias("last_service"))
    return feed.route_status(routes, periods)


_ROUTES_SQL = f"""r AS (SELECT o_orderkey AS k, ['{"', '".join(feed.MODES)}'][o_orderkey % 6 + 1] AS mode FROM orders),
p AS (SELECT DISTINCT c_custkey * 7 AS k FROM customer WHERE c_custkey % 4 <> 2 AND c_custkey % 5 <> 0),
st AS (SELECT r.k AS route_id, mode, CASE WHEN p.k IS NOT NULL THEN 'periods' WHEN (r.k % 5 <> 0 OR r.k % 3 <> 0) AND r.k % 7 <> 0 AND r.k % 4 <> 0 THEN 'given'
WHEN mode IN ('bus', 'minibus', 'auto') THEN 'default' ELSE 'excluded' END AS status FROM r LEFT JOIN p ON p.k = r.k)"""


@query(f"WITH {_ROUTES_SQL} SELECT route_id, status FROM st")
def q_route_status(spark, d):
    """Where each route's service comes from, or that it has none."""
    return _routes(spark, d).select("route_id", "status")


@query(f"""WITH {_ROUTES_SQL}, u AS (SELECT mode, unnest([CASE WHEN route_id % 5 = 0 AND route_id % 3 = 0 THEN 'headway' END, CASE WHEN route_id % 7 = 0 THEN 'window' END]) AS kind FROM st WHERE status = 'default')
SELECT kind, mode, count(*) AS n FROM u WHERE kind IS NOT NULL GROUP BY ALL""")
def q_defaults_used(spark, d):
    """Default headways and windows in use, by mode."""
    return feed.defaults_used(_routes(spark, d))


_HOP = sql_haversine(f"lag(lat) OVER ({SQL_ORDER})", f"lag(lon) OVER ({SQL_ORDER})", "lat", "lon")


@query(f"""WITH {SQL_TIMES}, h AS (SELECT *, row_number() OVER ({SQL_ORDER}) AS seq, {_HOP} * 1.3 AS m FROM times),
e AS (SELECT l_orderkey, seq, sum(CASE WHEN m IS NULL THEN 0 ELSE greatest(m / (CAST(15 AS DOUBLE) / 3.6), 30.0) END) OVER (PARTITION BY l_orderkey ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM h)
SELECT l_orderkey AS trip_id, CAST(seq AS INTEGER) AS seq, CAST(floor(s) AS BIGINT) AS seconds FROM e""")
def q_estimated_times(spark, d):
    """Seconds to each stop at a bus's speed."""
    rows = roles.stop_times(spark, d).withColumn("seq", F.row_number().over(sequence.along(KEYS, ORDER)))
    timed = feed.estimated_seconds(rows, KEYS, ["seq"], feed.SPEED_KMH["bus"])
    return timed.select(F.col("l_orderkey").alias("trip_id"), "seq", F.floor("estimate").cast("long").alias("seconds"))


def _rail_trips(spark, d) -> DataFrame:
    calls = roles.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("trip_id"), (F.col("l_partkey") % 50).alias("route_id"), F.col("l_linenumber").alias("seq"), (F.col("l_suppkey") % 3 != 0).alias("located"))
    routes = roles.table(spark, d, "supplier").select((F.col("s_suppkey") % 40).alias("route_id"))
    k = F.col("o_orderkey")
    mask = F.when(k % 4 == 0, "1111100").when(k % 4 == 1, "0000011").when(k % 4 == 2, "0000000").otherwise("1010101 ")
    return feed.rail_trips(calls, routes, roles.table(spark, d, "orders").where(k % 9 != 0).select(k.alias("trip_id"), mask.alias("mask")))


_RAIL_SQL = """c AS (SELECT l_orderkey AS trip_id, arg_min(l_partkey % 50, l_linenumber * 100 + l_partkey % 50) AS route_id, count(*) FILTER (WHERE l_suppkey % 3 <> 0) AS n FROM lineitem GROUP BY l_orderkey),
rt AS (SELECT DISTINCT s_suppkey % 40 AS route_id FROM supplier),
ok AS (SELECT c.trip_id, c.route_id, c.n, CASE WHEN o.o_orderkey IS NULL THEN NULL ELSE ['1111100', '0000011', '0000000', '1010101'][o.o_orderkey % 4 + 1] END AS mask, rt.route_id IS NOT NULL AS known FROM c LEFT JOIN rt ON rt.route_id = c.route_id LEFT JOIN orders o ON o.o_orderkey = c.trip_id AND o.o_orderkey % 9 <> 0),
tr AS (SELECT trip_id, route_id, mask, CASE WHEN NOT known THEN 'unknown route' WHEN mask IS NULL THEN 'no days' WHEN mask = '0000000' THEN 'bad mask' WHEN n < 2 THEN 'too short' ELSE 'ok' END AS status FROM ok)"""


@query(f"WITH {_RAIL_SQL} SELECT trip_id, route_id, status FROM tr")
def q_rail_trips(spark, d):
    """Trips with a known route, days and two located calls, and why others are left out."""
    return _rail_trips(spark, d).select("trip_id", "route_id", "status")


@query(f"WITH {_RAIL_SQL} SELECT mask, count(DISTINCT route_id) AS services, count(*) AS trips FROM tr WHERE status = 'ok' GROUP BY mask")
def q_trips_by_mask(spark, d):
    """Routes and trips of each set of days."""
    return feed.trips_by_mask(_rail_trips(spark, d).where("status = 'ok'"))


_MASK = "['1111100', '0000011', '1100110', '1010101'][s_suppkey % 4 + 1]"
_START = "(DATE '2026-01-05' + CAST(s_suppkey AS INTEGER))"


@query(f"""SELECT s_suppkey AS service_id, {', '.join(f"CAST(substr({_MASK}, {i}, 1) AS INTEGER) AS {day}" for i, day in enumerate(labels.WEEKDAYS, 1))},
strftime({_START}, '%Y%m%d') AS start_date, strftime({_START} + 364, '%Y%m%d') AS end_date FROM supplier""")
def q_calendar(spark, d):
    """Day columns and dates of every service."""
    k = F.col("s_suppkey")
    mask = F.element_at(F.array(*map(F.lit, ["1111100", "0000011", "1100110", "1010101"])), (k % 4 + 1).cast("int"))
    start = F.date_add(F.lit("2026-01-05").cast("date"), k.cast("int"))
    return roles.table(spark, d, "supplier").select(k.alias("service_id"), labels.calendar(mask, start, 364).alias("c")).select("service_id", "c.*")


_MODE_OF = "['metro', 'rail', 'bus', 'tram', 'ferry', 'auto', 'minibus'][p_partkey % 7 + 1]"
_NAME_OF = "CASE WHEN p_partkey % 5 = 0 THEN p_name || ' (' || p_brand || ')' WHEN p_partkey % 5 = 1 THEN p_brand || ' - ' || p_type ELSE p_name END"


@query(f"""WITH p AS (SELECT p_partkey, {_MODE_OF} AS mode, {_NAME_OF} AS name, p_brand AS o, p_type AS d, CASE p_partkey % 3 WHEN 0 THEN 'South Eastern Railway' WHEN 1 THEN 'WBTC' ELSE 'private' END AS op,
CASE p_partkey % 7 WHEN 3 THEN 'tram_' WHEN 5 THEN 'auto_r' ELSE 'r' END || p_partkey AS route_id FROM part),
e AS (SELECT *, o || ' - ' || d AS ends, regexp_full_match(name, '([^()]+?)\\s*\\((.+)\\)') AND length(name) > 12 AS cut, contains(name, ' - ') AS named FROM p)
SELECT route_id, CASE mode WHEN 'metro' THEN 'mrk' WHEN 'rail' THEN CASE WHEN op LIKE 'South%' THEN 'ser' ELSE 'er' END WHEN 'tram' THEN 'wbtc' WHEN 'ferry' THEN CASE WHEN op = 'WBTC' THEN 'wbstc_ferry' ELSE 'other_ferry' END
WHEN 'auto' THEN 'share_auto' WHEN 'minibus' THEN 'minibus' ELSE CASE WHEN op = 'WBTC' THEN 'wbtc' ELSE 'private_bus' END END AS agency,
CASE mode WHEN 'bus' THEN CASE WHEN named THEN '' WHEN cut THEN trim(regexp_extract(name, '^([^()]+?)\\s*\\((.+)\\)$', 1)) ELSE name END WHEN 'tram' THEN CAST(p_partkey AS VARCHAR) WHEN 'auto' THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS short,
CASE mode WHEN 'bus' THEN CASE WHEN cut AND NOT named THEN ends || ' (' || trim(regexp_extract(name, '^([^()]+?)\\s*\\((.+)\\)$', 2)) || ')' ELSE ends END WHEN 'tram' THEN ends ELSE name END AS long FROM e""")
def q_route_labels(spark, d):
    """Agency and names of every route."""
    k = F.col("p_partkey")
    mode = F.element_at(F.array(*map(F.lit, ["metro", "rail", "bus", "tram", "ferry", "auto", "minibus"])), (k % 7 + 1).cast("int"))
    name = F.when(k % 5 == 0, F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))).when(k % 5 == 1, F.concat_ws(" - ", "p_brand", "p_type")).otherwise(F.col("p_name"))
    op = F.when(k % 3 == 0, "South Eastern Railway").when(k % 3 == 1, "WBTC").otherwise("private")
    route = F.concat(F.when(k % 7 == 3, "tram_").when(k % 7 == 5, "auto_r").otherwise("r"), k.cast("string"))
    both = labels.route_names(mode, route, name, F.col("p_brand"), F.col("p_type"))
    return roles.table(spark, d, "part").select(route.alias("route_id"), labels.agency(mode, op).alias("agency"), both["short"].alias("short"), both["long"].alias("long"))


@query("""WITH p AS (SELECT p_partkey, p_size * 17 / CAST(10 AS DOUBLE) AS m, p_size * 61 / CAST(2 AS DOUBLE) AS far FROM part), r AS (SELECT *, CAST(greatest(1, floor(m + 0.5)) AS BIGINT) AS x FROM p)
SELECT p_partkey AS id, CASE WHEN x < 60 THEN x || ' min' ELSE (x // 60) || ' h ' || lpad(CAST(x % 60 AS VARCHAR), 2, '0') || ' min' END AS minutes,
CASE WHEN far < 1000 THEN CAST(CAST(floor(far / 10 + 0.5) * 10 AS BIGINT) AS VARCHAR) || ' m' ELSE printf('%.1f', far / 1000) || ' km' END AS distance FROM r""")
def q_shown_figures(spark, d):
    """Minutes and distances as users read them."""
    p = F.col("p_size")
    return roles.table(spark, d, "part").select(F.col("p_partkey").alias("id"), labels.minutes_text(p * 17 / F.lit(10.0)).alias("minutes"), labels.distance_text(p * 61 / F.lit(2.0)).alias("distance"))


def _rail_calls(spark, d) -> DataFrame:
    """Trains of every agency over twelve stations, some left out; odd ones run back."""
    s = roles.table(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("route_id"), F.col("s_suppkey").alias("trip_id"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i"))
    s = s.where((F.col("trip_id") + F.col("i")) % 4 != 0)
    back = F.col("trip_id") % 2 == 1
    return s.select("route_id", "trip_id", F.when(back, 11 - F.col("i")).otherwise(F.col("i")).alias("seq"), F.concat(F.lit("c"), F.lpad(F.col("i").cast("string"), 2, "0")).alias("code"), (F.when(back, 11 - F.col("i")).otherwise(F.col("i")) * 5.0).alias("km"))


@query("""WITH c AS (SELECT DISTINCT s_nationkey AS route_id, i FROM supplier, range(12) t(i) WHERE (s_suppkey + i) % 4 <> 0),
h AS (SELECT route_id, min(i) AS hub FROM c GROUP BY route_id)
SELECT CAST(c.route_id AS BIGINT) AS route_id, 'c' || lpad(CAST(i AS VARCHAR), 2, '0') AS code, CAST((i - hub) * 5 AS DOUBLE) AS position, CAST(row_number() OVER (PARTITION BY c.route_id ORDER BY i) - 1 AS INTEGER) AS place FROM c JOIN h USING (route_id)""")
def q_station_order(spark, d):
    """Stations of every line in order, with km from its hub."""
    calls = _rail_calls(spark, d)
    at = rail.station_positions(calls, calls.groupBy("route_id").agg(F.min("code").alias("hub")))
    return rail.station_order(calls, at).join(at, ["route_id", "code"]).select("route_id", "code", "position", "place")


@query("""WITH c AS (SELECT s_nationkey AS route_id, s_suppkey % 2 AS direction, s_suppkey AS trip_id, i, CASE WHEN s_suppkey % 2 = 1 THEN 11 - i ELSE i END AS seq FROM supplier, range(12) t(i) WHERE (s_suppkey + i) % 4 <> 0),
t AS (SELECT *, seq * (5 + trip_id % 3) AS arr, seq * (5 + trip_id % 3) + 1 AS dep FROM c), f AS (SELECT route_id, direction, arg_min(i, seq) AS i FROM (SELECT route_id, direction, i, min(seq) AS seq FROM c GROUP BY ALL) GROUP BY ALL),
b AS (SELECT t.route_id, t.direction, t.trip_id, min(dep) AS start FROM t JOIN f ON f.route_id = t.route_id AND f.direction = t.direction AND f.i = t.i GROUP BY ALL)
SELECT CAST(t.route_id AS BIGINT) AS route_id, CAST(t.direction AS BIGINT) AS direction, 'c' || lpad(CAST(t.i AS VARCHAR), 2, '0') AS code, CAST(trunc(median(arr - start)) AS INTEGER) AS minutes
FROM t JOIN b ON b.route_id = t.route_id AND b.direction = t.direction AND b.trip_id = t.trip_id GROUP BY t.route_id, t.direction, t.i""")
def q_running_minutes(spark, d):
    """Median minutes from each line's first station."""
    pace = 5 + F.col("trip_id") % 3
    calls = _rail_calls(spark, d).withColumns({"direction": F.col("trip_id") % 2, "arrival": F.col("seq") * pace, "departure": F.col("seq") * pace + 1})
    first = calls.groupBy("route_id", "direction").agg(F.min_by("code", "seq").alias("first_code"))
    return rail.running_minutes(calls, first)


@query("""WITH c AS (SELECT o_custkey % 25 AS route_id, l_suppkey AS code, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT route_id, arg_min(code, -n * 1000000 + code) AS code, max(n) AS n FROM c GROUP BY route_id""")
def q_busiest(spark, d):
    """The stop with most calls of every route."""
    o = roles.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 25).alias("route_id"))
    return rail.busiest(roles.table(spark, d, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("code")).join(o, "l_orderkey"), ["route_id"])


@query("""SELECT event_type AS kind, min(CAST(hour(ts) * 60 + minute(ts) AS INTEGER)) AS first, max(CAST(hour(ts) * 60 + minute(ts) AS INTEGER)) AS last, count(ts) AS n FROM events GROUP BY event_type""")
def q_column_summary(spark, d):
    """First, last and number of departures of each kind."""
    return rail.column_summary(roles.departures(spark, d).withColumnRenamed("event_type", "kind"), ["kind"], "minute").select("kind", F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last"), "n")


@query("""WITH t AS (SELECT l_orderkey, min(l_extendedprice) AS a, max(l_extendedprice) AS b FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey % 25 AS route_id, max(CAST(floor(b) AS BIGINT) - CAST(floor(a) AS BIGINT)) AS span_km FROM t GROUP BY 1""")
def q_longest_span(spark, d):
    """The longest way of a train on each route."""
    t = roles.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.floor(F.min("l_extendedprice")).alias("first_km"), F.floor(F.max("l_extendedprice")).alias("last_km"))
    return rail.longest_span(t.withColumn("route_id", F.col("l_orderkey") % 25)).select("route_id", F.col("span_km").cast("long").alias("span_km"))


_CODES = "list_sort(list_distinct(list(l_suppkey % 12)))"


@query(f"""WITH t AS (SELECT l_orderkey AS k, {_CODES} AS codes FROM lineitem GROUP BY l_orderkey), x AS (SELECT k % 20 AS route_id, k % 3 = 0 AS clipped, codes FROM t),
e AS (SELECT route_id, list_sort(list_distinct(flatten(list([codes[1], codes[-1]])))) AS ends FROM x WHERE clipped GROUP BY route_id),
g AS (SELECT route_id, count(*) AS trips, count(*) FILTER (WHERE clipped) AS clipped, count(*) FILTER (WHERE list_max(codes) > 8) AS beyond FROM x GROUP BY route_id)
SELECT g.route_id, trips, clipped, coalesce(array_to_string(ends, ','), '') AS clip_ends, beyond FROM g LEFT JOIN e USING (route_id)""")
def q_clip_report(spark, d):
    """Trains that are clipped, where, and those that leave the line."""
    codes = F.array_sort(F.collect_set(F.col("l_suppkey") % 12))
    t = roles.table(spark, d, "lineitem").groupBy("l_orderkey").agg(codes.alias("c"))
    t = t.select((F.col("l_orderkey") % 20).alias("route_id"), (F.col("l_orderkey") % 3 == 0).alias("clipped"), F.transform("c", lambda x: F.lpad(x.cast("string"), 2, "0")).alias("codes"))
    line = t.select("route_id").distinct().withColumn("stations", F.array(*[F.lit(f"{i:02d}") for i in range(9)]))
    ends = F.array_join(F.transform("clip_ends", lambda x: x.cast("int").cast("string")), ",")
    return rail.clip_report(t, line).select("route_id", "trips", "clipped", ends.alias("clip_ends"), "beyond")
