"""Queries on printed timetables: events are the words of pages, orders the routes that time points lie on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.operators import timetables
from switchyard.plans import roles
from switchyard.plans.registry import query
from switchyard.plans.roles import SQL_ORDER

_CODE = "^K[A-Z]{3,4}$"


def _words(spark, d) -> DataFrame:
    """Every user is a document; its events, in order, fill pages of forty words; the first six of every other page are headers."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = roles.departures(spark, d).select(F.col("user_id").alias("doc"), "event_id", "minute", (F.row_number().over(w) - 1).alias("i"))
    e = e.select("doc", F.floor(F.col("i") / 40).alias("page"), (F.col("i") % 40).alias("place"), "event_id", "minute")
    head = (F.col("page") % 2 == 0) & (F.col("place") < 6)
    text = F.when(head, F.concat(F.lit("KA"), F.substring(F.lit("BCDEFG"), (F.col("place") + 1).cast("int"), F.lit(1)), F.substring(F.lit("HIJKLMNOPQ"), (F.col("event_id") % 10 + 1).cast("int"), F.lit(1))))
    text = text.otherwise(F.concat(F.floor(F.col("minute") / 60).cast("string"), F.when(F.col("event_id") % 3 == 0, ".").otherwise(":"), F.lpad((F.col("minute") % 60).cast("string"), 2, "0")))
    x0 = F.when(head, F.lit(20.0) + (F.col("place") * 5 % 6) * 60 + F.col("event_id") % 7).otherwise((F.col("event_id") * 53 % 400).cast("double"))
    top = F.when(head, 5.0).otherwise(F.lit(20.0) + (F.col("place") % 9) * 4.5)
    return e.select("doc", "page", "place", text.alias("text"), x0.alias("x0"), (x0 + 24).alias("x1"), top.alias("top"))


_WORDS = """WITH e AS (SELECT user_id AS doc, event_id, CAST(hour(ts) * 60 + minute(ts) AS BIGINT) AS minute, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
p AS (SELECT doc, i // 40 AS page, i % 40 AS place, event_id, minute FROM e),
words AS MATERIALIZED (SELECT *, page % 2 = 0 AND place < 6 AS head, CASE WHEN page % 2 = 0 AND place < 6 THEN CAST(20 AS DOUBLE) + (place * 5 % 6) * 60 + event_id % 7 ELSE CAST(event_id * 53 % 400 AS DOUBLE) END AS x0,
CASE WHEN page % 2 = 0 AND place < 6 THEN CAST(5 AS DOUBLE) ELSE CAST(20 AS DOUBLE) + (place % 9) * CAST(4.5 AS DOUBLE) END AS top FROM p),
own AS (SELECT doc, page, row_number() OVER (PARTITION BY doc, page ORDER BY x0, place) - 1 AS col, 'KA' || substr('BCDEFG', CAST(place + 1 AS BIGINT), 1) || substr('HIJKLMNOPQ', CAST(event_id % 10 + 1 AS BIGINT), 1) AS code, x0 + 12 AS x, count(*) OVER (PARTITION BY doc, page) AS n FROM words WHERE head),
cols AS MATERIALIZED (SELECT * FROM own WHERE n > 1),
pages AS (SELECT w.doc, w.page, max(c.page) AS own FROM (SELECT DISTINCT doc, page FROM words) w JOIN cols c ON c.doc = w.doc AND c.page <= w.page GROUP BY ALL),
pairs AS (SELECT w.doc, w.page, w.place, round_even(w.top / 3, 0) AS row, w.minute, c.col, c.code, abs(c.x - (w.x0 + 12)) AS far FROM words w JOIN pages p ON p.doc = w.doc AND p.page = w.page JOIN cols c ON c.doc = p.doc AND c.page = p.own WHERE NOT w.head),
near AS (SELECT doc, page, place, row, minute, arg_min({'col': col, 'code': code}, {'far': far, 'col': col}) AS c FROM pairs GROUP BY ALL),
cells AS MATERIALIZED (SELECT doc, page, CAST(row AS BIGINT) AS row, c.col AS col, c.code AS code, arg_max(minute, place) AS minute FROM near GROUP BY ALL)"""


@query(f"""{_WORDS} SELECT doc, page, row, CAST(col AS INTEGER) AS "column", code, CAST(minute AS INTEGER) AS minute FROM cells""")
def q_timetable_grid(spark, d):
    """Every time of the pages in its row and column."""
    return timetables.grid(_words(spark, d), _CODE)


@query(f"""{_WORDS}, last AS (SELECT c.doc, c.col, c.code, CASE WHEN c.col >= count(*) OVER (PARTITION BY c.doc) // 2 THEN 1 ELSE 0 END AS direction FROM cols c JOIN (SELECT doc, max(own) AS own FROM pages GROUP BY doc) m ON m.doc = c.doc AND m.own = c.page),
sides AS MATERIALIZED (SELECT *, col = min(col) OVER w AS is_first, col = max(col) OVER w AS is_last FROM last WINDOW w AS (PARTITION BY doc, direction)),
met AS MATERIALIZED (SELECT c.doc, c.page, c.row, c.minute, s.* EXCLUDE (doc) FROM cells c JOIN sides s ON s.doc = c.doc AND s.col = c.col),
full_trips AS (SELECT doc, page, row, direction, max(minute) FILTER (WHERE is_first) AS f, max(minute) FILTER (WHERE is_last) AS t FROM met GROUP BY ALL HAVING f IS NOT NULL AND t IS NOT NULL),
counts AS MATERIALIZED (SELECT s.doc, s.direction, s.col, s.code, count(m.minute) AS n FROM sides s LEFT JOIN met m ON m.doc = s.doc AND m.col = s.col GROUP BY ALL),
best AS (SELECT doc, direction, arg_min({{'col': col, 'code': code, 'n': n}}, {{'n': -n, 'col': col}}) AS b FROM counts GROUP BY ALL),
ends AS (SELECT doc, direction, median(t - f) AS end_to_end FROM full_trips GROUP BY ALL),
here AS (SELECT m.doc, m.direction, m.minute FROM met m JOIN best b ON b.doc = m.doc AND b.direction = m.direction AND b.b.col = m.col),
pk AS (SELECT doc, direction, minute - lag(minute) OVER w AS gap, lag(minute) OVER w AS a, minute AS b FROM here WHERE minute >= 480 AND minute < 660 OR minute >= 1020 AND minute < 1200 WINDOW w AS (PARTITION BY doc, direction ORDER BY minute)),
peak AS (SELECT doc, direction, median(gap) AS peak FROM pk WHERE gap > 0 AND gap < 90 AND (b < 660 OR a >= 1020) GROUP BY ALL),
op AS (SELECT doc, direction, minute - lag(minute) OVER (PARTITION BY doc, direction ORDER BY minute) AS gap FROM here WHERE minute >= 660 AND minute < 960),
off AS (SELECT doc, direction, median(gap) AS off_peak FROM op WHERE gap > 0 AND gap < 90 GROUP BY ALL)
SELECT b.doc, CAST(b.direction AS INTEGER) AS direction, b.b.code AS measured_at, b.b.n AS trips, CAST(peak AS DOUBLE) AS peak, CAST(off_peak AS DOUBLE) AS off_peak, CAST(end_to_end AS DOUBLE) AS end_to_end
FROM best b LEFT JOIN peak USING (doc, direction) LEFT JOIN off USING (doc, direction) LEFT JOIN ends USING (doc, direction)""")
def q_timetable_directions(spark, d):
    """Headways and running times of both directions of every document."""
    words = _words(spark, d)
    return timetables.direction_figures(timetables.grid(words, _CODE), timetables.halves(words, _CODE))


@query(f"""WITH RECURSIVE calls AS MATERIALIZED (SELECT l_orderkey AS route, row_number() OVER ({SQL_ORDER}) AS seq, l_suppkey % 5 AS stop FROM lineitem),
anchors AS MATERIALIZED (SELECT route, row_number() OVER (PARTITION BY route ORDER BY seq) AS place, CASE WHEN route % 11 = 0 AND seq = 1 THEN 99 ELSE stop END AS stop, seq * 3 AS minute FROM calls WHERE seq % 2 = 1 OR route % 4 = 0),
walk AS (SELECT route, CAST(0 AS BIGINT) AS place, CAST(0 AS BIGINT) AS last, CAST(NULL AS BIGINT) AS seq FROM (SELECT DISTINCT route FROM anchors)
UNION ALL SELECT w.route, a.place, coalesce((SELECT min(c.seq) FROM calls c WHERE c.route = w.route AND c.stop = a.stop AND c.seq > w.last), w.last), (SELECT min(c.seq) FROM calls c WHERE c.route = w.route AND c.stop = a.stop AND c.seq > w.last) FROM walk w JOIN anchors a ON a.route = w.route AND a.place = w.place + 1)
SELECT w.route, CAST(w.place AS INTEGER) AS place, a.stop, CAST(a.minute AS INTEGER) AS minute, CAST(w.seq AS INTEGER) AS seq FROM walk w JOIN anchors a ON a.route = w.route AND a.place = w.place""")
def q_time_points(spark, d):
    """Where the time points of every route stand on its stops, some of which come twice."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    calls = roles.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("route"), F.row_number().over(w).alias("seq"), (F.col("l_suppkey") % 5).alias("stop"))
    stop = F.when((F.col("route") % 11 == 0) & (F.col("seq") == 1), F.lit(99)).otherwise(F.col("stop"))
    chosen = calls.where("seq % 2 = 1 OR route % 4 = 0")
    anchors = chosen.select("route", F.row_number().over(Window.partitionBy("route").orderBy("seq")).alias("place"), stop.alias("stop"), (F.col("seq") * 3).alias("minute"))
    return timetables.anchored(calls, anchors, ["route"]).select("route", "place", "stop", "minute", "seq")
