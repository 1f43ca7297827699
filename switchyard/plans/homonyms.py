"""Queries on names that stand for several places, and on stops that only their route's line can place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.operators import homonyms, linefill
from switchyard.plans import roles
from switchyard.plans.registry import query
from switchyard.plans.roles import sql_haversine
from switchyard.storage import materialize


def _network(spark, d) -> tuple[DataFrame, DataFrame]:
    """Customers as stops along their nation's line, the lines some thirty kilometres apart; every tenth stop of a line has
    the name of all lines' stops of that place and lies on the first line; every 23rd other one has no position. Every
    third stop is on a second route too."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("long")
    rows = roles.table(spark, d, "customer").select(k, n.alias("line"), F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).alias("pos"))
    shared = F.col("pos") % 10 == 0
    rows = rows.withColumns({
        "stop_id": F.when(shared, F.concat(F.lit("shared"), F.col("pos").cast("string"))).otherwise(F.concat(F.lit("c"), k.cast("string"))),
        "lat": 22.0 + F.col("pos") % 2000 * F.lit(0.004), "lon": 88.0 + F.col("line") * F.lit(0.3)})
    points = rows.where((shared & (F.col("line") == 0)) | (~shared & (k % 23 != 0))).select("stop_id", "lat", "lon")
    second = rows.where("pos % 3 = 0").select((F.col("line") * 2 + 1).alias("route_id"), "pos", "stop_id")
    return materialize(rows.select((F.col("line") * 2).alias("route_id"), "pos", "stop_id").unionByName(second), "homonym-calls"), materialize(points, "homonym-points")


_NETWORK = """r AS (SELECT c_custkey AS k, CAST(c_nationkey AS BIGINT) AS line, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos FROM customer),
s AS (SELECT *, CASE WHEN pos % 10 = 0 THEN 'shared' || pos ELSE 'c' || k END AS stop_id, CAST(22.0 AS DOUBLE) + pos % 2000 * CAST(0.004 AS DOUBLE) AS lat, CAST(88.0 AS DOUBLE) + line * CAST(0.3 AS DOUBLE) AS lon FROM r),
points AS (SELECT stop_id, lat, lon FROM s WHERE (pos % 10 = 0 AND line = 0) OR (pos % 10 <> 0 AND k % 23 <> 0)),
calls AS (SELECT line * 2 AS route_id, pos, stop_id FROM s UNION ALL SELECT line * 2 + 1, pos, stop_id FROM s WHERE pos % 3 = 0)"""


@query(f"""WITH {_NETWORK},
n AS (SELECT c.route_id, c.pos, c.stop_id, lag(p.lat) OVER w AS blat, lag(p.lon) OVER w AS blon, lead(p.lat) OVER w AS alat, lead(p.lon) OVER w AS alon,
 row_number() OVER w AS i, count(*) OVER (PARTITION BY c.route_id) AS n FROM calls c LEFT JOIN points p USING (stop_id) WINDOW w AS (PARTITION BY c.route_id ORDER BY c.pos)),
m AS (SELECT *, CASE WHEN {sql_haversine('blat', 'blon', 'alat', 'alon')} <= 6000 THEN 2 WHEN i = 1 AND alat IS NOT NULL THEN 1 WHEN i = n AND blat IS NOT NULL THEN 0 END AS how FROM n)
SELECT route_id, stop_id, round_even(CASE how WHEN 2 THEN (blat + alat) / 2 WHEN 1 THEN alat ELSE blat END, 6) AS lat, round_even(CASE how WHEN 2 THEN (blon + alon) / 2 WHEN 1 THEN alon ELSE blon END, 6) AS lon
FROM m WHERE how IS NOT NULL QUALIFY row_number() OVER (PARTITION BY route_id, stop_id ORDER BY pos) = 1""")
def q_stop_contexts(spark, d):
    """Where each route sees each of its stops by those beside it."""
    seen = homonyms.contexts(*_network(spark, d))
    return seen.select("route_id", "stop_id", F.bround("lat", 6).alias("lat"), F.bround("lon", 6).alias("lon"))


@query()
def q_homonym_split(spark, d):
    """New ids of stops that share a name, and how many routes each took over."""
    return homonyms.split(*_network(spark, d))[2].select("stop_id", "new_id", "routes", F.bround("km", 3).alias("km"), "by", "round")


@query()
def q_line_interpolation(spark, d):
    """Stops without a position placed on their route's line."""
    calls, points = _network(spark, d)
    own = points.where("stop_id LIKE 'c%'").withColumn("method", F.lit("survey"))
    ends = calls.groupBy("route_id").agg(F.max("pos").alias("n"), F.min("pos").alias("m"))
    at = F.transform(F.sequence("m", "n"), lambda i: F.struct((22.0 + i % 2000 * F.lit(0.004)).alias("lat"), (88.0005 + F.floor(F.col("route_id") / 2) * F.lit(0.3)).alias("lon")))
    calls = calls.where("stop_id LIKE 'c%'")
    return linefill.interpolated(calls, own, ends.select("route_id", at.alias("line"))).select("stop_id", "lat", F.bround("lon", 5).alias("lon"), "routes", "route_id", "before_id", "after_id")
