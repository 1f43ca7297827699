"""The transit queries over the driver's tables, each with the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.functions import clock, geo, names
from switchyard.operators import matching, paths, schedule, sequence, spatial
from switchyard.operators.components import components
from switchyard.plans import roles
from switchyard.plans.registry import QUERIES, SQL
from switchyard.plans.registry import query as _query
from switchyard.storage import discard, materialize
from switchyard.plans.roles import KEYS, ORDER, SQL_DEPARTURES, SQL_ORDER, SQL_STOPS, SQL_TIMES, sql_haversine

def _metres(column: str = "hop_m"):
    return F.floor(column).cast("long")


_LAG = sql_haversine(f"lag(lat) OVER ({SQL_ORDER})", f"lag(lon) OVER ({SQL_ORDER})", "lat", "lon")


@_query(f"""WITH {SQL_TIMES}, h AS (SELECT l_orderkey, CAST(floor({_LAG}) AS BIGINT) AS m FROM times)
SELECT l_orderkey AS trip_id, count(*) AS n_stops, CAST(coalesce(sum(m), 0) AS BIGINT) AS total_m, CAST(coalesce(max(m), 0) AS BIGINT) AS longest_m FROM h GROUP BY l_orderkey""")
def q_seq_hop_stats(spark, d):
    """Stops, length and longest hop of every trip."""
    hops = sequence.hops(roles.stop_times(spark, d), KEYS, ORDER).withColumn("m", _metres())
    return hops.groupBy(F.col("l_orderkey").alias("trip_id")).agg(F.count(F.lit(1)).alias("n_stops"), F.coalesce(F.sum("m"), F.lit(0)).alias("total_m"), F.coalesce(F.max("m"), F.lit(0)).alias("longest_m"))


@_query(f"""WITH {SQL_TIMES}, n AS (SELECT *, l_suppkey % 4 AS zone FROM times),
g AS (SELECT *, lag(zone) OVER ({SQL_ORDER}) AS was FROM n),
k AS (SELECT * FROM g WHERE was IS NULL OR was <> zone)
SELECT l_orderkey AS trip_id, CAST(row_number() OVER ({SQL_ORDER}) AS INTEGER) AS seq, zone FROM k""")
def q_consecutive_dedupe(spark, d):
    """Zones each trip passes, repeats in a row collapsed."""
    zones = roles.stop_times(spark, d).withColumn("zone", F.col("l_suppkey") % 4)
    return sequence.drop_repeats(zones, KEYS, ORDER, "zone").select(F.col("l_orderkey").alias("trip_id"), "seq", "zone")


_LEAD = sql_haversine("lat", "lon", f"lead(lat) OVER ({SQL_ORDER})", f"lead(lon) OVER ({SQL_ORDER})")
_OVER = sql_haversine(f"lag(lat) OVER ({SQL_ORDER})", f"lag(lon) OVER ({SQL_ORDER})", f"lead(lat) OVER ({SQL_ORDER})", f"lead(lon) OVER ({SQL_ORDER})")


@_query(f"""WITH {SQL_TIMES}, h AS (SELECT l_orderkey, {_LAG} AS b, {_LEAD} AS a, {_OVER} AS o FROM times)
SELECT l_orderkey % 50 AS bucket, CAST(count(*) FILTER (WHERE b > 5000 AND a > 5000 AND a + b > 3 * o) AS BIGINT) AS spikes,
CAST(count(*) FILTER (WHERE b > 20000) AS BIGINT) AS long_hops, count(*) AS n FROM h GROUP BY l_orderkey % 50""")
def q_spikes_long_hops(spark, d):
    """Out-and-back spikes and long hops."""
    flagged = sequence.spikes_and_long_hops(roles.stop_times(spark, d), KEYS, ORDER)
    return flagged.groupBy((F.col("l_orderkey") % 50).alias("bucket")).agg(F.count_if("is_spike").alias("spikes"), F.count_if("is_long").alias("long_hops"), F.count(F.lit(1)).alias("n"))


@_query(f"""WITH t AS (SELECT *, row_number() OVER ({SQL_ORDER}) AS seq FROM lineitem),
e AS (SELECT l_orderkey, seq, CAST((seq - 1) * 120 AS DOUBLE) AS est, CASE WHEN l_linenumber % 3 = 0 THEN CAST(seq * 100 + l_partkey % 40 AS DOUBLE) END AS anc FROM t),
f AS (SELECT *, last_value(CASE WHEN anc IS NOT NULL THEN seq END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lp,
    first_value(CASE WHEN anc IS NOT NULL THEN seq END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rp FROM e),
r AS (SELECT f.l_orderkey, f.seq, CASE WHEN l.anc IS NULL AND r.anc IS NULL THEN f.est WHEN l.anc IS NULL THEN r.anc - (r.est - f.est) WHEN r.anc IS NULL THEN l.anc + f.est - l.est
    WHEN r.est = l.est THEN l.anc ELSE l.anc + (r.anc - l.anc) * (f.est - l.est) / (r.est - l.est) END AS raw
    FROM f LEFT JOIN f l ON l.l_orderkey = f.l_orderkey AND l.seq = f.lp LEFT JOIN f r ON r.l_orderkey = f.l_orderkey AND r.seq = f.rp),
b AS (SELECT l_orderkey, seq, raw - first_value(raw) OVER (PARTITION BY l_orderkey ORDER BY seq) AS raw FROM r)
SELECT l_orderkey AS trip_id, CAST(seq AS INTEGER) AS seq, CAST(floor(1000 * max(raw) OVER (PARTITION BY l_orderkey ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 0.5) AS BIGINT) AS ms FROM b""")
def q_anchor_interpolate(spark, d):
    """Stop times between timed stops."""
    rows = roles.stop_times(spark, d).withColumn("seq", F.row_number().over(sequence.along(KEYS, ORDER)))
    rows = rows.withColumns({"est": ((F.col("seq") - 1) * 120).cast("double"), "anc": F.when(F.col("l_linenumber") % 3 == 0, (F.col("seq") * 100 + F.col("l_partkey") % 40).cast("double"))})
    timed = sequence.interpolate_anchors(rows, KEYS, ["seq"], "est", "anc")
    return timed.select(F.col("l_orderkey").alias("trip_id"), "seq", F.floor(F.lit(1000) * F.col("time") + F.lit(0.5)).cast("long").alias("ms"))


@_query(f"""SELECT l_orderkey AS trip_id, l_linenumber, l_partkey, l_suppkey, CAST(max(CAST(l_quantity AS BIGINT)) OVER ({SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS clamped FROM lineitem""")
def q_running_clamp(spark, d):
    """Values that never fall along a trip."""
    rows = roles.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("trip_id"), "l_linenumber", "l_partkey", "l_suppkey", F.floor("l_quantity").cast("long").alias("q"))
    return rows.select("trip_id", *ORDER, F.max("q").over(sequence.so_far(["trip_id"], ORDER)).alias("clamped"))


@_query(f"""WITH {SQL_DEPARTURES}, f AS (SELECT *, CASE WHEN minute < lag(minute) OVER (PARTITION BY user_id ORDER BY event_id) - 1 THEN 1 ELSE 0 END AS fell FROM deps)
SELECT event_id, CAST(minute + 1440 * sum(fell) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS unwrapped FROM f""")
def q_rollover_unwrap(spark, d):
    """Minutes of the day that go on past midnight."""
    return sequence.unwrap_midnight(roles.departures(spark, d), ["user_id"], ["event_id"], "minute").select("event_id", F.col("unwrapped").cast("long").alias("unwrapped"))


@_query("""WITH p AS (SELECT o_orderkey AS trip_id, (o_orderkey * 37 % 86400) AS f, (o_orderkey * 53 % 86400) AS l,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 300 + o_orderkey % 4 * 60 END AS hp, 300 + o_orderkey % 3 * 60 AS ho FROM orders),
w AS (SELECT trip_id, f AS a, CASE WHEN l <= f THEN l + 86400 ELSE l END + 60 AS b, coalesce(hp, ho) AS hp, coalesce(ho, hp) AS ho FROM p),
c AS (SELECT trip_id, a, b, hp, ho, a AS cut FROM w UNION SELECT trip_id, a, b, hp, ho, b FROM w
    UNION SELECT trip_id, a, b, hp, ho, e.x FROM w, (VALUES (25200), (36000), (61200), (72000)) e(x) WHERE e.x > a AND e.x < b),
s AS (SELECT trip_id, b, hp, ho, cut, lead(cut) OVER (PARTITION BY trip_id ORDER BY cut) AS nxt FROM c),
h AS (SELECT trip_id, cut, nxt, CASE WHEN (cut >= 25200 AND cut < 36000) OR (cut >= 61200 AND cut < 72000) THEN hp ELSE ho END AS h FROM s WHERE nxt IS NOT NULL),
m AS (SELECT *, CASE WHEN h = lag(h) OVER (PARTITION BY trip_id ORDER BY cut) THEN 0 ELSE 1 END AS fresh FROM h),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY trip_id ORDER BY cut ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM m)
SELECT trip_id, min(cut) AS start_s, max(nxt) AS end_s, min(h) AS headway_s, CAST(floor((max(nxt) - min(cut)) / min(h)) AS BIGINT) AS n_departures FROM i GROUP BY trip_id, island""")
def q_freq_windows(spark, d):
    """Service windows by headway."""
    o = roles.table(spark, d, "orders").select(F.col("o_orderkey").alias("trip_id"))
    k = F.col("trip_id")
    o = o.select("trip_id", (k * 37 % 86400).alias("f"), (k * 53 % 86400).alias("l"), F.when(k % 5 != 0, 300 + k % 4 * 60).alias("hp"), (300 + k % 3 * 60).alias("ho"))
    return schedule.frequency_windows(o, ["trip_id"], "f", "l", "hp", "ho").withColumn("n_departures", schedule.departures(F.col("start_s"), F.col("end_s"), F.col("headway_s")))


@_query(f"""WITH {SQL_DEPARTURES}, p AS (SELECT event_type, us, minute, lag(us) OVER (PARTITION BY event_type ORDER BY event_id) AS was, lag(minute) OVER (PARTITION BY event_type ORDER BY event_id) AS wasm FROM deps)
SELECT event_type, count(*) AS n, CAST(floor(median(us - was)) AS BIGINT) AS median_us FROM p
WHERE was IS NOT NULL AND ((minute >= 420 AND minute < 600 AND wasm >= 420 AND wasm < 600) OR (minute >= 1020 AND minute < 1200 AND wasm >= 1020 AND wasm < 1200)) GROUP BY event_type""")
def q_headway_median(spark, d):
    """Median gap between departures of a type in the peaks."""
    gaps = sequence.lagged(roles.departures(spark, d), ["event_type"], "event_id", ["us", "minute"], 1 << 16)
    inside = lambda a, b: F.col("minute").between(a, b - 1) & F.col("was_minute").between(a, b - 1)
    gaps = gaps.where(inside(420, 600) | inside(1020, 1200))
    return gaps.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.floor(F.median(F.col("us") - F.col("was_us"))).cast("long").alias("median_us"))


@_query(f"""WITH {SQL_DEPARTURES}, g AS (SELECT user_id, CAST(ts AS DATE) AS day, min(minute) AS a, max(minute) AS b, count(*) AS n FROM deps GROUP BY ALL)
SELECT user_id, CAST(day AS VARCHAR) AS day, n, CAST(floor(10 * CASE WHEN n <= 1 THEN 240.0 ELSE least(greatest(CAST(b - a AS DOUBLE) / n, 30.0), 240.0) END) AS BIGINT) AS headway_tenths FROM g""")
def q_headway_span(spark, d):
    """Headway from span and count."""
    g = roles.departures(spark, d).groupBy("user_id", F.to_date("ts").cast("string").alias("day")).agg(F.min("minute").alias("a"), F.max("minute").alias("b"), F.count(F.lit(1)).alias("n"))
    return g.select("user_id", "day", "n", F.floor(10 * schedule.span_headway(F.col("a"), F.col("b"), F.col("n"))).cast("long").alias("headway_tenths"))


@_query("""WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey AS route_id, o_orderkey AS trip_id, n AS n_trips FROM r WHERE i = n // 2 + 1""")
def q_upper_median_trip(spark, d):
    """The upper median trip of each route."""
    w = Window.partitionBy("o_custkey")
    r = roles.table(spark, d, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w.orderBy("o_totalprice", "o_orderkey")).alias("i"), F.count(F.lit(1)).over(w).alias("n"))
    return r.where(F.col("i") == F.floor(F.col("n") / 2) + 1).select(F.col("o_custkey").alias("route_id"), F.col("o_orderkey").alias("trip_id"), F.col("n").alias("n_trips"))


@_query("""WITH p AS (SELECT l_orderkey, string_agg(CAST(l_suppkey % 5 AS VARCHAR), '-' ORDER BY l_linenumber, l_partkey, l_suppkey) AS pattern FROM lineitem GROUP BY l_orderkey)
SELECT pattern, count(*) AS n FROM p GROUP BY pattern ORDER BY n DESC, pattern LIMIT 25""")
def q_pattern_topk(spark, d):
    """The most common stop patterns."""
    rows = F.array_sort(F.collect_list(F.struct(*ORDER)))
    p = roles.table(spark, d, "lineitem").groupBy("l_orderkey").agg(rows.alias("r"))
    p = p.select(F.array_join(F.transform("r", lambda x: (x["l_suppkey"] % 5).cast("string")), "-").alias("pattern"))
    return p.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "pattern").limit(25)


_HOPS_SQL = f"""WITH t AS (SELECT l_orderkey, l_suppkey % 20 AS a, lead(l_suppkey % 20) OVER ({SQL_ORDER}) AS b, CAST(l_quantity AS BIGINT) AS q, {{row}} FROM lineitem),
m AS (SELECT a, b, count(*) AS n, CAST(floor(2 * median(q)) AS BIGINT) AS twice_median FROM t WHERE b IS NOT NULL GROUP BY a, b)"""


@_query(_HOPS_SQL.format(row="1 AS one") + """, x AS (SELECT x.i AS a, y.i AS b FROM range(0, 20) x(i), range(0, 20) y(i))
SELECT x.a, x.b, coalesce(m.n, 0) AS n, coalesce(m.twice_median, 1) AS twice_median FROM x LEFT JOIN m ON m.a = x.a AND m.b = x.b""")
def q_hop_median(spark, d):
    """Median hop value of every zone pair, with a floor where no trip runs."""
    rows = roles.table(spark, d, "lineitem").select("l_orderkey", *ORDER, (F.col("l_suppkey") % 20).alias("a"), F.floor("l_quantity").cast("long").alias("q"))
    hops = rows.withColumn("b", F.lead("a").over(sequence.along(KEYS, ORDER))).where("b IS NOT NULL")
    medians = hops.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.floor(2 * F.median("q")).cast("long").alias("twice_median"))
    every = spark.range(400).select(F.floor(F.col("id") / 20).alias("a"), (F.col("id") % 20).alias("b"))
    return every.join(medians, ["a", "b"], "left").select("a", "b", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("twice_median", F.lit(1)).alias("twice_median"))


@_query(_HOPS_SQL.format(row=f"row_number() OVER ({SQL_ORDER}) AS seq") + """
SELECT t.l_orderkey AS trip_id, CAST(t.seq AS INTEGER) AS seq, CAST(coalesce(sum(m.twice_median) OVER (PARTITION BY t.l_orderkey ORDER BY t.seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS reached
FROM t LEFT JOIN m ON m.a = t.a AND m.b = t.b""")
def q_cum_pattern(spark, d):
    """Cumulative median times along trips."""
    w = sequence.along(KEYS, ORDER)
    rows = roles.table(spark, d, "lineitem").select("l_orderkey", *ORDER, (F.col("l_suppkey") % 20).alias("a"), F.floor("l_quantity").cast("long").alias("q"))
    rows = rows.withColumns({"b": F.lead("a").over(w), "seq": F.row_number().over(w)})
    medians = rows.where("b IS NOT NULL").groupBy("a", "b").agg(F.floor(2 * F.median("q")).cast("long").alias("m"))
    timed = rows.join(F.broadcast(medians), ["a", "b"], "left")  # at most 20 * 20 rows
    return timed.select(F.col("l_orderkey").alias("trip_id"), "seq", F.coalesce(F.sum("m").over(sequence.so_far(KEYS, ["seq"])), F.lit(0)).alias("reached"))


@_query("""WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey) AS i FROM orders)
SELECT r.o_custkey AS route_id, l.l_orderkey AS trip_id, count(*) AS n_stops FROM r JOIN lineitem l ON l.l_orderkey = r.o_orderkey WHERE r.i = 1 GROUP BY ALL""")
def q_template_trip(spark, d):
    """One template trip a route, and its stop times."""
    pref = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    best = roles.table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.struct(pref.alias("p"), "o_orderkey")).alias("b"))
    chosen = best.select(F.col("o_custkey").alias("route_id"), F.col("b.o_orderkey").alias("trip_id"))
    lines = roles.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("trip_id")).join(chosen.select("trip_id"), "trip_id", "left_semi")
    return chosen.join(lines.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_stops")), "trip_id").select("route_id", "trip_id", "n_stops")


@_query(f"""WITH t AS (SELECT l_orderkey, l_suppkey, row_number() OVER ({SQL_ORDER}) AS seq, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT l_orderkey AS trip_id, 0 AS direction, CAST(seq AS INTEGER) AS seq, l_suppkey AS stop_id FROM t
UNION ALL SELECT l_orderkey, 1, CAST(n + 1 - seq AS INTEGER), l_suppkey FROM t""")
def q_mirror_direction(spark, d):
    """Both directions of every trip."""
    rows = roles.stop_times(spark, d).select("l_orderkey", F.col("l_suppkey").alias("stop_id"), F.row_number().over(sequence.along(KEYS, ORDER)).alias("seq"))
    return sequence.mirrored(rows, KEYS).select(F.col("l_orderkey").alias("trip_id"), "direction", "seq", "stop_id")


@_query("""WITH used AS (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey % 3 <> 0), i AS (SELECT l_suppkey, row_number() OVER (ORDER BY l_suppkey) - 1 AS idx FROM used)
SELECT i.idx AS stop_idx, count(*) AS n FROM lineitem l JOIN i ON i.l_suppkey = l.l_suppkey GROUP BY i.idx""")
def q_dense_index(spark, d):
    """Dense numbers of used stops, without one task sorting all: counts before each range partition give the offsets."""
    counts = roles.table(spark, d, "lineitem").where(F.col("l_suppkey") % 3 != 0).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    # written once, so that both uses see the same partitions
    ranged = materialize(counts.repartitionByRange("l_suppkey").withColumn("part", F.spark_partition_id()), "dense-index")
    ranged = ranged.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("l_suppkey")))
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranged.join(F.broadcast(before), "part").select((F.col("before") + F.col("at") - 1).alias("stop_idx"), "n")  # a row a partition


@_query("""WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part)
SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY p_partkey) = 1 THEN slug ELSE slug || '_' || CAST(row_number() OVER (PARTITION BY slug ORDER BY p_partkey) AS VARCHAR) END AS stop_id FROM s""")
def q_slug_suffix(spark, d):
    """Unique slugs of names."""
    s = roles.table(spark, d, "part").select("p_partkey", names.slug(F.col("p_name")).alias("slug"))
    return matching.slugs(s, "slug", "p_partkey").select("p_partkey", "stop_id")


def _sql_replace(text: str, pairs: list) -> str:
    for old, new in pairs:
        text = f"replace({text}, '{old}', '{new}')"
    return text


def _sql_collapse(text: str) -> str:
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        text = f"regexp_replace({text}, '{c}{c}+', '{c}', 'g')"
    return text


def _sql_norm(text: str) -> str:
    s = f"replace(lower({text}), '&', 'and')"
    for old, new in names.ABBREVIATIONS[1:]:
        s = f"regexp_replace({s}, '{old}', '{new}', 'g')"
    return _sql_collapse(_sql_replace(f"regexp_replace({s}, '[^a-z0-9]', '', 'g')", names.PHONETIC))


@_query(f"""WITH k AS (SELECT p_name, {_sql_norm('p_name')} AS key FROM part), u AS (SELECT key, p_name, count(*) AS n FROM k GROUP BY key, p_name),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, length(p_name) DESC, p_name) AS i, count(*) OVER (PARTITION BY key) AS spellings, sum(n) OVER (PARTITION BY key) AS uses FROM u)
SELECT key, p_name AS canonical, spellings, CAST(uses AS BIGINT) AS uses FROM r WHERE i = 1""")
def q_canonical_name(spark, d):
    """Canonical spelling of each name key."""
    return matching.canonical_names(roles.table(spark, d, "part").select(names.norm_key(F.col("p_name")).alias("key"), "p_name"), "key", "p_name")


_BARE = "regexp_replace(x, '\\(.*?\\)', '', 'g')"
_LOOSE = f"regexp_replace(regexp_replace({_sql_norm(_BARE)}, '(?:{names.GENERIC_ENDS})+$', ''), '(road|street|avenue)$', '')"
_SKEL = _sql_collapse(f"regexp_replace(regexp_replace({_sql_replace(f'''regexp_replace(lower({_BARE}), '[^a-z0-9]', '', 'g')''', names.SKELETON)}, 'h$', ''), '[aeiou]', '', 'g')")


@_query(f"""WITH n AS (SELECT DISTINCT p_name AS x FROM part UNION SELECT DISTINCT n_name FROM nation UNION SELECT DISTINCT c_name FROM customer),
k AS (SELECT x, {_LOOSE} AS l, {_sql_norm('x')} AS s, {_SKEL} AS skeleton FROM n)
SELECT x AS name, CASE WHEN length(l) >= 4 THEN l ELSE s END AS loose, skeleton FROM k""")
def q_loose_skeleton_keys(spark, d):
    """Loose and skeleton keys of names."""
    n = roles.table(spark, d, "part").select(F.col("p_name").alias("name")).union(roles.table(spark, d, "nation").select("n_name")).union(roles.table(spark, d, "customer").select("c_name")).distinct()
    return n.select("name", names.loose_key(F.col("name")).alias("loose"), names.skeleton_key(F.col("name")).alias("skeleton"))


def _sql_token(w: str) -> str:
    case = "CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in (names.SHORT_WORDS | names.NUMBER_WORDS).items()) + " ELSE w END"
    s = f"regexp_replace({case}, '([bcdgkpst])h', '\\1', 'g')"
    for old, new in names.TOKEN_FOLDS:
        s = f"regexp_replace({s}, '{old}', '{new}', 'g')"
    return f"CASE WHEN regexp_full_match({case}, '[0-9]+') THEN {case} ELSE {_sql_collapse(s)} END"


@_query(f"""WITH n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT c_name FROM customer),
t AS (SELECT name, unnest(string_split(trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '([a-z])([0-9])', '\\1 \\2', 'g'), '([0-9])([a-z])', '\\1 \\2', 'g'), '[^a-z0-9]+', ' ', 'g')), ' ')) AS w FROM n)
SELECT {_sql_token('w')} AS token, count(*) AS n FROM t WHERE w <> '' GROUP BY 1""")
def q_token_normalise(spark, d):
    """Search tokens of names and how often they occur."""
    n = roles.table(spark, d, "part").select(F.col("p_name").alias("name")).union(roles.table(spark, d, "customer").select("c_name")).distinct()
    return n.select(F.explode(names.tokens(F.col("name"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


_TIER_KEYS = "lower({x}) AS k1, right(lower({x}), 9) AS k2, right(lower({x}), 2) AS k3"


@_query(f"""WITH l AS (SELECT s_suppkey, {_TIER_KEYS.format(x='s_name')} FROM supplier), r AS (SELECT c_custkey, {_TIER_KEYS.format(x='c_name')} FROM customer),
f AS (SELECT s_suppkey, c_custkey, 1 AS tier FROM l JOIN r USING (k1) UNION ALL SELECT s_suppkey, c_custkey, 2 FROM l JOIN r USING (k2) UNION ALL SELECT s_suppkey, c_custkey, 3 FROM l JOIN r USING (k3)),
b AS (SELECT *, dense_rank() OVER (PARTITION BY s_suppkey ORDER BY tier) AS i FROM f) SELECT s_suppkey, c_custkey, tier FROM b WHERE i = 1""")
def q_name_tier_join(spark, d):
    """Names joined by the first key that has partners."""
    def keyed(df, key, name):
        x = F.lower(name)
        return df.select(key, x.alias("k1"), F.right(x, F.lit(9)).alias("k2"), F.right(x, F.lit(2)).alias("k3"))

    left = keyed(roles.table(spark, d, "supplier"), "s_suppkey", "s_name")
    right = keyed(roles.table(spark, d, "customer"), "c_custkey", "c_name")
    return matching.tier_join(left, right, ["k1", "k2", "k3"], left_id="s_suppkey", right_id="c_custkey")


@_query("""SELECT DISTINCT p_partkey, a AS alias FROM (SELECT p_partkey, unnest([p_name, lower(p_name), split_part(p_name, ' ', 1), p_brand]) AS a FROM part)""")
def q_alias_expand(spark, d):
    """All spellings of each name once."""
    all_names = F.array_distinct(F.array("p_name", F.lower("p_name"), F.split("p_name", " ")[0], "p_brand"))
    return roles.table(spark, d, "part").select("p_partkey", F.explode(all_names).alias("alias"))


@_query("""WITH l AS (SELECT o_orderkey AS id_left, o_custkey * 10 + o_orderkey % 10 AS k FROM orders), r AS (SELECT c_custkey AS id_right, c_custkey * 10 + c_custkey % 10 AS k FROM customer),
c AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY k) = 1 THEN k END AS m FROM l) SELECT coalesce(c.k, r.k) AS k, id_left, id_right FROM c FULL JOIN r ON c.m = r.k""")
def q_merge_unique_key(spark, d):
    """Two lists merged where the left key is unique."""
    # a customer's orders are split in ten, so that whole tables hold keys that are unique, repeated and without a partner
    left = roles.table(spark, d, "orders").select(F.col("o_orderkey").alias("id_left"), (F.col("o_custkey") * 10 + F.col("o_orderkey") % 10).alias("k"))
    right = roles.table(spark, d, "customer").select(F.col("c_custkey").alias("id_right"), (F.col("c_custkey") * 10 + F.col("c_custkey") % 10).alias("k"))
    return matching.merge_unique(left, right, "k", "id_left", "id_right")


_MASKS = "CASE {k} % 4 WHEN 0 THEN '1111100' WHEN 1 THEN '0000011' WHEN 2 THEN '0000000' ELSE '1010101' END"


@_query(f"""WITH dirs AS (SELECT s_suppkey AS route_id, x.d AS direction FROM supplier, (VALUES ('0'), ('1')) x(d)),
p AS (SELECT c_custkey AS period_id, c_custkey % 120 AS route_id, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN '0' ELSE '1' END AS direction, {_MASKS.format(k='c_custkey')} AS mask FROM customer),
v AS (SELECT * FROM p WHERE mask <> '0000000'), has AS (SELECT DISTINCT route_id FROM v)
SELECT r.route_id, r.direction, v.period_id, coalesce(v.mask, '1111111') AS mask FROM dirs r LEFT JOIN v ON v.route_id = r.route_id AND (v.direction = '' OR v.direction = r.direction)
WHERE v.period_id IS NOT NULL OR r.route_id NOT IN (SELECT route_id FROM has)""")
def q_wildcard_period_join(spark, d):
    """Service periods of each route and direction; a blank direction fits both, routes without periods run daily."""
    dirs = roles.table(spark, d, "supplier").select(F.col("s_suppkey").alias("route_id"), F.explode(F.array(F.lit("0"), F.lit("1"))).alias("direction"))
    k = F.col("c_custkey")
    mask = F.when(k % 4 == 0, "1111100").when(k % 4 == 1, "0000011").when(k % 4 == 2, "0000000").otherwise("1010101")
    p = roles.table(spark, d, "customer").select(k.alias("period_id"), (k % 120).alias("route_id"), F.when(k % 3 == 0, "").when(k % 3 == 1, "0").otherwise("1").alias("direction"), mask.alias("mask"))
    valid = p.where(clock.mask_valid(F.col("mask")))
    both = valid.withColumn("direction", F.explode(F.when(F.col("direction") == "", F.array(F.lit("0"), F.lit("1"))).otherwise(F.array("direction"))))
    met = dirs.join(both, ["route_id", "direction"])
    daily = dirs.join(valid.select("route_id").distinct(), "route_id", "left_anti").select("route_id", "direction", F.lit(None).cast("long").alias("period_id"), F.lit("1111111").alias("mask"))
    return met.unionByName(daily)


_DIST = sql_haversine("a.lat", "a.lon", "b.lat", "b.lon")


def _stop_pairs(spark, d, metres: float) -> DataFrame:
    a = roles.stops(spark, d)
    b = a.select(*[F.col(c).alias(f"{c}2") for c in ("stop_id", "s_name", "s_nationkey", "lat", "lon")])
    return spatial.radius_join(a, b, metres, max_lat=30.0)


@_query(f"""WITH {SQL_STOPS} SELECT a.stop_id AS a, b.stop_id AS b, CAST(floor({_DIST}) AS BIGINT) AS m FROM stops a JOIN stops b ON a.stop_id < b.stop_id AND {_DIST} <= 5000""")
def q_radius_join(spark, d):
    """Stop pairs within 5 km."""
    return _stop_pairs(spark, d, 5000).where("stop_id < stop_id2").select(F.col("stop_id").alias("a"), F.col("stop_id2").alias("b"), _metres("distance_m").alias("m"))


_TRANSFER_SQL = f"""WITH {SQL_STOPS}, t AS (SELECT a.stop_id AS from_id, b.stop_id AS to_id, CAST(ceil((120 + {_DIST}) / 60) * 60 AS BIGINT) AS seconds
FROM stops a JOIN stops b ON a.stop_id <> b.stop_id AND {_DIST} <= 8000 AND a.s_nationkey % 3 = b.s_nationkey % 3 AND NOT (a.s_nationkey % 4 = 0 AND b.s_nationkey % 4 = 0))"""


#: Metres of a transfer, and which two nations' stops have one.
_TRANSFER_M, _TRANSFER_GROUPS = 8000, "s_nationkey % 3 = s_nationkey2 % 3 AND NOT (s_nationkey % 4 = 0 AND s_nationkey2 % 4 = 0)"


def _transfers(spark, d) -> DataFrame:
    near = _stop_pairs(spark, d, _TRANSFER_M).where(f"stop_id < stop_id2 AND {_TRANSFER_GROUPS}")
    one = near.select(F.col("stop_id").alias("from_id"), F.col("stop_id2").alias("to_id"), geo.transfer_seconds(F.col("distance_m")).alias("seconds"))
    return one.unionByName(one.select(F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"), "seconds"))


@_query(_TRANSFER_SQL + " SELECT from_id, to_id, seconds FROM t")
def q_transfers(spark, d):
    """Transfers between near stops of one group, both directions."""
    return _transfers(spark, d)


@_query(_TRANSFER_SQL + f""", c AS (SELECT s_suppkey AS x, s_suppkey % 37 + 1 AS y FROM supplier WHERE s_suppkey % 4 = 1),
n AS (SELECT DISTINCT least(x, y) AS p, greatest(x, y) AS q FROM c WHERE x <> y), k AS (SELECT p, q, {_DIST} AS m FROM n JOIN stops a ON a.stop_id = p JOIN stops b ON b.stop_id = q WHERE {_DIST} <= 30000),
o AS (SELECT p, q, CAST(ceil((120 + m) / 60) * 60 AS BIGINT) AS seconds FROM k WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.from_id = p AND t.to_id = q))
SELECT from_id, to_id, seconds, 'near' AS kind FROM t UNION ALL SELECT p, q, seconds, 'listed' FROM o UNION ALL SELECT q, p, seconds, 'listed' FROM o""")
def q_interchange_override(spark, d):
    """Listed interchanges added to the transfers where there is none yet."""
    t = _transfers(spark, d)
    c = roles.stops(spark, d).where("stop_id % 4 = 1").select(F.col("stop_id").alias("x"), (F.col("stop_id") % 37 + 1).alias("y")).where("x <> y")
    pairs = c.select(F.least("x", "y").alias("p"), F.greatest("x", "y").alias("q")).distinct()
    at = roles.stops(spark, d)
    a = at.select(F.col("stop_id").alias("p"), "s_nationkey", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    b = at.select(F.col("stop_id").alias("q"), F.col("s_nationkey").alias("s_nationkey2"), "lat", "lon")
    far = pairs.join(a, "p").join(b, "q").withColumn("m", geo.haversine_m(F.col("lat1"), F.col("lon1"), F.col("lat"), F.col("lon"))).where("m <= 30000")
    # whether a pair has a transfer is for its own distance and nations to say: no transfer is made a second time
    new = far.where(~(F.coalesce((F.col("m") <= _TRANSFER_M) & F.expr(_TRANSFER_GROUPS), F.lit(False)))).select(F.col("p").alias("from_id"), F.col("q").alias("to_id"), geo.transfer_seconds(F.col("m")).alias("seconds"))
    both = new.unionByName(new.select(F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"), "seconds"))
    return t.withColumn("kind", F.lit("near")).unionByName(both.withColumn("kind", F.lit("listed")))


_WEIGHED = f"CASE WHEN b.stop_id % 2 = 0 THEN floor({_DIST}) * 16 ELSE floor({_DIST}) * 10 END"


@_query(f"""WITH {SQL_STOPS}, p AS (SELECT a.stop_id AS stop_id, b.stop_id AS area_id, CAST({_WEIGHED} AS BIGINT) AS w, row_number() OVER (PARTITION BY a.stop_id ORDER BY {_WEIGHED}, b.stop_id) AS i
FROM stops a JOIN stops b ON a.stop_id <> b.stop_id AND b.stop_id % 10 < 5 AND {_DIST} <= 6000) SELECT stop_id, area_id, w FROM p WHERE i = 1""")
def q_nearest_area(spark, d):
    """The nearest area of each stop, towns counted farther."""
    s = roles.stops(spark, d).where("stop_id IS NOT NULL").select("stop_id", "lat", "lon")
    # areas of one kind at one place are alike but for their ids, of which the least wins
    kind = (F.col("stop_id") % 2 == 0).alias("town")
    areas = s.where("stop_id % 10 < 5").groupBy(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), kind)
    areas = areas.agg(F.min("stop_id").alias("area_id"))
    weight = F.when(F.col("town"), _metres("distance_m") * 16).otherwise(_metres("distance_m") * 10).alias("w")

    def away_of(places: DataFrame, reach: int) -> DataFrame:
        near = spatial.radius_join(places, areas, reach, max_lat=30.0).where("lat <> lat2 OR lon <> lon2")
        return spatial.nearest(near.select(F.struct("lat", "lon").alias("at"), weight, "area_id"), "at", "w", "area_id")

    # what lies past the small circle weighs ten a metre at least, so only places that found nothing lighter look further
    places = s.select("lat", "lon").distinct()
    close = away_of(places, 800).where("w < 8000")
    away = close.unionByName(away_of(places.withColumn("at", F.struct("lat", "lon")).join(close.select("at"), "at", "left_anti").select("lat", "lon"), 6000))
    # at a stop's own place its neighbours in order of their ids are enough
    w = Window.partitionBy("lat", "lon").orderBy("stop_id")
    area = F.when(F.col("stop_id") % 10 < 5, F.col("stop_id"))
    first = F.first(area, ignorenulls=True)
    here = s.select("stop_id", F.struct("lat", "lon").alias("at"), F.coalesce(first.over(w.rowsBetween(Window.unboundedPreceding, -1)), first.over(w.rowsBetween(1, Window.unboundedFollowing))).alias("own"))
    met = here.join(away, "at", "left")
    both = F.least(F.when(F.col("own").isNotNull(), F.struct(F.lit(0).cast("long").alias("w"), F.col("own").alias("area_id"))), F.when(F.col("area_id").isNotNull(), F.struct("w", "area_id")))
    return met.select("stop_id", both.alias("best")).where("best IS NOT NULL").select("stop_id", "best.area_id", "best.w")


@_query(f"""WITH {SQL_STOPS}, p AS (SELECT a.stop_id AS stop_id, b.stop_id AS node_id, {_DIST} AS m FROM stops a JOIN stops b ON a.stop_id <> b.stop_id AND {_DIST} <= 9000),
l AS (SELECT stop_id, min(m) AS least FROM p GROUP BY stop_id) SELECT p.stop_id, node_id, CAST(floor(m) AS BIGINT) AS m FROM p JOIN l ON l.stop_id = p.stop_id WHERE m <= least + 1200""")
def q_snap_slack(spark, d):
    """All track nodes nearly as near as the nearest."""
    s = roles.stops(spark, d).select("stop_id", "lat", "lon")
    other = s.select(F.col("stop_id").alias("node_id"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    # the nearest of all lies in a small circle for most; only the others look through the whole one
    reach = lambda a, metres: spatial.radius_join(a, other, metres, max_lat=30.0).where("stop_id <> node_id").select("stop_id", "node_id", "distance_m")
    close = reach(s, 2400).groupBy("stop_id").agg(F.min("distance_m").alias("least")).where("least <= 1200")
    near = reach(s.join(close, "stop_id", "left_semi"), 2400).unionByName(reach(s.join(close, "stop_id", "left_anti"), 9000))
    return spatial.snap_with_slack(near, "stop_id", 1200).select("stop_id", "node_id", _metres("distance_m").alias("m"))


def _sql_side(ax, ay, bx, by, px, py):
    return f"sign(({bx} - {ax}) * ({py} - {ay}) - ({by} - {ay}) * ({px} - {ax}))"


_CROSS = " AND ".join(f"{a} * {b} < 0" for a, b in (
    (_sql_side("x1", "y1", "x2", "y2", "u1", "v1"), _sql_side("x1", "y1", "x2", "y2", "u2", "v2")),
    (_sql_side("u1", "v1", "u2", "v2", "x1", "y1"), _sql_side("u1", "v1", "u2", "v2", "x2", "y2"))))
_POINTS = "l_suppkey * 7919 % 8000 AS y1, l_suppkey * 104729 % 7000 AS x1"
#: Fixed barrier lines (id, x and y of both ends), in the grid that positions come from.
_BARRIERS = [(1, 0, 1000, 7000, 1300), (2, 3500, 0, 3400, 8000), (3, 500, 7000, 6500, 4000)]


@_query(f"""WITH p AS (SELECT l_orderkey, {_POINTS}, l_linenumber, l_partkey, l_suppkey FROM lineitem),
s AS (SELECT l_orderkey, x1, y1, lead(x1) OVER ({SQL_ORDER}) AS x2, lead(y1) OVER ({SQL_ORDER}) AS y2 FROM p), b(barrier, u1, v1, u2, v2) AS (VALUES {', '.join(map(str, _BARRIERS))})
SELECT barrier, l_orderkey % 100 AS bucket, count(*) AS n FROM s JOIN b ON {_CROSS} GROUP BY ALL""")
def q_segment_cross(spark, d):
    """Hops that cross a barrier."""
    p = roles.table(spark, d, "lineitem").select("l_orderkey", *ORDER, (F.col("l_suppkey") * 7919 % 8000).alias("y1"), (F.col("l_suppkey") * 104729 % 7000).alias("x1"))
    w = sequence.along(KEYS, ORDER)
    s = p.select("l_orderkey", "x1", "y1", F.lead("x1").over(w).alias("x2"), F.lead("y1").over(w).alias("y2")).where("x2 IS NOT NULL")
    c = F.col
    tests = [F.when(geo.segments_cross((c("x1"), c("y1")), (c("x2"), c("y2")), (F.lit(b[1]), F.lit(b[2])), (F.lit(b[3]), F.lit(b[4]))), F.lit(b[0])) for b in _BARRIERS]
    return s.select((c("l_orderkey") % 100).alias("bucket"), F.explode(F.array_compact(F.array(*tests))).alias("barrier")).groupBy("barrier", "bucket").agg(F.count(F.lit(1)).alias("n"))


# Fixed fare slabs: upper bound in km, fare.
_SLABS = [(2, 5), (5, 10), (10, 15), (20, 20), (30, 25)]


@_query(f"""WITH {SQL_TIMES}, h AS (SELECT l_orderkey, CAST(floor({_LAG}) AS BIGINT) AS m FROM times), k AS (SELECT l_orderkey, coalesce(sum(m), 0) AS m FROM h GROUP BY l_orderkey)
SELECT l_orderkey AS trip_id, CASE {' '.join(f'WHEN m <= {km * 1000} THEN {fare}' for km, fare in _SLABS)} END AS fare FROM k""")
def q_fare_slab(spark, d):
    """Fare of each trip by distance; none beyond the last slab."""
    total = sequence.hops(roles.stop_times(spark, d), KEYS, ORDER).groupBy("l_orderkey").agg(F.coalesce(F.sum(_metres()), F.lit(0)).alias("m"))
    slabs = F.array(*[F.struct(F.lit(km * 1000).alias("top"), F.lit(fare).alias("fare")) for km, fare in _SLABS])
    return total.select(F.col("l_orderkey").alias("trip_id"), F.try_element_at(F.filter(slabs, lambda s: s["top"] >= F.col("m")), F.lit(1))["fare"].alias("fare"))


@_query("""WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'no stop times' AS kind, o_orderkey AS key, CAST(1 AS BIGINT) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'duplicate', l_orderkey, sum(n - 1)::BIGINT FROM k WHERE n > 1 GROUP BY l_orderkey
UNION ALL SELECT 'unknown stop', l_suppkey, count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 9 <> 0) GROUP BY l_suppkey""")
def q_anti_checks(spark, d):
    """Rows that a feed build warns of."""
    lines = roles.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    missing = roles.table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(F.lit("no stop times").alias("kind"), F.col("o_orderkey").alias("key"), F.lit(1).cast("long").alias("n"))
    twice = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy(F.col("l_orderkey").alias("key")).agg(F.sum(F.col("n") - 1).alias("n"))
    known = roles.table(spark, d, "supplier").where("s_suppkey % 9 <> 0").select(F.col("s_suppkey").alias("key"))
    unknown = lines.groupBy(F.col("l_suppkey").alias("key")).agg(F.count(F.lit(1)).alias("n")).join(known, "key", "left_anti")
    return missing.unionByName(twice.withColumn("kind", F.lit("duplicate"))).unionByName(unknown.withColumn("kind", F.lit("unknown stop")))


@_query("""SELECT n_name AS mode, count(DISTINCT s_suppkey) AS stops, count(*) AS stop_times, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS dropped, CAST(count(*) FILTER (WHERE l_linenumber = 1) AS BIGINT) AS firsts
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name""")
def q_quality_report(spark, d):
    """Counters per mode; stop times are summed per stop before the join."""
    per = roles.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count_if(F.col("l_linenumber") == 1).alias("f"))
    stops = roles.table(spark, d, "supplier").join(roles.table(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return per.join(stops, F.col("s_suppkey") == F.col("l_suppkey")).groupBy(F.col("n_name").alias("mode")).agg(F.count(F.lit(1)).alias("stops"), F.sum("n").alias("stop_times"), F.sum("r").alias("dropped"), F.sum("f").alias("firsts"))


@_query("""SELECT l_suppkey AS stop_id, string_agg(DISTINCT l_returnflag || l_linestatus, '' ORDER BY l_returnflag || l_linestatus) AS modes FROM lineitem GROUP BY l_suppkey""")
def q_letter_sets(spark, d):
    """Sorted letters of the modes at each stop."""
    return roles.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("stop_id")).agg(F.array_join(F.array_sort(F.collect_set(F.concat("l_returnflag", "l_linestatus"))), "").alias("modes"))


@_query("""SELECT CASE WHEN p_type LIKE '%BRASS%' AND p_size > 25 THEN 'major' WHEN p_brand LIKE '%1' THEN 'local' WHEN regexp_matches(p_name, 'e.*e') THEN 'named' WHEN p_size < 10 THEN 'minor' ELSE 'other' END AS class, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1""")
def q_classify(spark, d):
    """First rule that fits."""
    rule = F.when(F.col("p_type").contains("BRASS") & (F.col("p_size") > 25), "major").when(F.col("p_brand").endswith("1"), "local").when(F.col("p_name").rlike("e.*e"), "named").when(F.col("p_size") < 10, "minor").otherwise("other")
    return roles.table(spark, d, "part").groupBy(rule.alias("class")).agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"))


@_query(f"""WITH p AS (SELECT s_suppkey, s_nationkey, {_MASKS.format(k='s_suppkey')} AS mask FROM supplier),
b AS (SELECT *, list_sum([CAST(substr(mask, i, 1) AS INTEGER) * (1 << (7 - i)) FOR i IN range(1, 8)]) AS bits FROM p),
g AS (SELECT s_nationkey, mask, CAST(bits AS INTEGER) AS bits, count(*) AS n FROM b GROUP BY ALL)
SELECT x.s_nationkey AS route_id, x.mask AS mask, y.mask AS other, substr(x.mask, 1, 1) AS monday, CASE WHEN x.mask = y.mask THEN x.n * (x.n - 1) // 2 ELSE x.n * y.n END AS pairs
FROM g x JOIN g y ON x.s_nationkey = y.s_nationkey AND x.mask <= y.mask AND (x.bits & y.bits) <> 0 WHERE x.mask <> y.mask OR x.n > 1""")
def q_mask_calendar(spark, d):
    """How many pairs of a route's periods overlap, by their days."""
    k = F.col("s_suppkey")
    mask = F.when(k % 4 == 0, "1111100").when(k % 4 == 1, "0000011").when(k % 4 == 2, "0000000").otherwise("1010101")
    p = roles.table(spark, d, "supplier").select(k.alias("a"), "s_nationkey", mask.alias("mask"))
    g = p.groupBy(F.col("s_nationkey").alias("route_id"), "mask").agg(F.count(F.lit(1)).alias("n"))  # 127 masks a route at most
    met = g.join(g.select("route_id", F.col("mask").alias("other"), F.col("n").alias("m")), "route_id").where((F.col("mask") <= F.col("other")) & clock.masks_overlap(F.col("mask"), F.col("other")))
    pairs = F.when(F.col("mask") == F.col("other"), F.expr("n * (n - 1) div 2")).otherwise(F.col("n") * F.col("m"))
    return met.select("route_id", "mask", "other", F.substring("mask", 1, 1).alias("monday"), pairs.alias("pairs")).where("pairs > 0")


@_query("""WITH s AS (SELECT o_orderkey, o_orderkey * 61 % 120000 AS s FROM orders), t AS (SELECT o_orderkey, s, lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS c FROM s)
SELECT o_orderkey AS trip_id, c AS clock, s AS seconds FROM t""")
def q_clock_format(spark, d):
    """Seconds to clock text and back, past 24 hours too."""
    c = clock.seconds_to_clock(F.col("o_orderkey") * 61 % 120000)
    return roles.table(spark, d, "orders").select(F.col("o_orderkey").alias("trip_id"), c.alias("clock"), clock.clock_to_seconds(c).cast("long").alias("seconds"))


_REACH = sql_haversine(roles.LAT.format(k="c_custkey * 3"), roles.LON.format(k="c_custkey * 3"), "s.lat", "s.lon")


@_query(f"""WITH {SQL_STOPS}, p AS (SELECT c_custkey, {_REACH} AS m FROM customer, stops s),
g AS (SELECT c_custkey, count(*) FILTER (WHERE m <= 1500) AS near, count(*) FILTER (WHERE m <= 3000) AS wide, min(m) AS least FROM p GROUP BY c_custkey)
SELECT c_custkey AS place_id, CASE WHEN near > 0 THEN 1500 WHEN wide > 0 THEN 3000 WHEN least <= 15000 THEN 15000 ELSE 0 END AS radius, CASE WHEN near > 0 THEN near WHEN wide > 0 THEN wide WHEN least <= 15000 THEN 1 ELSE 0 END AS n FROM g""")
def q_reach_fallback(spark, d):
    """Stops near a place, in growing radii."""
    k = F.col("c_custkey")
    places = roles.table(spark, d, "customer").select(k.alias("place_id"), roles.lat_of(k * 3).alias("lat"), roles.lon_of(k * 3).alias("lon"))
    # stops of one place count together, and places of one position are one
    s = roles.stops(spark, d).groupBy(F.col("lat").alias("lat2"), F.col("lon").alias("lon2")).agg(F.count(F.lit(1)).alias("stops"))
    ids = places.select("place_id", F.struct("lat", "lon").alias("at"))
    # each radius only for the positions that the one before left without a stop
    left, found = places.select(F.struct("lat", "lon").alias("at"), "lat", "lon").distinct(), []
    for metres in (1500, 3000, 15_000):
        near = spatial.radius_join(left, s, metres, max_lat=30.0).groupBy("at").agg(F.sum("stops").alias("n"))
        found.append(near.select("at", F.lit(metres).alias("radius"), F.when(F.lit(metres == 15_000), F.lit(1)).otherwise(F.col("n")).cast("long").alias("n")))
        left = left.join(near, "at", "left_anti")
    every = found[0].unionByName(found[1]).unionByName(found[2])
    return ids.join(every, "at", "left").select("place_id", F.coalesce("radius", F.lit(0)).alias("radius"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def _patterns(spark, d) -> DataFrame:
    w = sequence.along(KEYS, ORDER)
    p = roles.table(spark, d, "lineitem").select("l_orderkey", *ORDER, F.floor("l_quantity").cast("long").alias("q"))
    return p.select(F.col("l_orderkey").alias("pattern"), F.row_number().over(w).cast("long").alias("pos"), F.col("l_suppkey").alias("stop"), F.sum("q").over(sequence.so_far(KEYS, ORDER)).alias("minutes"))


_RIDES = """, r{n} AS (SELECT p.stop, min(s.cost + 8 + p.minutes - b.minutes) AS cost FROM l{p} s JOIN pat b ON b.stop = s.stop JOIN pat p ON p.pattern = b.pattern AND p.pos > b.pos GROUP BY p.stop),
a{n} AS (SELECT stop, min(cost) AS cost FROM (SELECT * FROM l{p} UNION ALL SELECT * FROM r{n}) GROUP BY stop),
l{n} AS (SELECT stop, min(cost) AS cost FROM (SELECT * FROM a{n} UNION ALL SELECT f.b, a.cost + 2 * f.minutes FROM a{n} a JOIN foot f ON f.a = a.stop) GROUP BY stop)"""


@_query(f"""WITH {SQL_STOPS}, pat AS (SELECT l_orderkey AS pattern, row_number() OVER ({SQL_ORDER}) AS pos, l_suppkey AS stop, sum(CAST(l_quantity AS BIGINT)) OVER ({SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS minutes FROM lineitem),
foot AS (SELECT a.stop_id AS a, b.stop_id AS b, CAST(ceil({_DIST} / 75) AS BIGINT) AS minutes FROM stops a JOIN stops b ON a.stop_id <> b.stop_id AND {_DIST} <= 3000),
l0 AS (SELECT CAST(1 AS BIGINT) AS stop, CAST(0 AS BIGINT) AS cost)""" + _RIDES.format(n=1, p=0) + _RIDES.format(n=2, p=1) + " SELECT stop, CAST(cost AS BIGINT) AS cost FROM l2")
def q_raptor_k2(spark, d):
    """Least cost to each stop from one, with at most two rides and walks after each."""
    pat = _patterns(spark, d)
    foot = _stop_pairs(spark, d, 3000).where("stop_id <> stop_id2").select(F.col("stop_id").alias("a"), F.col("stop_id2").alias("b"), F.ceil(F.col("distance_m") / 75).cast("long").alias("minutes"))
    pat, foot = materialize(pat, "ride-patterns"), materialize(foot, "ride-foot")
    labels = spark.createDataFrame([(1, 0)], "stop long, cost long")
    for _ in range(2):
        rode = materialize(paths.ride_round(labels, pat, 8), "ride-labels")
        labels = materialize(paths.walk_round(rode, foot), "ride-labels")
        discard(rode)
    discard(pat)
    discard(foot)
    return labels


#: Degrees of a cell that any two of whose points are under four kilometres apart.
_CELL = 0.02


@_query(f"""WITH RECURSIVE {SQL_STOPS}, e AS (SELECT a.stop_id AS u, b.stop_id AS v FROM stops a JOIN stops b ON a.stop_id <> b.stop_id AND {_DIST} <= 4000),
r AS (SELECT stop_id AS u, stop_id AS v FROM stops UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u) SELECT u AS stop_id, min(v) AS component FROM r GROUP BY u""")
def q_components(spark, d):
    """Groups of stops joined by short walks."""
    s = roles.stops(spark, d).select("stop_id", "lat", "lon")
    # stops of one small cell, whose corners are under the limit apart, are tied to its least stop; of two cells one pair
    # is enough, so pairs across cells are reduced to one before anything else is made of them
    cell = F.struct(geo.grid_cell(F.col("lat"), _CELL).alias("x"), geo.grid_cell(F.col("lon"), _CELL).alias("y"))
    placed = s.groupBy("lat", "lon").agg(F.min("stop_id").alias("stop_id")).withColumn("cell", cell)
    least = s.withColumn("cell", cell).groupBy("cell").agg(F.min("stop_id").alias("v"))
    within = s.withColumn("cell", cell).join(least, "cell").select(F.col("stop_id").alias("u"), "v")
    other = placed.select(F.col("cell").alias("cell2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    near = spatial.radius_join(placed.select("cell", "lat", "lon"), other, 4000, max_lat=30.0).where("cell < cell2").select("cell", "cell2").distinct()
    across = near.join(least.withColumnRenamed("v", "u"), "cell").join(least.select(F.col("cell").alias("cell2"), "v"), "cell2").select("u", "v")
    found = components(within.where("u <> v").unionByName(across))
    return s.join(found, F.col("node") == F.col("stop_id"), "left").select("stop_id", F.coalesce("component", "stop_id").alias("component"))


@_query(f"""WITH RECURSIVE {SQL_STOPS}, e AS (SELECT a.stop_id AS u, b.stop_id AS v, CAST(ceil({_DIST} / 100) AS BIGINT) AS w FROM stops a JOIN stops b ON a.stop_id <> b.stop_id AND {_DIST} <= 6000),
r AS (SELECT CAST(1 AS BIGINT) AS node, CAST(0 AS BIGINT) AS cost UNION SELECT e.v, r.cost + e.w FROM r JOIN e ON e.u = r.node WHERE r.cost + e.w <= 220) SELECT node, min(cost) AS cost FROM r GROUP BY node""")
def q_shortest_path(spark, d):
    """Least walking cost from one stop, up to a limit."""
    edges = _stop_pairs(spark, d, 6000).where("stop_id <> stop_id2").select(F.col("stop_id").alias("src"), F.col("stop_id2").alias("dst"), F.ceil(F.col("distance_m") / 100).cast("long").alias("w"))
    edges = materialize(edges.repartition("src"), "walk-edges")
    out = paths.shortest_costs(spark.createDataFrame([(1,)], "node long"), edges, 220)
    discard(edges)
    return out


@_query(r"""WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<li>')) AS items, len(regexp_extract_all(html, '<a href="/[^"]*"')) AS links, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS txt FROM pages)
SELECT page_id, title, CAST(items AS INTEGER) AS items, CAST(links AS INTEGER) AS links, length(txt) AS text_length FROM t""")
def q_html_catalogue(spark, d):
    """Titles, list items and text of pages."""
    text = F.trim(F.regexp_replace(F.regexp_replace("html", "<[^>]*>", " "), "[ \\t\\r\\n]+", " "))
    return roles.table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit("<li>"), F.lit(0))).alias("items"), F.size(F.regexp_extract_all("html", F.lit('<a href="/[^"]*"'), F.lit(0))).alias("links"), F.length(text).cast("long").alias("text_length"))


@_query("""WITH s AS (SELECT conv_id, turn, text, CASE WHEN role = 'user' THEN text END AS head FROM conversations)
SELECT conv_id, turn, length(last_value(head IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS section_length FROM s""")
def q_section_carry(spark, d):
    """The latest heading at each line."""
    s = roles.table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).alias("head"))
    return sequence.carried_forward(s, ["conv_id"], ["turn"], "head", "section").select("conv_id", "turn", F.length("section").cast("long").alias("section_length"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from switchyard.plans import feeds, homonyms, kinds, lookups, maps, places, printed, rides, walks  # noqa: F401  (they register their queries)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
