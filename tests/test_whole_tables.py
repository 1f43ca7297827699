"""Queries over small tables of their own against plain Python over all rows."""

import math

import pytest

from switchyard.plans import catalogue


def position(key):
    return 22.3 + key * 7919 % 8000 / 10000.0, 88.0 + key * 104729 % 7000 / 10000.0


def metres(p, q):
    h = math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(h))


@pytest.fixture()
def tables(spark, tmp_path):
    def write(**named):
        for name, (rows, schema) in named.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def test_raptor_rides_every_trip(spark, tables):
    stops = range(1, 61)
    trips = {t: [(1 + (t * 7 + i * i * 5) % 40, 3 + (t + i) % 9) for i in range(4)] for t in range(1, 25)}
    lines = [(t, i, 1, s, float(q)) for t, calls in trips.items() for i, (s, q) in enumerate(calls, 1)]
    d = tables(
        lineitem=(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double"),
        supplier=([(s, f"S{s}", 1, 0.0) for s in stops], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    )
    best = {1: 0}
    for _ in range(2):
        ridden = dict(best)
        for calls in trips.values():
            for i, (board, _) in enumerate(calls):
                minutes = 0
                for stop, q in calls[i + 1 :]:
                    minutes += q
                    if board in best:
                        ridden[stop] = min(ridden.get(stop, 10**9), best[board] + 8 + minutes)
        best = dict(ridden)
        for a, cost in ridden.items():
            for b in stops:
                if a != b and (m := metres(position(a), position(b))) <= 3000:
                    best[b] = min(best.get(b, 10**9), cost + 2 * math.ceil(m / 75))
    got = {r.stop: r.cost for r in catalogue.queries()["q_raptor_k2"](spark, d).collect()}
    assert got == best and len(best) > 10


def test_name_tiers_see_every_customer(spark, tables):
    suppliers = {1: "Supplier#000000001", 2: "Supplier#000000008", 3: "Supplier#000000105", 4: "Both", 5: "", 6: None, 7: "Supplier#000000999"}
    customers = {k: f"Customer#{k:09d}" for k in range(0, 60)} | {100: "both", 101: "", 102: None}
    d = tables(
        supplier=([(k, n, 1, 0.0) for k, n in suppliers.items()], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        customer=([(k, n) for k, n in customers.items()], "c_custkey long, c_name string"),
    )
    keys = [lambda x: x.lower(), lambda x: x.lower()[-9:], lambda x: x.lower()[-2:]]
    want = set()
    for s, name in suppliers.items():
        for tier, key in enumerate(keys, 1):
            hit = {(s, c, tier) for c, other in customers.items() if name and other and key(name) == key(other)}
            if hit:
                want |= hit
                break
    got = [tuple(r) for r in catalogue.queries()["q_name_tier_join"](spark, d).select("s_suppkey", "c_custkey", "tier").collect()]
    assert len(got) == len(set(got)) and set(got) == want and {t for _, _, t in want} == {1, 2, 3}


CUSTOMER = "c_custkey long, c_name string"


def test_merge_takes_all_orders_and_customers(spark, tables):
    orders = {o: 395 + o * o % 7 for o in range(1, 80)} | {900: None}
    customers = list(range(390, 410)) + [700]
    d = tables(orders=(list(orders.items()), "o_orderkey long, o_custkey long"), customer=([(c, "x") for c in customers], CUSTOMER))
    left = [(o, None if c is None else c * 10 + o % 10) for o, c in orders.items()]
    right = {c * 10 + c % 10: c for c in customers}
    seen = [k for _, k in left]
    merged = {(k, o, right[k] if k in right and seen.count(k) == 1 else None) for o, k in left}
    merged |= {(k, None, c) for k, c in right.items() if c not in {x for _, _, x in merged}}
    got = [tuple(r) for r in catalogue.queries()["q_merge_unique_key"](spark, d).select("k", "id_left", "id_right").collect()]
    assert len(got) == len(set(got)) and set(got) == merged
    assert any(o and c for _, o, c in merged) and any(seen.count(k) > 1 and k in right for k in seen)


def test_reach_judges_every_place(spark, tables):
    stops, places = range(1, 9), range(0, 40)
    d = tables(
        supplier=([(s, f"S{s}", 1, 0.0) for s in stops], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        customer=([(c, "x") for c in places], CUSTOMER),
    )
    want = {}
    for c in places:
        far = [metres(position(c * 3), position(s)) for s in stops]
        near, wide = sum(m <= 1500 for m in far), sum(m <= 3000 for m in far)
        want[c] = (1500, near) if near else (3000, wide) if wide else (15000, 1) if min(far) <= 15000 else (0, 0)
    got = {r.place_id: (r.radius, r.n) for r in catalogue.queries()["q_reach_fallback"](spark, d).collect()}
    assert got == want and len({r for r, _ in want.values()}) > 1


def test_periods_of_every_customer(spark, tables):
    routes, customers = range(0, 130), range(0, 260)
    d = tables(
        supplier=([(s, f"S{s}", 1, 0.0) for s in routes], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        customer=([(c, "x") for c in customers], CUSTOMER),
    )
    masks = ["1111100", "0000011", "0000000", "1010101"]
    valid = [(c % 120, ["", "0", "1"][c % 3], c, masks[c % 4]) for c in customers if c % 4 != 2]
    served = {route for route, *_ in valid}
    want = {(route, way, c, mask) for route, fits, c, mask in valid for way in "01" if fits in ("", way)}
    want |= {(route, way, None, "1111111") for route in routes if route not in served for way in "01"}
    got = [tuple(r) for r in catalogue.queries()["q_wildcard_period_join"](spark, d).select("route_id", "direction", "period_id", "mask").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def _edits(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_edits_of_all_pairs_of_a_nation(spark, tables):
    names = ["Park", "Prak", "Pa rk", "Parks", "Circus", "Circsu", "Crcsus", "", "Park", "ca", "abc", "Howrah", "Hwroah"]
    rows = [(k, n, nation, 0.0) for nation in (1, 2) for k, n in enumerate(names, 100 * nation)] + [(999, None, 1, 0.0)]
    d = tables(supplier=(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"))
    want = {(a, b, None if x is None or y is None else min(_edits(x, y), 3)) for a, x, n, _ in rows for b, y, m, _ in rows if n == m and a < b}
    got = [tuple(r) for r in catalogue.queries()["q_edit_distance"](spark, d).select("id_a", "id_b", "edits").collect()]
    assert len(got) == len(set(got)) and set(got) == want and {0, 1, 2, 3} <= {e for _, _, e in want}


def most_rows(spark, df):
    """Rows of ``df``, and the most rows that any step of its run gave."""
    rows = df.collect()
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    run = runs.apply(runs.size() - 1)
    values, most = store.executionMetrics(run.executionId()), 0
    for i in range(run.metrics().size()):
        metric = run.metrics().apply(i)
        if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
            most = max(most, int(values.apply(metric.accumulatorId()).split("\n")[-1].split(" ")[0].replace(",", "") or 0))
    return rows, most


def test_stops_of_one_place_are_met_once(spark, tables):
    """300 stops at two places 2.9 km apart, and as many customers: no step gives all their pairs."""
    keys = [k + 56000 * i for i in range(150) for k in (1, 2)]
    d = tables(
        supplier=([(k, f"S{k}", k % 3) for k in keys], "s_suppkey long, s_name string, s_nationkey int"),
        customer=([(k,) for k in keys], "c_custkey long"),
    )
    rows, most = most_rows(spark, catalogue.queries()["q_nearest_area"](spark, d))
    want = []
    for k in keys:
        found = [(int(metres(position(k), position(a))) * (16 if a % 2 == 0 else 10), a) for a in keys if a != k and a % 10 < 5 and metres(position(k), position(a)) <= 6000]
        want += [(k, a, w) for w, a in sorted(found)[:1]]
    assert sorted(map(tuple, rows)) == sorted(want) and len(want) == 300 and most < 5_000
    rows, most = most_rows(spark, catalogue.queries()["q_reach_fallback"](spark, d))
    near = {k: [m for a in keys if (m := metres(position(3 * k), position(a))) <= 15_000] for k in keys}
    first = lambda m: next(((r, len([x for x in m if x <= r]) if r < 15_000 else 1) for r in (1500, 3000, 15_000) if any(x <= r for x in m)), (0, 0))
    assert sorted(map(tuple, rows)) == sorted((k, *first(near[k])) for k in keys) and most < 20_000
    rows = catalogue.queries()["q_components"](spark, d).collect()
    assert sorted(map(tuple, rows)) == sorted((k, 1) for k in keys)
    rows = catalogue.queries()["q_snap_slack"](spark, d).collect()
    assert len(rows) == 300 * 149 and {r.m for r in rows} == {0}


def test_rows_that_share_a_key_are_dealt(spark):
    """They stood under one null key in the full join before, so all of them were one task's."""
    from switchyard.operators import matching

    left = spark.range(4000).selectExpr("id % 1000 AS number", "sequence(1, id % 3 + 1) AS stops").unionByName(spark.createDataFrame([(None, [1]), (None, [1, 2]), (5000, [1])], "number long, stops array<long>"))
    right = spark.createDataFrame([(3, [1, 2, 3, 4]), (5000, [1, 2]), (6000, [7])], "number long, stops array<long>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = matching.merge_longer(left, right, "number").selectExpr("number", "size(stops) AS n", "source", "spark_partition_id() AS part").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    held = [r.part for r in got if r.source == "left" and r.number is not None]
    assert len(held) == 4000 and max(map(held.count, set(held))) < 2000
    others = sorted(((r.number, r.n, r.source) for r in got if r.number is None or r.source != "left"), key=str)
    assert others == [(3, 4, "right"), (5000, 2, "both"), (6000, 1, "right"), (None, 1, "left"), (None, 2, "left")]
