import pytest
from pyspark.sql import functions as F

from switchyard.functions.geo import haversine_m
from switchyard.operators import matching, paths, schedule, sequence, spatial
from switchyard.operators.components import components


def test_frequency_windows_split_at_peaks_and_join(spark):
    df = spark.createDataFrame([("a", 6 * 3600, 22 * 3600, 360, 420), ("b", 6 * 3600, 21 * 3600, None, 600), ("c", 22 * 3600, 3600, 300, 300)], "r string, f int, l int, p int, o int")
    got = {(x.r, x.start_s, x.end_s, x.headway_s) for x in schedule.frequency_windows(df, ["r"], "f", "l", "p", "o").collect()}
    assert {x for x in got if x[0] == "a"} == {("a", 21600, 25200, 420), ("a", 25200, 36000, 360), ("a", 36000, 61200, 420), ("a", 61200, 72000, 360), ("a", 72000, 79260, 420)}
    assert {x for x in got if x[0] == "b"} == {("b", 21600, 75660, 600)}
    assert {x for x in got if x[0] == "c"} == {("c", 79200, 90060, 300)}


def test_interpolation_between_before_and_after_anchors(spark):
    rows = [("r", i, float(10 * i), t) for i, t in enumerate([None, 100.0, None, 160.0, None])] + [("bad", i, float(i), t) for i, t in enumerate([5.0, 3.0, None])]
    df = spark.createDataFrame(rows, "k string, seq int, est double, anchor double")
    got = {(x.k, x.seq): x.time for x in sequence.interpolate_anchors(df, ["k"], ["seq"], "est", "anchor").collect()}
    assert [got["r", i] for i in range(5)] == [0, 10, 40, 70, 80]
    assert [got["bad", i] for i in range(3)] == [0, 1, 2]


def test_drop_repeats_keeps_nulls_apart(spark):
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(["a", "a", None, None, "b", "a"])], "k string, i int, v string")
    got = sequence.drop_repeats(df, ["k"], ["i"], "v").orderBy("seq").collect()
    assert [(x.seq, x.v) for x in got] == [(1, "a"), (2, None), (3, "b"), (4, "a")]


def test_repair_times(spark):
    times = F.array(*[F.struct(F.lit(a).cast("long").alias("arrival"), F.lit(d).cast("long").alias("departure")) for a, d in [(80_000, 80_060), (86_000, 100), (200, 150)]])
    got = spark.range(1).select(sequence.repair_times(times).alias("x")).first()["x"]
    assert [tuple(x) for x in got] == [(80_000, 80_060), (86_000, 86_500), (86_600, 86_600)]


def test_radius_join_equals_all_pairs(spark):
    import math
    import random

    rnd = random.Random(1)
    pts = [(i, 22 + rnd.random() / 5, 88 + rnd.random() / 5) for i in range(80)]
    a, b = spark.createDataFrame(pts, "id int, lat double, lon double"), spark.createDataFrame(pts, "id2 int, lat2 double, lon2 double")
    got = {(x.id, x.id2) for x in spatial.radius_join(a, b, 3000).collect()}

    def m(p, q):
        h = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))

    assert got == {(p[0], q[0]) for p in pts for q in pts if m(p, q) <= 3000}


@pytest.mark.parametrize("edges, expected", [([], {}), ([(1, 1)], {}), ([(3, 2), (2, 1), (5, 4)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4})])
def test_components(spark, edges, expected):
    assert dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect())) == expected


def test_shortest_costs(spark):
    edges = spark.createDataFrame([(1, 2, 5), (2, 3, 5), (1, 3, 20), (3, 4, 100)], "src long, dst long, w long")
    assert dict(map(tuple, paths.shortest_costs(spark.createDataFrame([(1,)], "node long"), edges, 50).collect())) == {1: 0, 2: 5, 3: 10}


def test_rides_board_at_their_patterns_cost(spark):
    rows = [(1, 1, 1, 0), (1, 2, 2, 10), (2, 1, 1, 0), (2, 2, 2, 12), (2, 3, 3, 20)]
    headways = spark.createDataFrame([(1, 60.0, 0), (2, 4.0, 1)], "pattern long, h double, penalty int")
    stops = spark.createDataFrame(rows, "pattern long, pos long, stop long, minutes long")
    each = stops.join(headways, "pattern").withColumn("board", paths.boarding(F.col("h"), F.col("penalty")))
    start = spark.createDataFrame([(1, 0)], "stop long, cost long")
    # 15 + 3 + 10 by the rare pattern, 2 + 3 + 1 + 12 by the frequent one
    assert {r.stop: r.cost for r in paths.ride_round(start, each, "board").collect()} == {1: 0, 2: 18, 3: 26}
    assert {r.stop: r.cost for r in paths.ride_round(start, stops, 8).collect()} == {1: 0, 2: 18, 3: 28}


def test_suffixed_slugs_pass_over_taken_ones(spark):
    rows = [(1, "a"), (2, "a"), (3, "a"), (4, "a_2"), (5, "b"), (6, "a_2"), (7, "c_1"), (8, "c")]
    got = matching.slugs(spark.createDataFrame(rows, "id long, slug string"), "slug", "id").collect()
    ids = {r.id: r.stop_id for r in got}
    assert ids[1] == "a" and ids[4] == "a_2" and ids[5] == "b" and ids[7] == "c_1" and ids[8] == "c"
    assert len(set(ids.values())) == len(rows)


def test_distance_to_nothing_is_null(spark):
    row = spark.createDataFrame([(22.5, 88.3, None, 88.3), (22.5, 88.3, 22.5, 88.3), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    got = [r.m for r in row.select(haversine_m(*map(F.col, "abcd")).alias("m")).collect()]
    assert got[0] is None and got[1] == 0 and round(got[2]) == 20_015_087


def test_cascade_asks_a_tier_again_while_it_places(spark):
    unplaced = spark.createDataFrame([(i,) for i in range(8)], "id long")
    chain = lambda left, placed: left.where("id = 0").select("id", F.col("id").alias("place")) if placed is None else left.join(placed.select((F.col("id") + 1).alias("id")), "id").select("id", F.col("id").alias("place"))
    rest = lambda left, placed: left.where("id >= 6").select("id", F.lit(99).cast("long").alias("place"))
    got = {r.id: (r.tier, r["round"]) for r in matching.cascade(unplaced, [chain, rest], lambda offers, placed: offers, max_rounds=4).collect()}
    assert got == {0: (1, 1), 1: (1, 2), 2: (1, 3), 3: (1, 4), 6: (2, 1), 7: (2, 1)}


def test_lagged_equals_a_lag_over_whole_keys(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([i, None]), f"v{i}") for i in rng.sample(range(-300, 300), 200)]
    frame = spark.createDataFrame(rows, "k string, at long, x long, y string")
    got = {(r.k, r["at"]): (r.was_x, r.was_y) for r in sequence.lagged(frame, ["k"], "at", ["x", "y"], 7).collect()}
    want, last = {}, {}
    for k, at, x, y in sorted(rows, key=lambda r: r[1]):
        want[k, at] = last.get(k, (None, None))
        last[k] = (x, y)
    assert got == want


def shuffled_rows(spark, df):
    """Rows of ``df``, and rows that its run wrote to shuffles."""
    rows = df.collect()
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    run = runs.apply(runs.size() - 1)
    values, wanted = store.executionMetrics(run.executionId()), 0
    for i in range(run.metrics().size()):
        metric = run.metrics().apply(i)
        if metric.name() == "shuffle records written" and values.contains(metric.accumulatorId()):
            wanted += int(values.apply(metric.accumulatorId()).split("\n")[-1].split(" ")[0].replace(",", "") or 0)
    return rows, wanted


def test_partners_of_common_names_are_not_shuffled(spark):
    from switchyard.operators import matching

    ids, places = range(300), range(400)
    index = spark.createDataFrame([(p, "College Street", p % 2) for p in places], "place long, name string, source long")
    asked = spark.createDataFrame([(i, ["nowhere", "College Street"]) for i in ids], "id long, names array<string>")
    rows, shuffled = shuffled_rows(spark, matching.named_join(asked, index.select("place", "name")))
    assert sorted(map(tuple, rows)) == [(i, p, 1, 1) for i in ids for p in places] and shuffled < 60_000
    rows, shuffled = shuffled_rows(spark, matching.skeleton_join(asked.selectExpr("id", "names[1] AS name"), index))
    assert sorted(map(tuple, rows)) == [(i, p) for i in ids for p in places if p % 2 == 0] and shuffled < 60_000


def test_partners_of_ids_and_places_of_several_names_come_once(spark):
    from switchyard.operators import matching

    index = spark.createDataFrame([(1, "College Street"), (1, "Salt Lake City"), (2, "Salt Lake City"), (3, "Howrah")], "place long, name string")
    asked = spark.createDataFrame([(7, ["College Street"]), (7, ["Salt Lake City"]), (8, ["x", "Howrah"]), (None, ["Howrah"]), (9, ["y"])], "id long, names array<string>")
    assert sorted(map(tuple, matching.named_join(asked, index).collect())) == [(7, 1, 0, 1), (7, 2, 0, 1), (8, 3, 1, 1)]
    asked = asked.selectExpr("id", "explode(names) AS name")
    assert sorted(map(tuple, matching.skeleton_join(asked, index.selectExpr("*", "1 AS source"), 3).collect())) == [(7, 1), (7, 2)]


def test_anchored_places_leave_few_and_lose_no_best_one(spark):
    import math
    import random

    from switchyard.operators import matching

    random.seed(5)
    stops = {i: (i % 3, i % 2, 22.3 + random.random() * 0.8, 88 + random.random() * 0.7) for i in range(300)}
    asked = spark.createDataFrame([(i, *row) for i, row in stops.items()], "id long, group long, route long, lat double, lon double")
    few = matching.anchored_places(asked, asked.selectExpr("group", "id AS place", "lat", "lon")).collect()
    kept = {(r.group, r.route, r.place) for r in few}

    def far(a, b):
        h = math.sin(math.radians(b[2] - a[2]) / 2) ** 2 + math.cos(math.radians(a[2])) * math.cos(math.radians(b[2])) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return math.asin(math.sqrt(h))

    for i, row in stops.items():
        mates = [m for k, m in stops.items() if k != i and m[1] == row[1]]
        best = min((sum(far(p, m) for m in mates), k) for k, p in stops.items() if k != i and p[0] == row[0])[1]
        assert (row[0], row[1], best) in kept
    assert len(few) < 60  # of 600


def test_anchored_nearest_makes_no_row_of_a_pair(spark, monkeypatch):
    """Sums of blocks equal all distances, with blocks of any size; two places at one spot are told apart by their id."""
    import math
    import random

    monkeypatch.setattr(matching, "_BLOCK", 7)
    rng = random.Random(3)
    rows = [(i, i % 3, i % 2, 22 + rng.random() / 2, 88 + rng.random() / 2) for i in range(90)] + [(90, 0, 5, 22.2, 88.2), (91, 0, 0, 22.21, 88.21)]
    rows = [(*r[:3], 22.25, 88.25) if r[0] in (30, 33, 36) else r for r in rows]
    asked = spark.createDataFrame(rows, "id long, group int, route int, lat double, lon double")

    def far(a, b):
        h = math.sin(math.radians(b[3] - a[3]) / 2) ** 2 + math.cos(math.radians(a[3])) * math.cos(math.radians(b[3])) * math.sin(math.radians(b[4] - a[4]) / 2) ** 2
        return 2 * 6_371_000.0 * math.asin(math.sqrt(h))

    want = {}
    for a in rows:
        mates = [m for m in rows if m[2] == a[2] and m[0] != a[0]]
        means = [(round(sum(far(p, m) for m in mates) / len(mates), 6), p[0]) for p in rows if p[1] == a[1] and p[0] != a[0] and mates]
        if means and min(means)[0] < 18_500:
            want[a[0]] = min(means)[1]
    result = matching.anchored_nearest(asked, asked.selectExpr("group", "id AS place", "lat", "lon"), 18_500.0)
    assert dict(map(tuple, result.collect())) == want and 0 < len(want) < len(rows) - 1
    # 92 ids and 46 blocks of at most 7 rows a route and group, where pairs were 92 x 46 rows
    _, shuffled = shuffled_rows(spark, matching._summed(asked, asked.selectExpr("group", "id AS place", "lat", "lon")))
    assert shuffled < 92 * 46 / 2


def test_partners_meet_in_blocks(spark, monkeypatch):
    """A key's ids and places meet as arrays, whose pairs no join makes; blocks of any size give the same pairs."""
    monkeypatch.setattr(matching, "_BLOCK", 16)
    names, ids, places = ["College Street", "Salt Lake City", "Howrah Station"], range(100), range(140)
    index = spark.createDataFrame([(p, names[p % 3], p % 2) for p in places], "place long, name string, source long")
    asked = spark.createDataFrame([(i, ["nowhere", names[i % 2]]) for i in ids], "id long, names array<string>")
    rows = matching.named_join(asked, index.select("place", "name")).collect()
    assert sorted(map(tuple, rows)) == [(i, p, 1, 1) for i in ids for p in places if p % 3 == i % 2]
    result = matching.skeleton_join(asked.selectExpr("id", "names[1] AS name"), index)
    assert sorted(map(tuple, result.collect())) == [(i, p) for i in ids for p in places if p % 3 == i % 2 and p % 2 == 0]
    assert "Generate explode(_places" in result._jdf.queryExecution().optimizedPlan().toString()
    # the key of a spelling is worked out once
    made = []
    monkeypatch.setattr(matching, "materialize", lambda df, name, write=matching.materialize: made.append((name, df.count())) or write(df, name))
    matching.skeleton_join(asked.selectExpr("id", "names[1] AS name"), index)
    assert [n for name, n in made if name == "name-keys"] == [3, 2]
