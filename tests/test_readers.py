"""Readers over files of the shapes that upstream writes."""

import json

from pyspark.sql import functions as F

from switchyard.functions import labels, names
from switchyard.operators import feed, network
from switchyard.sources import files


def test_the_cache_keeps_the_last_text(spark, tmp_path):
    lines = [{"kind": "pair", "key": "SDAH-BDC", "text": "first"}, {"kind": "train", "key": "31812", "text": "x~y"}, {"kind": "pair", "key": "SDAH-BDC", "text": "second"}]
    (tmp_path / "cache.jsonl").write_text("\n".join(map(json.dumps, lines)))
    got = {(r.kind, r.key): r.text for r in files.read_cache(spark, str(tmp_path / "cache.jsonl")).collect()}
    assert got == {("pair", "SDAH-BDC"): "second", ("train", "31812"): "x~y"}


def test_trains_and_calls(spark):
    train = ["12", "LOCAL", "a", "SDAH", "b", "BDC", *"ghijklm", "1111100", "o", "p", "id7", "q", "r", "DATASOURCE_1", "s", "SF"]
    text = "head^" + "~".join(train) + "^too~short~" + "^" + "~".join(train[:-1] + ["odd"])
    rows = spark.createDataFrame([(text,)], "t string").select(F.inline(files.trains(F.col("t")))).collect()
    assert [(r.number, r["from"], r.to, r.days, r.id, r.datasource, r.type) for r in rows] == [("12", "SDAH", "BDC", "1111100", "id7", "DATASOURCE_1", "SF"), ("12", "SDAH", "BDC", "1111100", "id7", "DATASOURCE_1", "")]


def test_aliases_are_trimmed_and_in_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("stop_name,alias,evidence,reason\nRuby More, zeta ,x,y\nother,b,,\nRuby more,alpha,,\nRuby More,,,\n")
    got = {r.key: r.aliases for r in files.read_aliases(spark, str(tmp_path / "a.csv")).collect()}
    assert got[[k for k in got if k.startswith("rub")][0]] == ["zeta", "alpha"]
    assert files.read_aliases(spark, str(tmp_path / "none.csv")).count() == 0


def test_gazetteer_boxes_and_scripts(spark, tmp_path):
    items = [[22.57, 88.361, "node/1", "place=suburb", {"name": "Sealdah;শিয়ালদহ", "alt_name": " "}], [23.9, 88.0, "node/2", "x", {"name": "North of the box"}], [21.6, 87.5, "way/3", "y", {"name:bn": "হাওড়া"}]]
    (tmp_path / "g.json").write_text(json.dumps({"elements": items}, ensure_ascii=False))
    rows = files.read_gazetteer(spark, str(tmp_path / "g.json")).collect()
    assert sorted((r.ref, r.script) for r in rows) == [("node/1", "bengali"), ("node/1", "latin"), ("way/3", "bengali")]
    assert [r.names for r in rows if r.script == "latin"] == [["Sealdah"]] and all(n.isascii() for r in rows if r.script == "bengali" for n in r.names)


def test_map_elements_split(spark, tmp_path):
    node = lambda i, **tags: {"type": "node", "id": i, "lat": 22.5, "lon": 88.3, "tags": tags}
    elements = [node(1, name="A", highway="bus_stop"), node(2, name="B", railway="station"), node(3, name="C", railway="station", bus="yes"), node(4, name="হাওড়া"), node(5, name="A")]
    elements += [{"type": "relation", "id": 9, "tags": {"ref": "12"}, "members": [{"type": "node", "ref": r, "role": role} for r, role in ((1, "stop"), (2, "platform_entry_only"), (5, "stop"), (3, "via"), (4, "stop"))]}]
    (tmp_path / "o.json").write_text(json.dumps({"elements": elements}, ensure_ascii=False))
    found = files.read_elements(spark, str(tmp_path / "o.json"))
    assert sorted(r.ref for r in files.map_stops(found).collect()) == ["node/1", "node/3", "node/5"]
    assert sorted(r.ref for r in files.map_places(found).collect()) == ["node/1", "node/2", "node/3", "node/5"]
    assert sorted((r.place, r.ref) for r in files.relation_stops(found).collect()) == [(0, 1), (1, 2)]


def test_catalogue_lines_and_stop_names(spark):
    lines = [("12B: Garia to Howrah Station [via Ruby, 7, Park Circus / Moulali]", True), ("S9 - Barasat -> Garia (via: Ultadanga; more; Ruby)", True), ("Howrah - Digha via Kolaghat, Contai", False), ("nothing here", False), ("no number to see [a, b]", True), ("44 A-B via", True)]
    got = spark.createDataFrame(lines, "l string, n boolean").select(labels.catalogue_line(F.col("l"), F.col("n")).alias("g")).collect()
    assert [r.g and (r.g.no, r.g.origin, r.g.destination, r.g.via) for r in got] == [
        ("12B", "Garia", "Howrah Station", ["Ruby", "Park Circus", "Moulali"]), ("S9", "Barasat", "Garia", ["Ultadanga", "Ruby"]), (None, "Howrah", "Digha", ["Kolaghat", "Contai"]), None, None, None]
    raws = [("Ruby. On Return Goes Via Garia",), ("GariaGaria",), ("- Park (Circus",), ("",), ("garia ruby howrah sealdah and then a long long list of what was glued together",)]
    got = spark.createDataFrame(raws, "r string").select(labels.clean_stop_name(F.col("r"), ["garia", "rubi", "houra", "seald"]).alias("c"), names.norm_key(F.col("r")).alias("k")).collect()
    assert [(r.c.name, r.c.note) for r in got[:4]] == [("Ruby", "return-via text stripped from source name"), ("Garia", "doubled name in source"), ("Park Circus", ""), (None, "empty after cleaning")]


def test_folding_goes_beyond_latin_one(spark):
    rows = spark.createDataFrame([("Šibenik ﬁn Ｇａｒｉａ – é…",)], "n string").select(names.fold(F.col("n")).alias("f")).collect()
    assert rows[0].f == "Sibenik fin Garia - e..."


def test_rolled_over_times_and_fares(spark):
    calls = [[(10, 12), (5, None), (None, 3), (1430, 1)]]
    got = spark.createDataFrame([(c,) for c in calls], "c array<struct<arrival:int,departure:int>>").select(feed.rolled_over(F.col("c")).alias("o")).first().o
    assert [tuple(x) for x in got] == [(10, 12), (1445, 1445), (1443 + 1440, 1443 + 1440), (1430 + 1440 * 2, 1 + 1440 * 3)]
    fares = spark.createDataFrame([("5", "5.0", "ferry"), ("5", "6", "ferry"), ("5", "5", "bus"), (None, "5", "ferry"), ("x", "x", "ferry")], "a string, b string, m string")
    assert [r.f for r in fares.select(feed.flat_fare(F.col("a"), F.col("b"), F.col("m"), ["ferry"]).alias("f")).collect()] == ["5.00", None, None, None, None]


def test_variants_shapes_and_samples(spark):
    trips = [(1, 0, t, list("abcd"), [0.0, 1.0, 2.0, 3.0]) for t in range(3)] + [(1, 0, 10 + t, list("abx"), [float(30 * t), 30.0 * t + 4, 30.0 * t + 5 + t]) for t in range(4)]
    trips += [(1, 0, 20, list("bx"), [0.0, 2.0]), (1, 0, 21, list("ay"), [5.0, 9.0])]
    main = spark.createDataFrame([(1, 0, list("abcd"))], "route long, direction int, stops array<string>")
    got = network.variants(spark.createDataFrame(trips, "route long, direction int, trip long, stops array<string>, minutes array<double>"), main).collect()
    assert [("".join(r.stops), r.n, r.headway, r.minutes) for r in got] == [("abx", 4, 30.0, [0.0, 4.0, 7.0]), ("ay", 1, 240.0, [0.0, 4.0])]
    nodes = [("rail", i, 22.0, 88.0 + i * 0.001) for i in range(6)] + [("rail", 9, 22.003, 88.0025)]
    ways = spark.createDataFrame([("rail", False, [(i, 22.0, 88.0 + i * 0.001) for i in range(6)]), ("rail", True, [(2, 22.0, 88.002), (9, 22.003, 88.0025), (3, 22.0, 88.003)])], "mode string, service boolean, nodes array<struct<id:long,lat:double,lon:double>>")
    edges = network.track_edges(ways)
    assert edges.count() == 14
    stops = spark.createDataFrame([("p", 22.0, 88.0), ("q", 22.0, 88.005), ("r", 22.0, 88.0051)], "stop string, lat double, lon double")
    hops = spark.createDataFrame([("rail", "p", "q"), ("rail", "q", "p"), ("rail", "q", "r")], "mode string, a string, b string")
    rows = network.hop_shapes(hops, stops, spark.createDataFrame(nodes, "mode string, node long, lat double, lon double"), edges).collect()
    assert [(r.a, r.b) for r in rows] == [("p", "q")] and rows[0].shape
    line = spark.createDataFrame([(list(range(100)),), (list(range(5)),)], "p array<int>").select(network.sampled(F.col("p"), 24).alias("s")).collect()
    assert len(line[0].s) == 24 and line[0].s[0] == 0 and line[0].s[-1] == 99 and line[1].s == list(range(5))


def test_stops_of_one_name_in_groups(spark):
    rows = [(1, "Ruby", 22.5, 88.4, ["bus"]), (2, "ruby", 22.505, 88.4, ["auto", "metro"]), (3, "Ruby", 22.6, 88.4, ["bus"]), (4, "Garia", 22.5, 88.4, []), (5, "RUBY", 22.5001, 88.4, ["rail"])]
    got = network.stop_groups(spark.createDataFrame(rows, "stop long, name string, lat double, lon double, modes array<string>")).collect()
    assert sorted((r.name, r.lat, r.modes, r.n) for r in got) == [("Garia", 22.5, [], 1), ("RUBY", 22.5001, ["auto", "bus", "metro", "rail"], 3), ("Ruby", 22.6, ["bus"], 1)]
