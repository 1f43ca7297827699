import json
import zipfile

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from switchyard.functions import bengali, likeness, lines, names
from switchyard.operators import clustering, search
from switchyard.sources import files, sinks


def test_polyline_of_the_published_example_and_back(spark):
    df = spark.createDataFrame([(1, [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]), (2, []), (3, None)], f"i int, p {lines.POINTS.simpleString()}")
    got = {r.i: (r.t, r.back) for r in df.select("i", lines.encode_polyline(F.col("p")).alias("t")).withColumn("back", lines.decode_polyline("t")).collect()}
    assert got[1][0] == "_p~iF~ps|U_ulLnnqC_mqNvxq`@"
    assert [(round(p.lat, 5), round(p.lon, 5)) for p in got[1][1]] == [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]
    assert got[2] == ("", []) and got[3] == (None, None)


def test_simplify_keeps_ends_and_corners(spark):
    corner = [(22.0, 88.0), (22.0, 88.01), (22.0, 88.02), (22.01, 88.02), (22.02, 88.02)]
    df = spark.createDataFrame([(1, corner), (2, [(22.0, 88.0), (22.1, 88.0), (22.0, 88.0)]), (3, corner[:2]), (4, [])], f"i int, p {lines.POINTS.simpleString()}")
    got = {r.i: [(p.lat, p.lon) for p in r.q] for r in df.select("i", lines.simplify(F.col("p"), 10.0).alias("q")).collect()}
    assert got[1] == [corner[0], corner[2], corner[4]]
    assert len(got[2]) == 3 and got[3] == corner[:2] and got[4] == []


def _plain_edits(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@given(st.text("abc", max_size=8), st.text("abc", max_size=8), st.integers(0, 5))
@settings(max_examples=300, deadline=None)
def test_edits_equal_the_full_table(a, b, most):
    assert likeness.edits(a, b, most) == min(_plain_edits(a, b), most + 1)


def test_bengali_spelling(spark):
    rows = ["কলকাতা", "শ্যামবাজার", "বড়বাজার", "Park Street", "হাওড়া  ১২ No", None]
    got = [r.t for r in spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "i int, s string").orderBy("i").select(bengali.to_latin(F.col("s")).alias("t")).collect()]
    assert got == ["kalakata", "shyamabajar", "barabajar", None, "haora 12 No", None]


def test_first_fit_follows_order_and_running_mean(spark):
    m = 1 / 111195  # a metre of latitude
    rows = [(1, "a", 22.0, 88.0), (2, "a", 22.0 + 900 * m, 88.0), (3, "a", 22.0 + 1400 * m, 88.0), (4, "b", 22.0, 88.0), (5, "a", None, 88.0), (6, None, 22.0, 88.0), (7, "a", 22.0 + 5000 * m, 88.0)]
    df = spark.createDataFrame(rows, "id int, k string, lat double, lon double")
    got = {r.id: (r.cluster, r.opened) for r in clustering.first_fit(df, "k", ["id"], 1000.0).collect()}
    assert got == {1: (0, True), 2: (0, False), 3: (0, False), 4: (0, True), 5: (None, False), 6: (0, True), 7: (1, True)}
    assert {r.id for r in clustering.drop_near_copies(df, "k", ["id"], 1000.0).collect()} == {1, 3, 4, 5, 6, 7}


def test_search_strict_before_fuzzy(spark):
    schema = "id long, name string, alts array<string>, area string, type string, rank int, lat double, lon double"
    rows = [(1, "Park Street", ["Mother Teresa Sarani"], "Central", "street", 5, 22.55, 88.35), (2, "Park Circus", None, None, "locality", 4, 22.54, 88.36),
            (3, "Parking Lot", None, None, None, 0, 22.5, 88.3), (4, "Garia", [], None, "locality", 4, 22.46, 88.38), (5, None, None, None, None, None, None, None),
            (6, "Park Street", None, None, "stop", 1, 22.5501, 88.3501)]
    found = search.search(spark, search.entries(spark.createDataFrame(rows, schema)), ["park street", "goria", "prak", "teresa", "park central", "p", ""])
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got[0] == [1] and got[1] == [4] and got[3] == [1] and got[4] == [1]
    assert got[2][:1] == [1] and set(got[2]) <= {1, 2, 3} and 5 not in got and 6 not in got


def test_readers(spark, tmp_path):
    (tmp_path / "s.csv").write_text('stop_id,stop_name,lat\na,"A ""x"", y",\n')
    r = files.read_rows(spark, str(tmp_path / "s.csv"), ["stop_id", "stop_name", "lat", "notes"]).first()
    assert tuple(r) == ("a", 'A "x", y', None, None)
    assert files.read_rows(spark, str(tmp_path / "none.csv"), ["a"], optional=True).count() == 0
    (tmp_path / "g.tsv").write_text("1\tGaria\tGaria\tগড়িয়া,Goria\t22.4631\t88.3812\tP\tPPL\t\n2\tX\tX\t\t22.46\t88.38\tP\tPPL\t\n3\tRiver\tRiver\t\t22.4631\t88.3812\tH\tSTM\t\nbad\n")
    assert [tuple(x) for x in files.read_geonames(spark, str(tmp_path / "g.tsv")).collect()] == [(["Garia", "Goria"], 22.4631, 88.3812, "geonames/1")]
    (tmp_path / "w.json").write_text(json.dumps({"tiles": {"0": [[22.4631, 88.3812, "Q1", {"en": "Garia", "bn": "কলকাতা", "alias": ["Q5"]}], [1.111, 2.222, "Q2", {"en": "Far"}]]}}))
    got = {(x.script, *x.names) for x in files.read_wikidata_tiles(spark, str(tmp_path / "w.json")).collect()}
    assert got == {("latin", "Garia"), ("bengali", "kalakata")}
    (tmp_path / "o.txt").write_text("1|A\n2|B\n")
    assert files.read_serial_list(spark, str(tmp_path / "o.txt"), ["serial", "route"], "serial", 2).count() == 2
    with pytest.raises(ValueError):
        files.read_serial_list(spark, str(tmp_path / "o.txt"), ["serial", "route"], "serial", 3)
    text = "^".join(["head", "~".join(["1", "HWH", "Howrah", "05:00", "05:10", "1", "0", *"......."[:7], "22.5", "88.3"]), "short~1"])
    calls = spark.createDataFrame([(text,)], "t string").select(files.train_calls(F.col("t")).alias("c")).first().c
    assert [(c.seq, c.code, c.lat) for c in calls] == [(1, "HWH", "22.5")]
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps({"kind": "r", "key": k, "text": v}) for k, v in [("a", "1"), ("b", "2"), ("a", "3")]))
    assert {(x.key, x.text) for x in files.read_cache(spark, str(tmp_path / "c.jsonl")).collect()} == {("a", "3"), ("b", "2")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", None, 2), ("a", 'q"x,', 1)], "id string, name string, n int")
    sinks.write_feed_table(df, str(tmp_path / "stops"), ["id"])
    sinks.bundle(spark, {"stops.txt": str(tmp_path / "stops")}, {"NOTE.txt": "n"}, str(tmp_path / "feed.zip"))
    with zipfile.ZipFile(tmp_path / "feed.zip") as z:
        assert z.namelist() == ["stops.txt", "NOTE.txt"]
        assert z.read("stops.txt").decode() == 'id,name,n\na,"q""x,",1\nb,,2\n'
    assert sinks.report("R", df.groupBy("id").count(), "id").splitlines()[2:] == ["| id | count |", "| --- | --- |", "| a | 1 |", "| b | 1 |"]
    assert sinks.network_json(spark.createDataFrame([(1, 22.1234567)], "i int, lat double"), ["i", "lat"]).first().value == '{"i":1,"lat":22.12346}'
    used = spark.createDataFrame([("x", "r2"), ("x", "r1"), ("y", "r1")], "name string, route string")
    assert [tuple(r) for r in sinks.worklist(used, used.where("name = 'y'"), "name", "route").collect()] == [("x", 2, ["r1", "r2"])]


@pytest.mark.parametrize("name", ["q_polyline"])
def test_queries_equal_their_sql(spark, name):
    from switchyard.plans import catalogue

    d, con = "/root/testdata/sf0.01", duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.sql(catalogue.oracle_sql()[name])
    got = catalogue.queries()[name](spark, d).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_search_by_index_equals_scoring_everything(spark):
    import random

    rng = random.Random(12)
    words = ["park", "parking", "street", "stret", "lake", "central", "centre", "sector", "2", "new", "market", "mkt", "garia", "gariahat", "teresa", "ma"]
    rows = [(i, " ".join(rng.sample(words, rng.randint(0, 3))), [" ".join(rng.sample(words, rng.randint(1, 2))) for _ in range(rng.randint(0, 2))], rng.choice([None, "salt lake", "howrah"]), "bus stop", rng.randrange(5), 22.0 + rng.random(), 88.0 + rng.random()) for i in range(120)]
    entries = search.entries(spark.createDataFrame(rows, "id long, name string, alts array<string>, area string, type string, rank int, lat double, lon double"))
    texts = [" ".join(rng.sample(words, rng.randint(1, 3))) for _ in range(25)] + ["prak", "garaihat", "parks", "centrl lake", "newmarket", "arkstr", "marke howrah", "stop", "2", "x", "", "teresaa park", "seetor 2", "lak", "ksto"]
    texts += [t[:-1] for t in texts if len(t) > 4]
    asked = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    got = {(r.query_id, r.id): round(r.score, 9) for r in search.search_all(entries, asked).collect()}
    tokens = {r.query_id: list(r.t) for r in asked.select("query_id", names.tokens(F.trim("text")).alias("t")).collect()}
    want, every = {}, entries.collect()
    for q, text in enumerate(texts):
        if len(text.strip()) < 2 or not tokens[q]:
            continue
        one = lambda r, fuzzy: search.score(tokens[q], list(r.toks), [list(a) for a in r.alt_toks], list(r.context), r["rank"], r["name"], fuzzy)  # noqa: E731, B023
        hits = {r.id: (s, r) for r in every if (s := one(r, False)) is not None}
        if len(hits) < search.FEW and len("".join(tokens[q])) >= 4:
            hits |= {r.id: (s - search.FUZZY_COST, r) for r in every if r.id not in hits and (s := one(r, True)) is not None}
        best = {}
        for i, (s, r) in hits.items():
            cell = (r.key, int((r.lat * 50 + 0.5) // 1), int((r.lon * 50 + 0.5) // 1))
            best[cell] = min(best.get(cell, (1e9, 0)), (-s, i))
        want |= {(q, i): round(-s, 9) for s, i in sorted(best.values())[: search.SHOWN]}
    assert got == want and len(got) > 100


def test_like_entries_are_scored_once(spark, monkeypatch):
    """Every entry was scored for itself before, so copies of a name at many places cost as many scores."""
    rows = [(i, "lake market", ["mkt"], None, "stop", 1, 22.0 + i % 7 * 0.1, 88.0) for i in range(90, 0, -1)] + [(200, "lake town", [], None, "stop", 1, 22.0, 88.0)]
    entries = search.entries(spark.createDataFrame(rows, "id long, name string, alts array<string>, area string, type string, rank int, lat double, lon double"))
    scored, asked = [], spark.createDataFrame([(1, "lake mar"), (2, "lake towm")], "query_id long, text string")
    plain = search._scored
    monkeypatch.setattr(search, "_scored", lambda found_in, asked, pairs, fuzzy: scored.append(pairs.count()) or plain(found_in, asked, pairs, fuzzy))
    got = {(r.query_id, r["rank"]): r.id for r in search.search_all(entries, asked).collect()}
    assert got == {(1, n): n for n in range(1, 8)} | {(2, 1): 200}
    assert scored == [1, 1]  # 90 strict hits of one content are enough for the first query; the second alone is asked again
