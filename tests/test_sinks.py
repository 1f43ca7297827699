import json
import zipfile

from switchyard.sources import sinks


def test_bundle_is_a_whole_zip(spark, tmp_path):
    rows = [(i, f'name "{i}", x', None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, name string, note string").repartition(3)
    sinks.write_feed_table(df, f"{tmp_path}/stops", ["id"])
    notes = {"LICENCE.txt": "free\n", "ATTRIBUTION.txt": sinks.attribution([("Map", "ODbL", "https://example.org")], "us")}
    sinks.bundle(spark, {"stops.txt": f"file://{tmp_path}/stops"}, notes, f"file://{tmp_path}/feed.zip")
    with zipfile.ZipFile(tmp_path / "feed.zip") as z:
        assert z.testzip() is None and sorted(z.namelist()) == ["ATTRIBUTION.txt", "LICENCE.txt", "stops.txt"]
        lines = z.read("stops.txt").decode().split("\n")
    assert lines[0] == "id,name,note" and len(lines) == 3002 and lines[1] == '0,"name ""0"", x",'


def test_report_modes_log_and_places(spark, tmp_path):
    counts = spark.range(12_000).selectExpr("id AS mode", "id * 2 AS n")
    assert len(sinks.report("All", counts, "mode").split("\n")) == 12_000 + 5
    df = spark.createDataFrame([("bus", 2), ("rail", 1), ("bus", 1), (None, 5)], "mode string, id int")
    assert sinks.write_by_mode(df, str(tmp_path), "stops", ["id"]) == ["bus", "rail"]
    assert [r.value for r in spark.read.text(f"{tmp_path}/bus/stops").collect()] == ["id", "1", "2"]
    shown = []
    log = sinks.BuildLog(shown.append)
    log.say("built")
    log.say("  detail")
    assert shown == ["built"] and log.text() == "built\n  detail\n"
    places = spark.createDataFrame([(1, "A", 22.1234567, 88.0, "Area", 8, list("abcdefg")), (2, "B", 1.0, 2.0, "x", 1, [])], "id long, name string, lat double, lon double, type string, rank int, alts array<string>")
    got = {r.id: json.loads(r.value) for r in sinks.places_json(places, spark.createDataFrame([(2, 1)], "id long, area long")).collect()}
    assert got[1] == {"id": 1, "name": "A", "lat": 22.12346, "lon": 88.0, "type": "Area", "rank": 8, "alts": list("abcde")} and got[2]["area"] == 1 and "alts" not in got[2]
