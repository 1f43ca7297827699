"""A stream's final windows against the same table at once."""

import datetime as dt

from switchyard.streaming import departures

SCHEMA = "kind string, ts timestamp"


def test_final_windows_equal_the_batch_and_late_events_drop(spark, tmp_path):
    base = dt.datetime(2026, 1, 5, 6, 0)
    at = lambda m: base + dt.timedelta(minutes=m)
    first = [("bus", at(m)) for m in (0, 10, 25, 59)] + [("tram", at(30)), ("bus", None)]
    second = [("bus", at(m)) for m in (61, 95)] + [("bus", at(300))]
    late = [("bus", at(5))]
    for i, rows in enumerate((first, second, late)):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i}")
    out = []
    for i in range(3):  # one folder a call: the stream goes on where it ended
        spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in/{i}").write.mode("append").parquet(f"{tmp_path}/live")
        stream = departures.headways(departures.read_departures(spark, f"{tmp_path}/live", SCHEMA), keys=["kind"])
        departures.write_final(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    out = {(r.start, r.kind): (r.n, r.headway_s) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    whole = departures.headways(spark.createDataFrame(first + second, SCHEMA), keys=["kind"]).collect()
    final = {(r.start, r.kind): (r.n, r.headway_s) for r in whole if r.start < at(200)}
    assert out == final and out[at(0), "bus"] == (4, 59 * 60 / 3) and out[at(0), "tram"] == (1, None)
