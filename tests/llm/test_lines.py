import hashlib
from collections import Counter

import duckdb
import pytest

from switchyard.llm import line_dedup, queries
from switchyard.storage import shared_dir

BLANK = " \t\n\v\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def plain(rows, min_docs):
    often = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if often[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.fixture()
def docs(spark):
    rows = [(i, f" Common \nown {i}\n\nÉté\n{'ÉTÉ' if i % 2 else 'été'}\ncommon\nby {i % 5}") for i in range(24)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, "common"), (None, None), (30, ""), (31, "\n\n"), (32, "x\x85y\n\x1cz w"), (33, "long " * 50_000 + "\ncommon")]
    rows += [(40 + i, "rare line\nCOMMON\r\n") for i in range(6)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' AS key", "1L AS docs", "2 AS row", "3 AS c0", "0 AS n_chars")


def report(table, keys):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.line_report(table, keys).collect()), key=str)


@pytest.mark.parametrize("broadcast", [1 << 20, 1, 0])
def test_report_by_plain_python_whatever_is_broadcast(docs, monkeypatch, broadcast):
    rows, table = docs
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", broadcast)
    assert report(table, line_dedup.frequent_line_keys(table, min_docs=6)) == plain(rows, 6)
    kept = sorted(((r.doc_id, r.text, r.key, r.c0) for r in line_dedup.drop_lines(table, line_dedup.frequent_line_keys(table, min_docs=6)).collect()), key=str)
    want = sorted(((i, None if t is None else p[3], "a", 3) for (i, t), p in zip(sorted(rows, key=str), plain(rows, 6))), key=str)
    assert sorted(map(str, [(k[0], k[1]) for k in kept])) == sorted(map(str, [(w[0], w[1]) for w in want])) and {k[2:] for k in kept} == {("a", 3)}


def test_batches_give_what_the_whole_gives(docs):
    rows, table = docs
    for n_batches, fanout in ((1, 2), (3, 2), (9, 2), (7, 3)):
        keys = line_dedup.frequent_line_keys(table, min_docs=6, n_batches=n_batches, fanout=fanout)
        assert report(table, keys) == plain(rows, 6)


def test_a_store_goes_on_where_an_earlier_call_ended(spark, docs):
    rows, table = docs
    folder = f"{shared_dir(spark)}/test-line-store"
    line_dedup.LineStore(spark, folder, min_docs=6).clear()
    for number in range(3):
        store = line_dedup.LineStore(spark, folder, min_docs=6, fanout=2, buckets=4)  # opened anew each time
        keys = line_dedup.frequent_line_keys(table.where(f"pmod(hash(doc_id, text), 3) = {number}"), min_docs=6, n_batches=2, store=store)
    assert [len(level) for level in store.levels] == [0, 1, 1]
    assert report(table, keys) == plain(rows, 6)
    counts = line_dedup._line_counts(table.selectExpr("0L AS number", "text"), 1, 1).select("key", "docs")
    plan = store.undecided(counts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan
    assert plan.count("Exchange hashpartitioning(key") == 1  # the batch is dealt once; runs are neither dealt
    assert plan.count("Sort [key") == 1  # nor sorted
    store.clear()


def test_empty_table(docs):
    _, table = docs
    none = table.where("false")
    assert line_dedup.line_report(none, line_dedup.frequent_line_keys(none, min_docs=2)).count() == 0


def test_registered_query_and_sql_by_plain_python(spark, docs, tmp_path):
    rows, table = docs
    table.write.parquet(f"{tmp_path}/documents.parquet")
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(rows, 10)]
    got = queries.op7_line_dedup(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(queries.oracle_sql()["op7_line_dedup"]).fetchall(), key=str) == sorted(want, key=str)
