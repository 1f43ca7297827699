import numpy as np
import pytest

from switchyard.llm import multi_index, queries, topk


def plain_top_k(rows, k=5):
    """rows of (vec_id, vector or None); each row divisible by 50 asks all others."""
    use = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(use):
        if q is not None and q % 50 == 0:
            found = [(-int(sum(int(x) * int(y) for x, y in zip(v, w))), c is None, c or 0, c) for b, (c, w) in enumerate(use) if b != a and len(w) == len(v)]
            out += [(q, rank, c, -s) for rank, (s, _, _, c) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out, key=str)


def ask(table, **options):
    numbered = table.withColumn("line", topk.F.monotonically_increasing_id()).cache()
    got = topk.top_k(numbered, numbered.where("vec_id % 50 = 0"), row="line", **options).collect()
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got), key=str)


@pytest.fixture()
def vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.integers(-50, 50, (300, 12)).astype(float))]
    rows += [(900, None), (901, [1.0] * 11 + [float("nan")]), (902, []), (903, [None, *[1.0] * 11]), (950, [float("inf"), *[0.0] * 11])]
    rows += [(50, rows[3][1]), (100, rows[100][1]), (100, rows[100][1]), (None, rows[50][1]), (None, rows[50][1]), (1000, [1.0, 2.0]), (1001, [2.0, 0.0]), (1002, [0.0, 1.0])]
    rows += [(2000 + i, [7.0] * 12) for i in range(40)]  # ties
    return rows, spark.createDataFrame(rows, "vec_id long, vector array<double>").selectExpr("*", "1 AS score", "2 AS rank", "3 AS down")


@pytest.mark.parametrize("sizes", [(1 << 33, 1 << 22), (50, 20)])
def test_top_k_by_brute_force(vectors, monkeypatch, sizes):
    rows, table = vectors
    monkeypatch.setattr(topk, "PAIRS", sizes[0])
    monkeypatch.setattr(topk, "FEW_PAIRS", sizes[1])
    monkeypatch.setattr(topk, "LEAST_TASKS", 9)
    monkeypatch.setattr(topk, "BLOCK", 64)
    assert ask(table) == plain_top_k(rows)
    assert ask(table, k=1) == plain_top_k(rows, 1)


def test_top_k_without_rows_answers_an_id_once(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (0, [0.0, 5.0]), (7, [3.0, 3.0]), (None, [1.0, 1.0])], "vec_id long, vector array<double>")
    got = topk.top_k(table, table.where("vec_id = 0")).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 7, 15), (0, 2, None, 5)]
    assert topk.top_k(table.where("false"), table).count() == 0 and topk.top_k(table, table.where("false")).count() == 0


def test_top_k_beyond_doubles_is_whole(spark):
    big = float(1 << 28)
    table = spark.createDataFrame([(0, [big, 1.0]), (1, [big, 3.0]), (2, [big, 2.0])], "vec_id long, vector array<double>")
    got = topk.top_k(table, table.where("vec_id = 0"), k=2).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, (1 << 56) + 3), (2, (1 << 56) + 2)]


def test_reading_stops_before_the_lists_end():
    rng = np.random.default_rng(5)
    x = rng.integers(-100, 100, (4096, 8)).astype(float)
    x[17] = 100
    found = topk.nra_block(np.full((1, 8), 90.0), x, (np.zeros(0, int), np.zeros(0, int)), 1, np.array([-np.inf]))[0]
    assert 17 in found and len(found) <= 8


def plain_links(rows, similarity=0.93):
    use = [i for i, (name, v, label) in enumerate(rows) if name is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in use}
    near = {i: [k for k in use if k != i and rows[k][2] == rows[i][2] and len(unit[k]) == len(unit[i]) and unit[i] @ unit[k] >= similarity] for i in use}
    group = {i: i for i in use}
    for _ in use:
        for i in use:
            for k in near[i]:
                group[i] = group[k] = min(group[i], group[k])
    least = {}
    for i in use:
        least[group[i]] = min(least.get(group[i], rows[i][0]), rows[i][0])
    return sorted((((r[0]), len(near.get(i, ())), least[group[i]] if i in group else r[0]) for i, r in enumerate(rows)), key=str)


def found_links(table, **options):
    got = multi_index.near_duplicates(table, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


@pytest.fixture()
def embeddings(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 16))
    x[200:] = x[:200] + rng.normal(size=(200, 16)) * 0.12
    x[100:130] = x[100] + rng.normal(size=(30, 16)) * 0.05  # a large group
    rows = [(i, v.tolist(), i % 200 % 3) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, x[0].tolist(), None), (903, x[0].tolist(), 0), (0, x[0].tolist(), 0), (None, x[0].tolist(), 0)]
    rows += [(904, [None, *x[0].tolist()[1:]], 0), (905, [float("inf"), *x[0].tolist()[1:]], 0), (906, [1.0, 0.0], 1), (907, [2.0, 0.0], 1), (908, [0.93, (1 - 0.93**2) ** 0.5], 1), (909, [5.0], 1), (910, [-1.0], 1), (911, [3.0], 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS row", "2 AS cell", "3 AS n")


def test_multi_index_by_brute_force(embeddings):
    rows, table = embeddings
    assert found_links(table) == plain_links(rows)
    assert multi_index.near_duplicates(table.where("false")).count() == 0


def test_blocks_of_any_size_give_the_same_links(embeddings, monkeypatch):
    rows, table = embeddings
    for name, value in (("CELL_ROWS", 16), ("MEMBERS", 4), ("VISITORS", 6), ("CHUNK", 3), ("BAND", 2)):
        monkeypatch.setattr(multi_index, name, value)
    assert found_links(table, recall=1.0) == plain_links(rows)
    monkeypatch.setattr(multi_index, "BROADCAST_GROUPS", 0)
    assert found_links(table, recall=1.0) == plain_links(rows)


def test_recall_against_all_pairs_on_many_cells(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 32))
    side = rng.normal(size=(1500, 32))
    unit = x[:1500] / np.linalg.norm(x[:1500], axis=1, keepdims=True)
    side -= (side * unit).sum(axis=1, keepdims=True) * unit
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x[1500:] = 0.9305 * unit + np.sqrt(1 - 0.9305**2) * side  # all just over the limit
    monkeypatch.setattr(multi_index, "CELL_ROWS", 20)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    links = sum(r.n_links for r in multi_index.near_duplicates(table).collect())
    assert 0.97 * 3000 <= links <= 3000


def test_walk_takes_the_nearest_cells_in_order():
    rng = np.random.default_rng(1)
    x = multi_index._unit(rng.normal(size=(200, 8)))
    index = multi_index.MultiIndex.fit(x, 0.9, 7, 0.9)
    one, two = index.borders(x)
    seen = [[] for _ in x]
    for rows, i, j in index.visits(x):
        for r, a, b in zip(rows.tolist(), i.tolist(), j.tolist()):
            seen[r].append((a, b))
    for r, cells in enumerate(seen):
        sums = [one[r, a] + two[r, b] for a, b in cells]
        assert sums == sorted(sums) and len(set(cells)) == len(cells)
        assert len(cells) == int((one[r][:, None] + two[r][None] <= index.reach).sum())


def test_registered_queries_read_row_by_row(spark, vectors, embeddings, tmp_path):
    rows, table = embeddings
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    scaled = [(i, None if v is None else [x if x is None or not np.isfinite(x) else float(np.floor(256 * x)) for x in v]) for i, v, _ in rows]
    got = queries.op6_topk(spark, str(tmp_path)).collect()
    assert sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got), key=str) == plain_top_k(scaled)
    got = queries.op8_embedding_dedup(spark, str(tmp_path)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == plain_links(rows)
