import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from switchyard.llm import periodic_runs, queries


def plain_runs(words, min_length=6, min_exponent=4):
    """Every period tried in ascending order; (start, end, period)."""
    seen, n = {}, len(words)
    for p in range(1, n // min_exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(min_length, min_exponent * p):
                seen.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e, p) for (s, e), p in seen.items())


def plain_row(doc_id, text):
    """The contract's row, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, e, p in runs for i in range(s + p, e)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    first = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{e - s},{p}\n" for s, e, p in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


parts = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 9))
documents = st.lists(st.lists(parts, max_size=5).map(lambda ps: [w for unit, times in ps for w in unit * times]), max_size=4)


@settings(max_examples=300, deadline=None)
@given(documents, st.sampled_from([(6, 4), (2, 2), (5, 3), (12, 4), (4, 2), (9, 5)]))
def test_runs_equal_every_period_tried(docs, limits):
    runs, ends, dropped = periodic_runs.runs_of(docs, *limits)
    starts, want = ends - np.diff(ends, prepend=0), []
    for at, words in zip(starts.tolist(), docs, strict=True):
        want += [(s + at, e + at, p) for s, e, p in plain_runs(words, *limits)]
    assert sorted(map(tuple, runs.T.tolist())) == sorted(want)
    assert set(np.flatnonzero(dropped).tolist()) == {i for s, e, p in want for i in range(s + p, e)}


def test_gram_size_is_the_least_overlap():
    for length, exponent in [(6, 4), (2, 2), (5, 3), (20, 4), (7, 5)]:
        assert periodic_runs.gram_size(length, exponent) == min(max(length, exponent * q) - q for q in range(1, 200))


def test_words_outside_repeated_grams_are_masked():
    rng = np.random.default_rng(1)
    words = np.concatenate([rng.permutation(5000), np.tile(np.arange(5000, 5010), 5), rng.permutation(5000)[:0] + 0])
    ends = np.array([len(words)])
    mask = periodic_runs.surviving(words, ends, 5)
    assert mask[5000:].all() and not mask[:5000].any()
    twice = np.concatenate([words, words])  # another document's gram is no repeat
    assert not periodic_runs.surviving(twice, np.array([len(words), 2 * len(words)]), 5)[:5000].any()


def test_a_failed_proof_takes_other_hashes(monkeypatch):
    asked = []
    proved = periodic_runs._proved
    monkeypatch.setattr(periodic_runs, "_proved", lambda w, r: len(asked) > 1 and proved(w, r) or asked.append(1))
    runs = periodic_runs.main_lorentz(np.array([1, 2] * 6), np.array([0]), np.array([12]))
    assert runs.T.tolist() == [[0, 12, 2]] and len(asked) == 2


def test_proof_finds_a_wrong_period():
    words = np.array([1, 2, 3, 1, 2, 4, -1, -1])
    assert periodic_runs._proved(words, np.array([[0], [5], [3]])) and not periodic_runs._proved(words, np.array([[0], [6], [3]]))


def test_long_documents_of_one_word():
    runs, _, dropped = periodic_runs.runs_of([["x"] * 100_000, list(range(50_000)) * 4])
    assert runs.T.tolist() == [[0, 100_000, 1], [100_000, 300_000, 50_000]] and int((~dropped).sum()) == 50_001


TEXTS = [None, "", " \t ", "one", "a b a b a b a b a", "x " * 5, "x y " * 7 + "z", "A a A a A a A a", "w\x1cv　u " * 6, "1 2 3 " * 40 + "4 " * 9, "\x0bq\x0cq\rq\nq\tq q"]


@pytest.fixture()
def docs(spark):
    ids = [None, *range(60)]
    rows = [(i, t, "clash", 1) for i in ids for t in (TEXTS if i is None or i < 6 else TEXTS[8:10])] + [(2, TEXTS[4], "clash", 2)] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, runs string, n int")


def test_query_equals_plain_rows(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = [plain_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[1] for r in want) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(60))


def test_operator_gives_texts_and_spans(docs):
    rows = {(r.doc_id, r.collapsed): r for r in periodic_runs.find_runs(docs).collect()}
    assert [tuple(x) for x in rows[0, "a b"].runs] == [(0, 9, 2)] and rows[0, "a b"].n_words == 9
    assert periodic_runs.find_runs(docs).count() == docs.count() and periodic_runs.find_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, min_exponent=1)
