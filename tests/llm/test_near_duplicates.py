import numpy as np
import pytest

from switchyard.llm import bagminhash

WORDS = [f"w{i}" for i in range(3000)]


def plain_classes(rows):
    """Smallest id of each row's class, by all pairs of texts and plain counting of shingles."""

    def bag(text):
        words, out = (text or "").lower().split(), {}
        n = min(5, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            key = tuple(words[i : i + n])
            out[key] = out.get(key, 0) + 1
        return out

    def similar(a, b):
        both = sum(min(n, b.get(k, 0)) for k, n in a.items())
        return both and both / (sum(a.values()) + sum(b.values()) - both) >= 0.8

    texts = sorted({t for _, t in rows if t is not None})
    bags, group = {t: bag(t) for t in texts}, {t: t for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if group[a] != group[b] and similar(bags[a], bags[b]):
                old, new = group[a], group[b]
                group = {t: new if g == old else g for t, g in group.items()}
    least = {}
    for i, t in rows:
        if t is not None and i is not None:
            least[group[t]] = min(least.get(group[t], i), i)
    return sorted(((i, i if t is None else least.get(group[t])) for i, t in rows), key=str)


@pytest.fixture()
def docs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(12):  # chains of copies, each a little further from the first
        words = [WORDS[i] for i in rng.integers(0, 3000, 120)]
        for step in range(12):
            words = [w if rng.random() > 0.015 else WORDS[int(rng.integers(0, 3000))] for w in words]
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
    rows += [(2000 + i, " ".join(WORDS[:200])) for i in range(40)] + [(2100 + i, " ".join([*WORDS[:199], f"x{i}"])) for i in range(60)]
    rows += [(1, None), (1, None), (None, "a b"), (None, "no id at all here"), (3, ""), (4, ""), (5, " \n"), (6, "A b"), (7, "one one one one one one one one"), (8, "one one one one one one one one one")]
    rows += [(9, "long " * 30_000), (9, "long " * 30_000), (10, "long " * 29_000)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS chosen_node", "2 AS node", "3 AS class_id", "4 AS rows", "5 AS id")


def found(table, **options):
    return sorted(((r.doc_id, r.class_id) for r in bagminhash.near_duplicates(table, **options).collect()), key=str)


def test_classes_by_all_pairs(docs):
    rows, table = docs
    assert found(table) == plain_classes(rows)


def test_small_blocks_few_pivots_and_no_prefilter_give_the_same(docs, monkeypatch):
    rows, table = docs
    monkeypatch.setattr(bagminhash, "BLOCK", 7)
    monkeypatch.setattr(bagminhash, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(bagminhash, "PIVOTS", 1)
    assert found(table, may_link=0.0) == plain_classes(rows)


def test_keep_one_keeps_one_of_each_class_with_all_columns(docs):
    rows, table = docs
    kept = bagminhash.keep_one(table).collect()
    classes = {c for i, c in plain_classes([r for r in rows if r[1] is not None])}
    assert len([r for r in kept if r.text is not None]) == len(classes) and len([r for r in kept if r.text is None]) == 2
    assert {(r.chosen_node, r.node, r.class_id, r.rows, r.id) for r in kept} == {(1, 2, 3, 4, 5)}
