from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from switchyard.llm import bagminhash, language_id, quality, queries  # noqa: E402
from switchyard.llm.byte_bpe import ChunkEncoder  # noqa: E402
from switchyard.storage import materialize  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def ids(rows):
    return Counter(r.doc_id for r in rows)


def test_every_stage_keeps_the_rows_it_should(spark):
    docs, kept = queries.table(spark, SMALL, "documents"), {}
    before = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before[name] = docs
        docs = materialize(stage(spark, docs, SMALL), f"test-{name}")
        kept[name] = docs.collect()

    judged = language_id.predict(before["language_id"], queries.fit_languages(before["language_id"])).where("not rejected")
    assert ids(kept["language_id"]) == ids(judged.collect())
    good = quality.score(before["quality"], queries.fit_quality(before["quality"], queries.table(spark, SMALL, "labels"))).where("score >= 0.3")
    assert ids(kept["quality"]) == ids(good.collect()) and kept["quality"]

    def key(line):
        return line.strip(" \t\n\v\f\r").lower()

    rows = kept["quality"]
    often = Counter(k for r in rows for k in {key(x) for x in (r.text or "").split("\n")} if k)
    want = Counter((r.doc_id, None if r.text is None else "\n".join(x for x in r.text.split("\n") if often[key(x)] < 10)) for r in rows)
    assert Counter((r.doc_id, r.text) for r in kept["line_dedup"]) == want

    rows = [r for r in kept["line_dedup"] if r.text is not None]
    memo = bagminhash.new_memo()
    bags = bagminhash.shingle_bags([r.text for r in rows], memo)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and (rows[i].text == rows[j].text or bagminhash.overlap(bags[i], bags[j]) >= 0.8):
                group = [group[j] if g == group[i] else g for g in group]
    of = {(r.doc_id, r.text): g for r, g in zip(rows, group, strict=True)}
    left = Counter(of[r.doc_id, r.text] for r in kept["near_dedup"] if r.text is not None)
    assert left == Counter(set(group))

    encoder = ChunkEncoder(queries.tokenizer_file("byte_bpe_50k.json"))
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    packed = Counter()
    for p in pieces:
        packed[p.doc_id] += p.length
    whole = Counter()
    for r in kept["near_dedup"]:
        whole[r.doc_id] += len(np.frombuffer(encoder.encode([r.text])[0], "<u4")) + 1
    assert packed == whole


def test_stages_take_odd_rows_and_keep_all_columns(spark, tmp_path):
    docs = queries.table(spark, SMALL, "documents")
    extra = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "x", 0), (-2, None, None, None, None), (-3, "\n\n \t", None, None, 4), (-4, "12 !", "en", "x", 4)], docs.schema)
    odd = docs.unionByName(extra).unionByName(docs.where("doc_id % 40 = 0")).selectExpr("*", "1 AS node", "2 AS key", "3 AS score", "4 AS chosen_id")
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    queries.table(spark, SMALL, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    now = odd
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert made.columns == odd.columns
            assert stage(spark, now.where("false"), str(tmp_path)).count() == 0
            now = materialize(made, f"odd-{name}")
            assert {(r.node, r.key, r.score, r.chosen_id) for r in now.select("node", "key", "score", "chosen_id").distinct().collect()} == {(1, 2, 3, 4)}
    assert made.count() >= now.count() > 0
