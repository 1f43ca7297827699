import math
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from switchyard.llm import bagminhash, language_id, packing, ppm, quality, queries, sentencepiece_codec, url_filter  # noqa: E402
from switchyard.llm.byte_bpe import ChunkEncoder  # noqa: E402

BPE, PIECES = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
WORDS = [f"w{i}" for i in range(400)]
TEXTS = [None, "", "a", "  two  spaces\n\n\t x", "x\x85y\x1cz", "é 漢字 '", "it's <|endoftext|> 12", " ".join(WORDS) * 30, "line\nline\nother"]


@pytest.fixture()
def docs(spark):
    rows = [(i, t, "en", i * 2) for i, t in enumerate(TEXTS)] + [(1, "", "en", 0), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, row int")


def empty(docs):
    return docs.where("false")


def test_ids_equal_the_library():
    e = ChunkEncoder(BPE)
    for t, got in zip(TEXTS, e.encode(TEXTS), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_packing_is_gapless_and_whole(docs):
    e = ChunkEncoder(BPE)
    rows = packing.pack(docs, BPE).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or at & (at - 1) == 0
    for i, t in enumerate(TEXTS):
        if i == 1:
            continue  # that id occurs twice
        ids, at = np.append(np.frombuffer(e.encode([t])[0], "<u4"), 1).astype("<u4"), 0
        for p in sorted((r for r in rows if r.doc_id == i), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert packing.pack(empty(docs), BPE).count() == 0


def test_square_packer_takes_the_least_sum_of_squares():
    rng, p = np.random.default_rng(1), packing.SquarePacker(32)
    for size in rng.integers(1, 32, 400).tolist():
        def total(level):
            n = p.count.copy()
            if level:
                n[level] -= 1
            if level + size < 32:
                n[level + size] += 1
            return int((n[1:32] ** 2).sum())

        options = [0, *[h for h in range(1, 33 - size) if p.count[h]]]
        assert total(p.level_for(size)) == min(map(total, options))
        p.place((size,), size)


def test_sentencepiece_parity(docs):
    rows = sentencepiece_codec.encode(docs, PIECES, parity_every=1).collect()
    assert all(r.parity is not False for r in rows) and len(rows) == docs.count()
    assert all(r.decoded == (r_text or "") for r, r_text in zip(rows, [r.text for r in docs.collect()], strict=True) if r_text)
    assert sentencepiece_codec.digest(empty(docs), PIECES).count() == 0


def test_registered_sentencepiece_query_checks_every_row(docs, spark, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op5_sentencepiece(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count() and all(r.parity is True for r in rows)
    texts = ["right", "wrong", "", None, "wrong"]
    c = sentencepiece_codec.codec(PIECES)
    ids = [b"\x01\0\0\0" if t == "wrong" else i for t, i in zip(texts, c.encode(texts), strict=True)]
    assert sentencepiece_codec._parity(PIECES, texts, ids, 1) == [True, False, True, True, False]
    assert sentencepiece_codec._parity(PIECES, [""], [b"\x01\0\0\0"], 1) == [False]


def test_near_duplicates_and_keep_one(spark, docs):
    base = WORDS[:200]
    near = base[:199] + ["other"]
    rows = [(10, " ".join(base)), (11, " ".join(near)), (12, " ".join(base)), (13, " ".join(WORDS[200:])), (13, " ".join(WORDS[200:])), (14, None), (15, None), (16, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(table).collect()}
    assert got == {10: 10, 11: 10, 12: 10, 13: 13, 14: 14, 15: 15, 16: 16}
    assert sorted(r.doc_id for r in bagminhash.keep_one(table).collect()) == [10, 13, 14, 15, 16]
    assert bagminhash.near_duplicates(empty(docs)).count() == 0


def test_signature_estimates_weighted_jaccard():
    memo = bagminhash.new_memo()
    a, b = bagminhash.shingle_bags([" ".join(WORDS * 3), " ".join(WORDS * 2 + ["x"] * 90)], memo)
    s = bagminhash.signatures([a, b], 4096)
    assert abs((s[0] == s[1]).mean() - bagminhash.overlap(a, b)) < 0.03


def test_language_and_quality_defined_cases(docs):
    models = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.predict(docs, models).collect()}
    assert got[0].lang_pred == "und" and got[0].rejected and got[2].lang_pred == "en"
    assert language_id.predict(docs, language_id.fit(empty(docs))).where("lang_pred = 'und'").count() == docs.count()
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    nothing = quality.fit(empty(docs), labels)
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}


def test_ppm_base_score_by_hand(docs):
    rows = docs.select("doc_id", "text").collect()
    tokens = [[*(r.text or "").encode().lower().split(), b"\n"] for r in rows]
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 10 == 0 for r in rows]
    counts = Counter(w for words, out in zip(tokens, held, strict=True) if not out for w in words)
    below = counts.total() + 0.1 * (len(counts) + 1)
    want = sorted((out, len(words), round(sum(math.log10((counts[w] + 0.1) / below) for w in words), 6)) for words, out in zip(tokens, held, strict=True))
    got = ppm.score(docs, held_out=queries.held_out(10)).collect()
    assert sorted((r.held_out, r.n_tokens, round(r.base_score, 6)) for r in got) == want


def test_url_rules(spark):
    urls = [None, "no scheme", "http://Shop.EXAMPLE.com/en/78?x", "http://shop.example.com/en/8", "https://com", "x://a.net/de/8#f", "https://b.org?/es/"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(table, queries.URL_RULES).collect()}
    assert got == {0: (None, "allow"), 1: (None, "allow"), 2: ("example.com/en/7", "allow"), 3: ("com/en/", "block"), 4: (None, "allow"), 5: ("net/de/", "block"), 6: (None, "allow")}


def test_url_rules_have_the_contract_words(spark):
    """block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/; the longest that fits wins."""
    urls = ["http://a.com/en/1", "http://a.example.com/en/7", "http://a.net/de/1", "http://a.example.net/de/8", "http://a.org/es/1"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(table, queries.URL_RULES).collect()}
    assert got == {0: ("com/en/", "block"), 1: ("example.com/en/7", "allow"), 2: ("net/de/", "allow"), 3: ("example.net/de/8", "block"), 4: ("org/es/", "block")}
