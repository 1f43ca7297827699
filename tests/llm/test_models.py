import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from switchyard.llm import language_id, quality, queries
from switchyard.llm.arrowtext import TokenRows

SMALL = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


class PlainKneserNey:
    """One language's interpolated model in dictionaries."""

    def __init__(self, words, floor=None):
        self.n, self.floor = [defaultdict(float) for _ in range(6)], floor
        for order in range(1, 6):
            before = defaultdict(set)
            for w, times in words.items():
                s = f" {w} "
                for i in range(max(1, order - 1), len(s)):
                    gram = s[i - order + 1 : i + 1]
                    if order == 5 or i + 1 == order:
                        self.n[order][gram] += times
                    else:
                        before[gram].add(s[i - order])
            for gram, found in before.items():
                self.n[order][gram] += len(found)
        self.after = [defaultdict(list) for _ in range(6)]
        for order in range(1, 6):
            for gram, n in self.n[order].items():
                self.after[order][gram[:-1]].append(n)

    def log(self, word):
        s, total = f" {word} ", 0.0
        for i in range(1, len(s)):
            p = self.floor
            for order in range(1, min(5, i + 1) + 1):
                gram = s[i - order + 1 : i + 1]
                follow = self.after[order].get(gram[:-1])
                if follow:
                    p = max(self.n[order].get(gram, 0) - 0.75, 0) / sum(follow) + p * 0.75 * len(follow) / sum(follow)
            total += math.log(p)
        return total


def test_kneser_ney_by_plain_python():
    counts = {"a": {"the": 5, "then": 2, "hen": 1, "é": 1}, "b": {"der": 4, "den": 3, "hen": 2, "ab": 1}}
    plain = {k: PlainKneserNey(w) for k, w in counts.items()}
    for m in plain.values():
        m.floor = 1 / (2 * max(len(p.n[1]) for p in plain.values()) + 1)
    models = language_id.LanguageModels.fit(counts)
    tokens = ["the", "Hen,", "dend", "ß", "x", "thethen", "12"]
    got = models.word_scores(tokens)
    for row, word in zip(got, ["the", "hen", "dend", "ß", "x", "thethen", ""]):
        want = [plain[k].log(word) if word else 0.0 for k in models.languages] + [len(word) + 1 if word else 0]
        assert np.allclose(row, want, rtol=1e-5)


def test_registered_language_query_by_plain_python(spark):
    docs = queries.table(spark, SMALL, "documents")
    got = queries.op3_language_id(spark, SMALL).collect()
    rows = {r.doc_id: r for r in docs.collect()}
    assert len(got) == len(rows) and all(r.held_out == held(r.doc_id) for r in got)
    outside = [r for r in got if r.held_out and rows[r.doc_id].lang]
    assert sum(r.lang_pred == rows[r.doc_id].lang for r in outside) >= 0.99 * len(outside) and not any(r.rejected for r in outside)
    # the models' words come from rows outside the held-out fold alone
    models = queries.fit_languages(docs)
    memo = TokenRows(models.word_scores, len(models.languages) + 1, np.float64)
    h, real = language_id._entropies(models, memo, [r.text for r in rows.values()])
    names = {i: models.languages[k] if r else "und" for i, k, r in zip(rows, h.argmin(axis=1), real)}
    assert {r.doc_id: r.lang_pred for r in got} == names
    foreign = spark.createDataFrame([(1, "Быстрая лиса прыгает через ленивую собаку"), (2, "xqzj kwvx zzqk jjxq vvkq qqxz"), (3, None), (4, " 12 !"), (5, rows[min(rows)].text)], "doc_id long, text string")
    assert [r.doc_id for r in language_id.keep_identified(foreign, models).collect()] == [5]


def test_one_odd_calibration_document_does_not_end_rejection():
    models = language_id.LanguageModels.fit({"a": {"x": 1}, "b": {"y": 1}})
    h = np.full((200, 2), 3.0)
    h[:, 0] = np.linspace(1.0, 1.4, 200)
    h[7, 0] = 500.0
    models.calibrate(h, np.zeros(200, dtype=int))
    assert 2.0 < models.limit[0] < 3.0 and models.limit[1] == np.inf


def test_equal_languages_go_to_the_first(spark):
    docs = spark.createDataFrame([(i, "same words here", "b" if i % 2 else "a", "x") for i in range(40)], "doc_id long, text string, lang string, lang_pred string")
    models = language_id.LanguageModels.fit({k: {"same": 1, "words": 1, "here": 1} for k in "ba"})
    models.calibrate(np.zeros((0, 2)), np.zeros(0, dtype=int))
    assert {r.lang_pred for r in language_id.predict(docs, models).collect()} == {"a"}


def plain_quality(texts, model_texts):
    """Word vectors from ``model_texts`` and pooled features of ``texts``, by loops."""
    index = quality.index_vectors()
    sums = np.zeros((quality.BUCKETS, quality.SIZE))

    def buckets(text):
        return quality.token_buckets((text or "").split())

    for text in model_texts:
        b = buckets(text)
        for i in range(len(b)):
            for j in range(max(0, i - quality.NEAR), min(len(b), i + quality.NEAR + 1)):
                if i != j:
                    for k in range(2):
                        sums[b[i, k]] += index[b[j, 0]] + index[b[j, 1]]
    vectors = index / math.sqrt(quality.NONZERO) + sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    out = []
    for text in texts:
        b = buckets(text)
        pooled = [sum((vectors[x] for x in b[:, k]), np.zeros(quality.SIZE)) / max(1, len(b)) for k in range(2)]
        out.append([*pooled[0], *pooled[1], math.log1p(len(b))])
    return vectors, np.array(out)


def test_quality_features_and_network_by_loops(spark):
    rows = [(i, f"good words number {i} stand here. And more" if i % 3 else f"BUY!!! now {i} $$$ {'x' * i}", i % 3 > 0) for i in range(60)] + [(70, None, True), (71, "", False)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(5, "zz the least text of an id teaches")], "doc_id long, text string").selectExpr("*", "1 AS label", "2 AS score")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(5, 1), (500, 1), (6, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    vectors, x = plain_quality([t for _, t, _ in rows], [t for _, t, _ in rows])
    assert np.allclose(model.vectors, vectors, atol=1e-4)
    net = model.net
    for (i, _, _), features in zip(rows, x):
        hidden = [math.tanh(sum((features[f] - net.mean[f]) / net.spread[f] * net.w1[f, h] for f in range(len(features))) + net.b1[h]) for h in range(len(net.b1))]
        want = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(hidden, net.w2)) + net.b2) / net.temperature))
        got = quality.score(docs.where(f"doc_id = {i} AND coalesce(text, '') NOT LIKE 'zz%'"), model).first() if i in (3, 4, 70, 71) else None
        assert got is None or abs(got.score - want) < 1e-3 and got.predicted == (got.score >= 0.3)
    # the network's gradient fits: labelled rows come out on their side
    assert ((net.probability(x) > 0.5) == np.array([y for *_, y in rows]))[:60].mean() > 0.95


def test_one_class_gives_the_smoothed_share(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    model = quality.fit(docs, docs.selectExpr("doc_id", "1 AS quality"))
    assert {round(r.score, 9) for r in quality.score(docs, model).collect()} == {round(6.5 / 7, 9)}


def test_registered_quality_query_learns_nothing_from_the_held_out_fold(spark):
    labels = {r.doc_id: r.quality for r in queries.table(spark, SMALL, "labels").collect()}
    got = queries.op1_quality(spark, SMALL).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in queries.table(spark, SMALL, "documents").select("doc_id").collect())
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    marked = [(r.score, labels[r.doc_id]) for r in got if r.held_out and labels.get(r.doc_id) in (0, 1)]
    good, bad = ([s for s, y in marked if y == k] for k in (1, 0))
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.93
    docs = queries.table(spark, SMALL, "documents")
    other = docs.withColumn("text", quality.F.when(queries.held_out(5), quality.F.lit("all else")).otherwise(quality.F.col("text")))
    one, two = (queries.fit_quality(d, queries.table(spark, SMALL, "labels")) for d in (docs, other))
    assert np.array_equal(one.vectors, two.vectors) and np.array_equal(one.net.w1, two.net.w1)


def test_texts_of_numerals_alone_have_no_language(spark):
    texts = ["½ ²", "①②", "Ⅷ", "٣ 12", "_ - 7", "½a", "一", "²é"]
    learn = spark.createDataFrame([(i, "the quick brown fox and a dog " * 3, "en") for i in range(40)], "doc_id long, text string, lang string")
    rows = language_id.predict(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), language_id.fit(learn)).collect()
    assert {texts[r.doc_id] for r in rows if r.lang_pred == "und"} == {t for t in texts if not any(c.isalpha() for c in t)}
