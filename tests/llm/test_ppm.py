import math
import zlib
from collections import Counter, defaultdict

import pytest

from switchyard.llm import ppm, queries

TEXTS = [
    None, "", " ", "The cat sat. The cat ran! No", "the cat sat. The Cat ran! no\nmore words here", "the cat sat. a dog ran! no",
    "x\x85y\x1cz é 漢字", "long" * 40 + " long" * 40, " ".join(f"w{i % 7}" for i in range(60)), " ".join(f"w{i % 7}" for i in range(60)),
    "le chat. le chat. le chat. le chien. " * 9, "le chat. le chat. le chat. le chien. " * 5 + "fin", "a", "b. b. b. b. a",
    "one two three four five six seven eight. nine. ten eleven twelve one two three four. end of it all", "one two three four five six seven eight. nine. ten eleven",
    "one two three four five six seven eight. nine. ten eleven twelve one two three four. end of it all",
]


def split(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def plain_segments(tokens):
    out, now = [], []
    for t in tokens:
        now.append(t)
        if (t[-1:] in (b".", b"!", b"?") and len(now) >= ppm.LEAST) or len(now) == ppm.SEGMENT:
            out.append(tuple(now))
            now = []
    return out + ([tuple(now)] if now else [])


class PlainModel:
    """The model of ppm's docstring in dictionaries."""

    def __init__(self, texts, classes):
        self.classes = classes
        self.bytes, self.follow = defaultdict(Counter), defaultdict(Counter)
        for text in texts:
            for state, t in self.stated(split(text)):
                for context, symbol in self.positions(state, t):
                    for k in range(len(context) + 1):
                        self.bytes[context[len(context) - k :]][symbol] += 1
            for context, segment in self.uses(text):
                self.follow[context][segment] += 1

    def stated(self, tokens):
        state = 0
        for t in tokens:
            yield ppm._STATES[state], t
            state = self.classes.get(t, state)

    @staticmethod
    def positions(state, token):
        whole = state + token + b" "
        return [(whole[max(0, i - ppm.ORDER) : i], whole[i]) for i in range(1, len(whole))]

    @staticmethod
    def uses(text):
        segments, seen = plain_segments(split(text)), set()
        for before, now in zip(segments, segments[1:]):
            if before not in seen:
                seen.add(before)
                yield before, now

    def byte(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(len(context), -1, -1):
            found = self.bytes.get(context[len(context) - k :])
            if not found:
                continue
            left = {s: n for s, n in found.items() if s not in excluded}
            total = sum(left.values())
            if symbol in left:
                return p * (left[symbol] - 0.5) / total
            if left:
                p *= 0.5 * len(left) / total
            excluded = set(found)
        return p / max(1, 256 - len(excluded))

    def score(self, text, learned):
        segments, seen, total, stated = plain_segments(split(text)), set(), 0.0, self.stated(split(text))
        for i, segment in enumerate(segments):
            lp = sum(math.log10(self.byte(c, s)) for _ in segment for c, s in self.positions(*next(stated)))
            if i and segments[i - 1] not in seen:
                seen.add(segments[i - 1])
                found = Counter(self.follow[segments[i - 1]])
                if learned:
                    found[segment] -= 1
                found = +found
                if found:
                    n = found.total()
                    lp = math.log10((found[segment] - 0.5) / n) if segment in found else lp + math.log10(0.5 * len(found) / n)
            total += lp
        return total


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


@pytest.fixture()
def docs(spark):
    rows = [(i * 3, t, f"row {i}", i) for i, t in enumerate(TEXTS)] + [(None, "the cat sat. a dog ran! no", None, 0), (3, "", "again", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, lp int")


def scores(docs, parts=None):
    got = ppm.score(docs.repartition(parts) if parts else docs, held_out=queries.held_out(10)).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)


def test_both_scores_by_plain_python(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    train = [t for i, t in rows if not held(i)]
    assert 2 < len(train) < len(rows)
    counts = Counter(w for t in train for w in split(t))
    below = counts.total() + 0.1 * (len(counts) + 1)
    model = PlainModel(train, ppm.fit_classes(docs.where(~queries.held_out(10)).select("text")))
    want = sorted(
        (
            -1 if i is None else i, held(i), len(split(t)), sum(counts[w] > 0 for w in split(t)), counts.total(),
            round(sum(math.log10((counts[w] + 0.1) / below) for w in split(t)), 6), round(model.score(t, not held(i)), 6),
        )
        for i, t in rows
    )
    assert scores(docs) == want


def test_scores_do_not_depend_on_splits_or_on_what_is_broadcast(docs, monkeypatch):
    one = scores(docs, 1)
    assert scores(docs, 4) == one and scores(docs, 32) == one
    monkeypatch.setattr(ppm, "TOKEN_SHARE", 1)
    monkeypatch.setattr(ppm, "NODE_SHARE", 1)
    monkeypatch.setattr(ppm, "SEGMENT_SHARE", 1)
    monkeypatch.setattr(ppm, "TRIE_KEYS", 5)
    monkeypatch.setattr(ppm, "HELD", 3)
    assert scores(docs, 3) == one


def test_empty_table_and_no_training_rows(docs):
    assert scores(docs.where("false")) == []
    got = ppm.score(docs.where("doc_id = 36"), held_out=ppm.F.lit(True)).collect()
    assert [(r.n_known, r.train_tokens, round(r.score, 6)) for r in got] == [(0, 0, round(-4 * math.log10(256), 6))]


def test_anchors_are_the_most_frequent_words_of_all_tasks(spark):
    texts = [" ".join([f"w{i}x{k}" for k in range(2100)] * 2 + ["everywhere"] + [f"usual{k}" for k in range(400)] * 40 + ["usual7"] * i + ["long" * 20] * 9) for i in range(4)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(t,) for t in texts], 5), "text string")
    counts = Counter(w for t in texts for w in t.encode().split())
    most = sorted((w for w in counts if len(w) <= 64), key=lambda w: (-counts[w], w))[:255]
    assert set(ppm._likely_anchors(docs, 0)) == set(most) and len(ppm._likely_anchors(docs, 2)) == 400
    assert set(ppm.fit_classes(docs)) == set(most)
    few = docs.where("text LIKE 'w0x%'").selectExpr("'' || left(text, 40) AS text")
    assert len(ppm.fit_classes(few)) == len(set(few.first().text.split()))


def test_held_out_copies_stand_apart_and_the_model_beats_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [r for r in ppm.score(docs, held_out=queries.held_out(10)).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens + 0.3
