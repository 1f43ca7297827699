"""Language identification by interpolated Kneser-Ney character language models.

One model a language, over the letters of lower-cased words with a space at
both ends, up to five characters long. All models share sorted arrays of n-gram
and context hashes; per language they hold the discounted probability of an
n-gram and the back-off weight of a context. A document's language is the one of
lowest cross-entropy per character. Calibration documents, kept out of the
counts, give the scale that turns cross-entropies into a score, and per
language the cross-entropy above which a document is rejected: twice the one that 99
in 100 of its own calibration documents stay below, so single odd documents don't move it.

The models are fitted on a bounded sample of labelled rows: about
``rows_per_language`` of each language, picked by a hash of the id, whole texts; of rows of
one id and language the least text teaches.

Defined cases: a null text, or one without any letter, is ``und`` with score 0
and rejected; an empty table, or one without training rows, predicts ``und``
everywhere; rows with null lang teach nothing; repeated rows are predicted each
for itself; equal cross-entropies go to the alphabetically first language.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchyard.llm.arrowtext import TokenRows, slices, texts_of

ORDER, DISCOUNT = 5, 0.75
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _numerals() -> str:
    """Characters that count as parts of words for being numerals of some kind (½, ², ①, Ⅷ), but are no letters."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha())


_NUMERALS, _OTHERS = re.compile(f"[{_numerals()}]"), re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """A text's letters, with a space for each run of anything else."""
    return _OTHERS.sub(" ", text if text.isascii() else _NUMERALS.sub(" ", text)).strip()
UNDETERMINED = "und"


def _gram_hashes(words: list[str]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Over the characters of " word " joined: ends of predicted characters' n-grams.

    Returns (word number of each predicted character, hashes by order 1..ORDER,
    place in the word, order hashes of contexts are the previous character's).
    """
    text = "".join(f" {w} " for w in words)
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes = [(points + np.uint64(1)) * _MULTIPLIER]
    for order in range(2, ORDER + 1):
        before = np.concatenate([np.zeros(1, np.uint64), hashes[-1][:-1]])
        mixed = before ^ (before >> np.uint64(29))
        hashes.append(mixed * np.uint64(0xBF58476D1CE4E5B9) + (points + np.uint64(order)) * _MULTIPLIER)
    return owner, hashes, place, sizes


@dataclass
class LanguageModels:
    """Sorted hash arrays of all languages and what calibration gave."""

    languages: list[str]
    grams: list[np.ndarray]  # by order: sorted hashes
    gram_p: list[np.ndarray]  # by order: [gram, language] discounted probability
    contexts: list[np.ndarray]  # by context length 0..ORDER-1
    backoff: list[np.ndarray]  # [context, language]; 1 where a language lacks the context
    floor: float  # probability of a character under no context
    scale: float = 20.0
    limit: np.ndarray | None = None  # cross-entropy above which a language's document is rejected

    @classmethod
    def fit(cls, counts: dict[str, dict[str, int]]) -> LanguageModels:
        """From word counts of each language."""
        languages = sorted(counts)
        per_language = [_raw_tables(counts[name]) for name in languages]
        alphabet = max([1, *(len(t[0][0][0]) for t in per_language)])
        grams, gram_p, contexts, backoff = [], [], [], []
        for order in range(1, ORDER + 1):
            all_grams = np.unique(np.concatenate([t[order - 1][0][0] for t in per_language]))
            all_contexts = np.unique(np.concatenate([t[order - 1][1][0] for t in per_language]))
            p, b = np.zeros((len(all_grams), len(languages))), np.ones((len(all_contexts), len(languages)))
            for k, t in enumerate(per_language):
                (g, n, of), (c, total, kinds) = t[order - 1]
                p[np.searchsorted(all_grams, g), k] = np.maximum(n - DISCOUNT, 0) / total[np.searchsorted(c, of)]
                b[np.searchsorted(all_contexts, c), k] = DISCOUNT * kinds / total
            grams.append(all_grams)
            gram_p.append(p.astype(np.float32))
            contexts.append(all_contexts)
            backoff.append(b.astype(np.float32))
        return cls(languages, grams, gram_p, contexts, backoff, 1.0 / (2 * alphabet + 1))

    def word_scores(self, tokens: list[str]) -> np.ndarray:
        """[token, language...] sums of natural log probabilities, and last the predicted characters."""
        words = [letters(t.lower()) for t in tokens]
        out = np.zeros((len(tokens), len(self.languages) + 1))
        real = [i for i, w in enumerate(words) if w]
        if not real:
            return out
        owner, hashes, place, sizes = _gram_hashes([words[i] for i in real])
        predicted = np.flatnonzero(place > 0)
        p = np.full((len(predicted), len(self.languages)), self.floor)
        for order in range(1, ORDER + 1):
            at = place[predicted] + 1 >= order
            ends = predicted[at]
            context = hashes[order - 2][ends - 1] if order > 1 else np.zeros(len(ends), np.uint64)
            p[at] = _take(self.grams[order - 1], self.gram_p[order - 1], hashes[order - 1][ends], 0.0) + p[at] * _take(self.contexts[order - 1], self.backoff[order - 1], context, 1.0)
        logs = np.log(p)
        for k in range(len(self.languages)):
            out[real, k] = np.bincount(owner[predicted], logs[:, k], minlength=len(real))
        out[real, -1] = sizes - 1
        return out

    def calibrate(self, entropies: np.ndarray, truth: np.ndarray) -> None:
        """Score scale of least log loss, and limits of twice the 99th percentile of each language's own calibration documents."""
        gap = -(entropies - entropies.min(axis=1, keepdims=True))
        losses = {}
        for scale in (2.0, 5.0, 10.0, 20.0, 40.0, 80.0):
            z = gap * scale
            losses[scale] = float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth])) if len(z) else scale
        self.scale = min(losses, key=losses.get)
        self.limit = np.full(len(self.languages), np.inf)
        for k in range(len(self.languages)):
            own = entropies[truth == k, k]
            if len(own):
                self.limit[k] = 2.0 * np.quantile(own, 0.99)


def _take(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    got = values[at].astype(np.float64)
    got[keys[at] != wanted] = missing
    return got


def _raw_tables(counts: dict[str, int]) -> list[tuple]:
    """By order: ((grams, counts, their contexts), (contexts, totals, distinct followers)).

    The longest n-grams, and those that begin a word, count occurrences; others
    count their distinct left neighbours.
    """
    words = list(counts)
    owner, hashes, place, _ = _gram_hashes(words)
    weight = np.fromiter((counts[w] for w in words), dtype=np.float64, count=len(words))[owner]
    out = []
    for order in range(1, ORDER + 1):
        ends = np.flatnonzero((place > 0) & (place + 1 >= order))
        if order < ORDER:
            starts = ends[place[ends] + 1 == order]  # the n-gram begins the word
            longer = ends[place[ends] + 1 > order]
            _, first = np.unique(hashes[order][longer], return_index=True)  # distinct left extensions
            ends = np.concatenate([starts, longer[first]])
            w = np.concatenate([weight[starts], np.ones(len(first))])
        else:
            w = weight[ends]
        context = hashes[order - 2][ends - 1] if order > 1 else np.zeros(len(ends), np.uint64)
        grams, first, inverse = np.unique(hashes[order - 1][ends], return_index=True, return_inverse=True)
        n = np.bincount(inverse, w, minlength=len(grams))
        of = context[first]
        found, back = np.unique(of, return_inverse=True)
        total, kinds = np.bincount(back, n, minlength=len(found)), np.bincount(back, minlength=len(found))
        out.append(((grams, n, of), (found, total, kinds)))
    return out


def _entropies(models: LanguageModels, memo: TokenRows, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """([document, language] nats a character, whether it has a letter)."""
    rows = memo.rows([(t or "").split() for t in texts])
    sums = np.array([memo.table[r].sum(axis=0) for r in rows]).reshape(len(texts), len(models.languages) + 1)
    return -sums[:, :-1] / np.maximum(sums[:, -1:], 1), sums[:, -1] > 0


def fit(train: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows_per_language: int = 1000) -> LanguageModels:
    """Models from the rows of ``train`` with a language; every fifth sampled row calibrates."""
    rows = train.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.lit("language-id"), f"`{doc_id}`").alias("pick"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageModels([], [], [], [], [], 1.0)
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1_000_000, -(-rows_per_language * 1_000_000 // n)))])
    sample = rows.where(F.pmod("pick", F.lit(1_000_000)) < share[F.col("lang")])
    sample = sample.groupBy("lang", "pick").agg(F.min("text").alias("text"))  # a repeated id is one row
    sample = sample.withColumn("calibrates", F.pmod(F.xxhash64("pick"), F.lit(5)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((name, w) for w in map(letters, t.lower().split()) if w)
            if counts:
                names, words = zip(*counts, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(words), pa.array(counts.values(), pa.int64())], ["lang", "word", "n"])

    learn = sample.where(~F.col("calibrates")).select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    words: dict[str, dict[str, int]] = {}
    counted = learn.groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    for name, found, n in zip(*(c.to_pylist() for c in counted.columns), strict=True):
        words.setdefault(name, {})[found] = n
    if not words:
        return LanguageModels([], [], [], [], [], 1.0)
    models = LanguageModels.fit(words)
    held = sample.where("calibrates").select("lang", "text")
    shared = train.sparkSession.sparkContext.broadcast(models)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        memo = TokenRows(m.word_scores, len(m.languages) + 1, np.float64)
        for batch in batches:
            for part in slices(batch):
                h, real = _entropies(m, memo, texts_of(part))
                names = [n if r else None for n, r in zip(part.column(0).to_pylist(), real, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(list(h), pa.list_(pa.float64()))], ["lang", "h"])

    got = held.mapInArrow(entropies, "lang string, h array<double>").where(F.col("lang").isin(models.languages)).collect()
    h = np.array([r["h"] for r in got]).reshape(-1, len(models.languages))
    models.calibrate(h, np.array([models.languages.index(r["lang"]) for r in got], dtype=np.int64))
    return models


def _predictor(shared):
    def predict(texts: list, memo: TokenRows | None) -> tuple[list[str], np.ndarray, np.ndarray]:
        m = shared.value
        if memo is None:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, real = _entropies(m, memo, texts)
        best = h.argmin(axis=1)
        score = 1 / np.exp(-(h - h.min(axis=1, keepdims=True)) * m.scale).sum(axis=1)
        rejected = ~real | (h[np.arange(len(h)), best] > m.limit[best])
        names = [m.languages[b] if r else UNDETERMINED for b, r in zip(best, real, strict=True)]
        return names, np.where(real, score, 0.0), rejected

    def memo() -> TokenRows | None:
        m = shared.value
        return TokenRows(m.word_scores, len(m.languages) + 1, np.float64) if m.languages else None

    return predict, memo


def predict(docs: DataFrame, models: LanguageModels, *, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document."""
    held = F.lit(None).cast("boolean") if held_out is None else held_out
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held.alias("held_out"), F.col(f"`{text}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    judge, new_memo = _predictor(docs.sparkSession.sparkContext.broadcast(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = new_memo()
        for batch in batches:
            for part in slices(batch):
                names, score, rejected = judge(texts_of(part), memo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, models: LanguageModels, *, text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose language is not rejected."""
    judge, new_memo = _predictor(docs.sparkSession.sparkContext.broadcast(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = new_memo()
        for batch in batches:
            for part in slices(batch, text):
                _, _, rejected = judge(texts_of(part, text), memo)
                yield part.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
