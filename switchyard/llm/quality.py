"""Document quality: random-indexing word vectors and a small two-layer network.

Each white-space token gives two words: its letters and digits, and its shape
(case, digits, marks around it). Words hash into ``BUCKETS`` rows. A row has a
fixed sparse ternary index vector; its word vector is the index vector plus the
normalised sum of the index vectors of words near it in the training texts
(random indexing). A document is the mean of its words' vectors, letters and
shapes apart, with its logarithmic length. A two-layer network maps that to a
log-odds, and a temperature fitted on rows kept out of its training makes the
probability calibrated.

Everything is fitted on at most about ``sample_rows`` labelled rows, picked by a
hash of the row (a documented bound); scoring covers every whole text.

Defined cases: null and empty texts are scored as documents without words; rows
without a label teach nothing; with no labelled row, or one class only, every
score is the smoothed share of label 1, (ones + 1/2) / (rows + 1); of rows of one id the least
text teaches, so a repeated id is one row of the sample; repeated rows are scored each for itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchyard.llm.arrowtext import TokenRows, slices, texts_of
from switchyard.storage import discard, materialize

BUCKETS, SIZE, NONZERO, NEAR = 1 << 15, 64, 6, 2
_INNER = re.compile(r"[^\W_]+")


def index_vectors() -> np.ndarray:
    """The fixed sparse ternary vectors of all buckets."""
    rng = np.random.default_rng(20_230)
    out = np.zeros((BUCKETS, SIZE), dtype=np.float32)
    places = rng.random((BUCKETS, SIZE)).argsort(axis=1)[:, :NONZERO]
    signs = np.where(np.arange(NONZERO) % 2 == 0, 1, -1).astype(np.float32)
    np.put_along_axis(out, places, np.broadcast_to(signs, places.shape), axis=1)
    return out


def token_buckets(tokens: list[str]) -> np.ndarray:
    """[token, (letters' bucket, shape's bucket)]."""
    out = np.empty((len(tokens), 2), dtype=np.int32)
    for i, t in enumerate(tokens):
        core = "".join(_INNER.findall(t))
        case = "a" if core.islower() else "A" if core.isupper() and len(core) > 1 else "Aa" if core.istitle() else "x"
        marks = _INNER.sub("a", t) if len(t) <= 24 else "long"
        digits = "9" if any(c.isdigit() for c in core) else ""
        out[i, 0] = xxhash.xxh32_intdigest("w" + core.lower()) % BUCKETS
        out[i, 1] = xxhash.xxh32_intdigest(f"s{case}{digits}{marks}") % BUCKETS
    return out


def _bucket_lists(memo: TokenRows, texts: list) -> list[np.ndarray]:
    rows = memo.rows([(t or "").split() for t in texts])
    return [memo.table[r] for r in rows]


def context_sums(docs: list[np.ndarray], index: np.ndarray) -> np.ndarray:
    """Sums of the index vectors of words up to NEAR tokens away, by bucket."""
    total = np.zeros((BUCKETS, SIZE), dtype=np.float32)
    for words in docs:
        both = index[words[:, 0]] + index[words[:, 1]]
        near = np.zeros_like(both)
        for step in range(1, min(NEAR, len(words) - 1) + 1):
            near[step:] += both[:-step]
            near[:-step] += both[step:]
        for k in range(2):
            np.add.at(total, words[:, k], near)
    return total


def word_vectors(sums: np.ndarray, index: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return index / np.sqrt(NONZERO) + sums / np.maximum(length, 1e-9)


def pool(docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """[document, feature] means of word vectors, and log lengths."""
    out = np.zeros((len(docs), 2 * SIZE + 1))
    for i, words in enumerate(docs):
        n = len(words)
        if n:
            for k in range(2):
                found, times = np.unique(words[:, k], return_counts=True)
                out[i, k * SIZE : (k + 1) * SIZE] = (times @ vectors[found]) / n
        out[i, -1] = np.log1p(n)
    return out


@dataclass
class TwoLayer:
    """Standardised inputs, tanh hidden layer, log-odds output, temperature."""

    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, calibrates: np.ndarray, hidden: int = 32, epochs: int = 400) -> TwoLayer:
        base = float(y.mean()) if len(y) else 0.5
        train = ~calibrates if len(np.unique(y[~calibrates])) == 2 else np.ones(len(y), bool)
        if len(np.unique(y[train])) < 2:
            odds = np.log((base * len(y) + 0.5) / ((1 - base) * len(y) + 0.5)) if len(y) else 0.0
            size = x.shape[1]
            return cls(np.zeros(size), np.ones(size), np.zeros((size, 1)), np.zeros(1), np.zeros(1), float(odds))
        mean, spread = x[train].mean(axis=0), x[train].std(axis=0) + 1e-6
        a, t = (x[train] - mean) / spread, y[train].astype(float)
        rng = np.random.default_rng(7)
        p = [rng.normal(0, 1 / np.sqrt(a.shape[1]), (a.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
        for step in range(1, epochs + 1):
            h = np.tanh(a @ p[0] + p[1])
            d = (_sigmoid(h @ p[2] + p[3]) - t) / len(t)
            back = np.outer(d, p[2]) * (1 - h * h)
            grads = [a.T @ back + 2e-4 * p[0], back.sum(axis=0), h.T @ d + 2e-4 * p[2], d.sum(keepdims=True)]
            for i, g in enumerate(grads):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        net = cls(mean, spread, p[0], p[1], p[2], float(p[3][0]))
        own = calibrates & ~train
        if len(np.unique(y[own])) == 2:
            z, t = net.log_odds(x[own]), y[own]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
            loss = [np.mean(np.logaddexp(0, z / g) - t * z / g) for g in grid]
            net.temperature = float(grid[int(np.argmin(loss))])
        return net

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.spread) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.log_odds(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


@dataclass
class QualityModel:
    vectors: np.ndarray
    net: TwoLayer


def fit(train: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = 8000) -> QualityModel:
    """From the documents of ``train`` that ``labels(doc_id, label)`` marks 0 or 1."""
    spark = train.sparkSession
    marked = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where("label IN (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.min("label").alias("label"))
    pick = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000))
    share = min(1_000_000, -(-sample_rows * 1_000_000 // max(1, marked.count())))
    chosen = F.broadcast(marked.where(pick < share))  # about sample_rows rows of (id, label)
    texts = train.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    texts = texts.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    sample = materialize(texts.select("doc_id", "text", "label").withColumn("calibrates", F.pmod(F.xxhash64(F.lit("temperature"), "doc_id"), F.lit(5)) == 0), "quality-sample")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = index_vectors(), TokenRows(token_buckets, 2, np.int32)
        total = np.zeros((BUCKETS, SIZE), dtype=np.float32)
        for batch in batches:
            for part in slices(batch):
                total += context_sums(_bucket_lists(memo, texts_of(part)), index)
        rows = np.flatnonzero(total.any(axis=1))
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([total[r].tobytes() for r in rows], pa.binary())], ["bucket", "sums"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found[bucket] = found.get(bucket, np.float32(0)) + np.frombuffer(raw, dtype=np.float32)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["bucket", "sums"])

    partial = sample.select("text").coalesce(8).mapInArrow(sums, "bucket int, sums binary")  # at most 8 * BUCKETS rows
    # sorted, so that floats add up alike in every run; the driver gets at most BUCKETS rows
    whole = partial.repartition("bucket").sortWithinPartitions("bucket", "sums").mapInArrow(add_up, "bucket int, sums binary").toArrow()
    total = np.zeros((BUCKETS, SIZE), dtype=np.float32)
    if len(whole):
        total[whole["bucket"].to_numpy()] = np.frombuffer(b"".join(whole["sums"].to_pylist()), dtype=np.float32).reshape(-1, SIZE)
    vectors = word_vectors(total, index_vectors())
    shared = spark.sparkContext.broadcast(vectors)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = TokenRows(token_buckets, 2, np.int32)
        for batch in batches:
            for part in slices(batch):
                x = pool(_bucket_lists(memo, texts_of(part)), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["label", "calibrates", "x"])

    got = sample.select("text", "label", "calibrates").mapInArrow(pooled, "label int, calibrates boolean, x binary").toArrow()
    rows = sorted(zip(*(c.to_pylist() for c in got.columns), strict=True), key=lambda r: (r[2], r[0], r[1]))
    discard(sample)
    x = np.array([np.frombuffer(r[2]) for r in rows]).reshape(len(rows), 2 * SIZE + 1)
    net = TwoLayer.fit(x, np.array([r[0] for r in rows], dtype=int), np.array([r[1] for r in rows], dtype=bool))
    return QualityModel(vectors, net)


def score(docs: DataFrame, model: QualityModel, *, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    held = F.lit(None).cast("boolean") if held_out is None else held_out
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held.alias("held_out"), F.col(f"`{text}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = TokenRows(token_buckets, 2, np.int32)
        for batch in batches:
            for part in slices(batch):
                p = shared.value.net.probability(pool(_bucket_lists(memo, texts_of(part)), shared.value.vectors))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs``, all columns, whose score reaches ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = TokenRows(token_buckets, 2, np.int32)
        for batch in batches:
            for part in slices(batch, text):
                p = shared.value.net.probability(pool(_bucket_lists(memo, texts_of(part, text)), shared.value.vectors))
                yield part.filter(pa.array(p >= threshold))

    return docs.mapInArrow(run, docs.schema)
