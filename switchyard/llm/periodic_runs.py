"""Periodic runs of words: maximal stretches that repeat with a period.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical) and at least ``max(min_length, min_exponent * q)`` words
which no neighbouring word extends with that period.

Method: repeated k-gram masking. Such a run overlaps its own shift by ``q`` in
at least ``max(min_length, min_exponent * q) - q`` words. With ``k`` the least
such overlap over all ``q``, each word of a run lies in a k-gram that occurs at
least twice in its document. All other words are masked: they can't join a run.
The stretches that survive go through the Main-Lorentz division: a run crosses
the middle of exactly one part that holds it whole, and its longer half there
shows a period, so the candidates are the periods at which the words beside the
middle come again; two common extensions, forward and backward, give the run.
All segments of a slice of documents are divided together, level by level, in
numpy. Extensions are found on rolling hashes by bisection; a hash can only make
one too long, never too short, so comparing the words of all runs found proves
the result, and a failed comparison starts anew with other hashes.

Defined cases: a null or empty text has no words, no runs and an empty collapsed
text; words are split at space and \\x09-\\x0D only; a long text is one piece of
work of O(n log^2 n) steps and O(n) memory; repeated rows are judged each for
itself; equal starts are listed by period; an empty table gives an empty result;
other columns, whatever their names, are ignored. Every task judges its own
rows without a shuffle, so a lost one is simply done again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from switchyard.llm.arrowtext import need, slices

MIN_LENGTH, MIN_EXPONENT = 6, 4
_PRIME = (1 << 31) - 1
#: Word pairs compared at a time when runs are proved.
_PROOF = 1 << 22


def gram_size(min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> int:
    """Least overlap of a run with its shift by one period; no longer gram is sure to occur twice."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length // min_exponent + 2))


def surviving(words: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """Whether each word lies in a k-gram that occurs at least twice in its document.

    ``words``: the ids of all documents' words, one after the other; ``ends``: where each document ends. Grams are told
    apart by a 64-bit hash; two that fall together only let words survive for nothing.
    """
    n, sizes = len(words), np.diff(ends, prepend=0)
    if n < k:
        return np.zeros(n, dtype=bool)
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    grams = np.repeat(np.arange(1, len(ends) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), sizes)[: n - k + 1]
    for j in range(k):
        grams = grams * np.uint64(0xBF58476D1CE4E5B9) + mixed[j : n - k + 1 + j]
    grams ^= grams >> np.uint64(31)
    inside = np.repeat(ends, sizes)[: n - k + 1] >= np.arange(k, n + 1)
    ordered = np.sort(grams[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(n, dtype=bool)
    at = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    starts = np.flatnonzero(inside & (twice[at] == grams))
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + k, -1)
    return np.cumsum(steps[:n]) > 0


def segments(mask: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of set words; none passes the end of a document."""
    edge = np.zeros(len(mask) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = mask[1:] != mask[:-1]
    edge[ends] = True
    cuts = np.flatnonzero(edge)
    lo, hi = cuts[:-1], cuts[1:]
    held = mask[lo] if len(mask) else np.zeros(0, dtype=bool)
    return lo[held], hi[held]


class _Hashes:
    """Equality of stretches by a polynomial hash modulo a prime; equal stretches always have equal hashes."""

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        base, salt, slope = (int(x) for x in rng.integers(1 << 20, _PRIME - 1, 3))
        n = len(words)
        self.powers = np.ones(n + 1, dtype=np.int64)
        filled, step = 1, base
        while filled <= n:  # doubles the table: base**(i + filled) from base**i
            take = min(filled, n + 1 - filled)
            self.powers[filled : filled + take] = self.powers[:take] * step % _PRIME
            step, filled = step * step % _PRIME, filled + take
        value = ((words % _PRIME) * slope + salt) % _PRIME
        self.sums = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(value * self.powers[:n] % _PRIME, out=self.sums[1:])  # below 2**63 for up to 2**32 words
        self.sums %= _PRIME

    def equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches at ``i`` and ``j`` (``i`` <= ``j``) look alike."""
        a, b = (self.sums[i + size] - self.sums[i]) % _PRIME, (self.sums[j + size] - self.sums[j]) % _PRIME
        return a * self.powers[j - i] % _PRIME == b

    def forward(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Common length of what begins at ``i`` and ``j``, up to ``limit``."""
        return self._bisect(limit, lambda size, at: self.equal(i[at], j[at], size))

    def backward(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Common length of what ends before ``i`` and ``j``, up to ``limit``."""
        return self._bisect(limit, lambda size, at: self.equal(i[at] - size, j[at] - size, size))

    @staticmethod
    def _bisect(limit: np.ndarray, alike) -> np.ndarray:
        least, most = np.zeros_like(limit), limit.copy()
        at = np.flatnonzero(most > 0)
        step = np.ones(len(at), dtype=np.int64)
        while len(at):  # doubles the length while it fits, then bisects
            size = np.where(step > 0, np.minimum(least[at] + step, most[at]), (least[at] + most[at] + 1) >> 1)
            good = alike(size, at)
            least[at[good]] = size[good]
            most[at[~good]] = size[~good] - 1
            step = np.where(good, step * 2, 0)
            left = least[at] < most[at]
            at, step = at[left], step[left]
        return least


def _crossing(words: np.ndarray, hashes: _Hashes, parts: tuple[np.ndarray, ...], min_length: int, min_exponent: int) -> list[np.ndarray]:
    """Runs (start, end, period) that cross the middle of a part and lie in it whole; also some multiples of a period."""
    lo, hi, low, high = parts
    mid, found = (lo + hi) >> 1, []
    for right in (True, False):
        half = hi - mid if right else mid - lo
        most = np.minimum(2 * half, hi - lo) // min_exponent
        node = np.repeat(np.arange(len(lo)), most)
        p = np.arange(1, len(node) + 1) - np.repeat(np.cumsum(most) - most, most)
        m, side = mid[node], (np.maximum(min_length, min_exponent * p) + 1) >> 1  # the longer half has so many words at least
        one, two = (m, m + 1) if right else (m - 1, m - 2)
        shift = p if right else -p
        good = (side <= p) | (words[one] == words[one + shift])
        good &= (side < p + 2) | (words[two] == words[two + shift])
        good &= side <= half[node]
        node, p, m, side = node[good], p[good], m[good], side[good]
        if right:
            far = p + hashes.forward(m, m + p, high[node] - m - p)
            keep = far >= side
            node, p, m, far = node[keep], p[keep], m[keep], far[keep]
            start, end = m - hashes.backward(m, m + p, m - low[node]), m + far
        else:
            far = p + hashes.backward(m - p, m, m - p - low[node])
            keep = far >= side
            node, p, m, far = node[keep], p[keep], m[keep], far[keep]
            start, end = m - far, m + hashes.forward(m - p, m, high[node] - m)
        keep = (end - start >= np.maximum(min_length, min_exponent * p)) & (start >= lo[node]) & (end <= hi[node])
        found.append(np.stack([start[keep], end[keep], p[keep]]))
    return found


def _proved(words: np.ndarray, runs: np.ndarray) -> bool:
    """Whether every run really has its period."""
    sizes = runs[1] - runs[0] - runs[2]
    for at in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(sizes) // _PROOF)) + 1):
        size = sizes[at]
        here = np.repeat(runs[0][at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        if not np.array_equal(words[here], words[here + np.repeat(runs[2][at], size)]):
            return False
    return True


def main_lorentz(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """All runs inside the given segments, as rows start, end, period, in order of start and period."""
    padded = np.concatenate([np.asarray(words, dtype=np.int64), [-1, -1]])
    for seed in range(1 << 20):
        hashes, found = _Hashes(padded[:-2], seed), [np.zeros((3, 0), dtype=np.int64)]
        parts = tuple(x[hi - lo >= min_length] for x in (lo, hi, lo, hi))
        while len(parts[0]):
            found += _crossing(padded, hashes, parts, min_length, min_exponent)
            mid = (parts[0] + parts[1]) >> 1
            halves = (np.concatenate([parts[0], mid]), np.concatenate([mid, parts[1]]), np.tile(parts[2], 2), np.tile(parts[3], 2))
            parts = tuple(x[halves[1] - halves[0] >= min_length] for x in halves)
        runs = np.concatenate(found, axis=1)
        runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
        first = np.ones(runs.shape[1], dtype=bool)  # of equal stretches the one with the smallest period
        first[1:] = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
        runs = runs[:, first]
        if _proved(padded, runs):
            return runs[:, np.lexsort((runs[2], runs[0]))]
    raise RuntimeError("no hash told the stretches apart")


def runs_of(documents: list[list], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of documents given as lists of words: rows start, end, period over all words; where documents end; words dropped."""
    ids: dict = {}
    flat = [w for words in documents for w in words]
    for w in set(flat):
        ids[w] = len(ids)
    words = np.fromiter(map(ids.__getitem__, flat), dtype=np.int64, count=len(flat))
    ends = np.cumsum([len(d) for d in documents], dtype=np.int64)
    mask = surviving(words, ends, gram_size(min_length, min_exponent))
    lo, hi = segments(mask, ends)
    kept = hi - lo >= min_length
    lo, hi = lo[kept], hi[kept]
    size = hi - lo
    after = np.cumsum(size)  # the segments, one after the other
    shift = lo - (after - size)
    near = words[np.repeat(shift, size) + np.arange(size.sum())]
    runs = main_lorentz(near, after - size, after, min_length, min_exponent)
    back = shift[np.searchsorted(after, runs[0], side="right")] if runs.shape[1] else np.zeros(0, dtype=np.int64)
    runs = np.stack([runs[0] + back, runs[1] + back, runs[2]])
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, runs[0] + runs[2], 1)
    np.add.at(steps, runs[1], -1)
    return runs, ends, np.cumsum(steps[: len(words)]) > 0


def find_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Every document's runs and its text without their repeats.

    Columns: doc_id, n_words, runs (start, length, period; words count from 0), collapsed (the words that no run
    contains after its first period, joined by one space).
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run repeats at least once: min_exponent and min_length are 2 or more")
    source = need(docs, doc_id=doc_id, text=text)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(part.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
        documents = [t.split() if t else [] for t in texts]  # bytes split at space and \x09-\x0D
        runs, ends, dropped = runs_of(documents, min_length, min_exponent)
        starts = ends - np.diff(ends, prepend=0)
        owner = np.searchsorted(ends, runs[0], side="right")
        spans = pa.StructArray.from_arrays([pa.array(x) for x in (runs[0] - starts[owner], runs[1] - runs[0], runs[2])], ["start", "length", "period"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int32)
        for i in np.unique(owner):
            stay = np.flatnonzero(~dropped[starts[i] : ends[i]]).tolist()
            documents[i] = [documents[i][j] for j in stay]
        joined = [b" ".join(words).decode() for words in documents]
        columns = [part.column(part.schema.get_field_index("doc_id")), pa.array(np.diff(ends, prepend=0)), pa.ListArray.from_arrays(pa.array(offsets), spans)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(joined, type=pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield judge(part)

    return source.mapInArrow(run, schema)
