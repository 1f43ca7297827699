"""Prediction by partial matching over sentences and bytes, pretrained on a corpus.

Tokens are lower-cased (A-Z) white-space words and one end token a document. A text
is a chain of segments: a segment ends with a token that ends in a full stop, question
or exclamation mark if it is its ``LEAST``-th or a later one, after ``SEGMENT`` tokens, or
with the text. The longest context is the whole segment before; where a text escapes from it, or has none, the segment's tokens
are predicted byte by byte.

Segments: the trie node of a context holds the segments that follow it in training texts,
each text counted once, by the context's first use in it. Among T such texts with D
different followers a seen one has probability (c - 1/2) / T, the escape D / 2T. A
training text's own count is left out of c, T and D, so no text predicts itself, and
training and held-out texts are scored alike. Later uses of a context in a text, and its
first segment, go straight to the bytes. Nothing is excluded below this level.

Bytes: a token's bytes, and its end, are predicted from the up to ``ORDER`` bytes before.
The first of them is a state byte that the words before give: the class of the latest
word that is among the corpus's ``ANCHORS`` most frequent ones, whose classes come from
which of them follow each other (so that words of one language share a class). A seen
symbol has probability (c - 1/2) / T among the symbols not yet excluded, an escape
D / 2T, and after an escape the longer context's symbols are excluded; since the trie is
static those masses are properties of a context and are kept with it. Below order 0 the
bytes not seen at all share the rest equally.

Plan: anchor words are counted exactly, then distinct (state, token) pairs and
(context, segment) pairs in one pass. The trie of bytes never leaves the executors: all
orders of a position share its last two context bytes, so its longest contexts are dealt
by those, a task builds the nodes of its own groups, and just orders 0 and 1 (65,792
nodes at most) go round. Distinct pairs meet their positions' scores, and documents those of
their pairs and segments, in the same way: keys that hold over a fixed share of all rows, of
which there can be but so many, are broadcast (pairs by a 64-bit hash), all others meet in a
shuffle join in which no key is hot. A document's rows then come together once.

Defined cases: a null text counts as empty (just the end token); an empty table gives an
empty result; without training rows all counts are 0 and each byte costs log10(256);
repeated rows are texts of their own; a token may be as long as the text; null ids stay null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.llm.arrowtext import slices
from switchyard.storage import discard, materialize

ORDER, LEAST, SEGMENT = 5, 8, 32
#: Tokens, byte contexts and segments that make up over one in so many of their kind are broadcast.
TOKEN_SHARE, NODE_SHARE, SEGMENT_SHARE = 1 << 21, 1 << 20, 1 << 14
END = b"\n"
#: Anchor words, their longest length in bytes, and their classes.
ANCHORS, ANCHOR_BYTES, CLASSES = 255, 64, 8
#: Words that a task saw so often are kept back at first, if that leaves at most so many words that may be anchors.
SLACK, MOST_LIKELY = 16, 1000
#: Positions that a task turns into a trie at a time, and tokens that it counts before it hands them on.
TRIE_KEYS, HELD = 500_000, 600_000
_STATES = [bytes([k]) for k in (0, *range(1, 9), *range(14, 32))]
_SEGMENT_MARK = b"\xff"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def _split(texts: pa.Array) -> pa.ListArray:
    """Lower-cased (A-Z) texts, split at exactly [\\x20\\x09-\\x0D]; white space at an end leaves an empty string there."""
    return pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))


class Tokens:
    """The tokens of some texts: ``words`` (distinct ones, the end token last), and by token its word and its text."""

    def __init__(self, texts: pa.Array):
        split = _split(texts)
        coded = split.flatten().dictionary_encode()
        self.words: list[bytes] = [*coded.dictionary.cast(pa.binary()).to_pylist(), END]
        ids, sizes = coded.indices.to_numpy(), pc.list_value_length(split).to_numpy()
        some = ids != (self.words.index(b"") if b"" in self.words else -1)
        gone = np.zeros(len(some) + 1, dtype=np.int64)
        np.cumsum(~some, out=gone[1:])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.n_texts = len(texts)
        self.counts = sizes - np.diff(gone[bounds]) + 1
        ends = np.cumsum(self.counts) - 1
        self.starts = ends - self.counts + 1
        self.ids = np.full(int(self.counts.sum()), len(self.words) - 1, dtype=np.int64)
        inner = np.ones(len(self.ids), dtype=bool)
        inner[ends] = False
        self.ids[inner] = ids[some]
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def states(self, classes: dict[bytes, int]) -> np.ndarray:
        """By token, the class of the latest anchor word before it in its text."""
        of_word = np.array([classes.get(w, 0) for w in self.words], dtype=np.int64)[self.ids]
        latest = np.maximum.accumulate(np.where(of_word > 0, np.arange(len(of_word)), -1))
        before = np.concatenate([[-1], latest[:-1]])
        return np.where(before >= self.starts[self.text], of_word[before], 0)

    def pairs(self, classes: dict[bytes, int]) -> tuple[list[bytes], np.ndarray]:
        """Distinct (state, token) pairs as bytes, and by token its pair."""
        n = len(self.words)
        codes = self.states(classes) * n + self.ids
        seen = np.zeros(n * (1 + max(classes.values(), default=0)), dtype=bool)
        seen[codes] = True
        places = np.cumsum(seen) - 1
        return [_STATES[c // n] + self.words[c % n] for c in np.flatnonzero(seen).tolist()], places[codes]

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By segment: first token, text, hash of the segment before (0: none, or used before in this text), hash of both."""
        stops = np.array([w[-1:] in (b".", b"!", b"?") for w in self.words], dtype=bool)[self.ids]
        begins = np.zeros(len(self.ids) + 1, dtype=bool)
        begins[self.starts] = True
        # where a segment may begin, and by token the next such place
        may = np.flatnonzero(np.concatenate([[False], stops]) | begins)
        following = np.append(may, len(stops))[np.searchsorted(may, np.arange(len(stops) + 1))]
        last = np.append(self.starts[1:], len(stops))
        open_, end = self.starts[self.counts > LEAST], last[self.counts > LEAST]
        while len(open_):  # the next segments of all texts that have more
            open_ = np.minimum(following[np.minimum(open_ + LEAST, end)], open_ + SEGMENT)
            more = open_ < end
            open_, end = open_[more], end[more]
            begins[open_] = True
        begins = begins[:-1]
        at = np.flatnonzero(begins)
        if not len(at):
            return at, at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], dtype=np.uint64)[self.ids]
        place = np.arange(len(begins)) - np.repeat(at, np.diff(at, append=len(begins)))
        own = _mix(np.add.reduceat(_mix(hashes + (place + 1).astype(np.uint64) * _A), at)) | np.uint64(1)
        text = self.text[at]
        before = np.concatenate([np.zeros(1, np.uint64), own[:-1]])
        before[np.concatenate([[True], text[1:] != text[:-1]])] = 0
        order = np.lexsort((np.arange(len(at)), before, text))
        again = (before[order][1:] == before[order][:-1]) & (text[order][1:] == text[order][:-1])
        before[order[1:][again]] = 0
        return at, text, before, np.where(before > 0, _mix(before * _A ^ own), np.uint64(0))


def _big_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return slices(batch, rows=8192)


def _likely_anchors(texts: DataFrame, slack: int) -> list[bytes]:
    """All words that may be among the ANCHORS most frequent ones.

    Tasks keep back words that they saw at most ``slack`` times, so a word's count is known up to ``slack`` for
    each time that a task handed on its counts. Where that doesn't tell enough words apart, tasks keep nothing back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            some = [w for w, n in counts.items() if n > slack and len(w) <= ANCHOR_BYTES and w != END]
            made = pa.RecordBatch.from_arrays([pa.array([None, *some], pa.binary()), pa.array([1, *map(counts.get, some)], pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for part in _big_slices(batch):
                tokens = Tokens(part.column(0))
                for w, n in zip(tokens.words, np.bincount(tokens.ids, minlength=len(tokens.words)).tolist(), strict=True):
                    counts[w] = counts.get(w, 0) + n
                if len(counts) > HELD:
                    yield out()
        yield out()

    known = materialize(texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "ppm-words")
    kept_back = slack * int(known.where("word IS NULL").agg(F.sum("n")).first()[0] or 0)
    words = known.where("word IS NOT NULL AND n > 0").orderBy(F.desc("n"), "word").limit(MOST_LIKELY + 1).collect()
    discard(known)
    least = words[ANCHORS - 1]["n"] if len(words) >= ANCHORS else 0
    likely = [bytes(r["word"]) for r in words if r["n"] + kept_back >= least]
    if slack and (kept_back >= least or len(likely) > MOST_LIKELY):
        return _likely_anchors(texts, 0)
    return likely if slack else likely[:ANCHORS]


def fit_classes(texts: DataFrame) -> dict[bytes, int]:
    """Class (from 1) of each anchor word of the training ``texts(text)``."""
    likely = _likely_anchors(texts, SLACK)
    if not likely:
        return {}
    size = len(likely)
    shared = texts.sparkSession.sparkContext.broadcast([w.decode() for w in likely])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total, times = pa.array(shared.value, pa.string()), np.zeros(size * size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for batch in batches:
            for part in _big_slices(batch):
                split = _split(part.column(0))
                found = pc.fill_null(pc.index_in(split.flatten(), value_set=wanted), -1).to_numpy().astype(np.int64)
                text, found = pc.list_parent_indices(split).to_numpy()[found >= 0], found[found >= 0]
                times += np.bincount(found, minlength=size)
                near = text[1:] == text[:-1]
                total += np.bincount((found[:-1] * size + found[1:])[near], minlength=size * size)
        some = np.flatnonzero(total)
        pairs, n = np.concatenate([some, -1 - np.arange(size)]), np.concatenate([total[some], times])
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    got = texts.mapInArrow(follow, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most MOST_LIKELY ** 2 rows
    shared.unpersist()
    pair, n = got["pair"].to_numpy(), got["n"].to_numpy()
    times, matrix = np.zeros(size, dtype=np.int64), np.zeros(size * size)
    times[-1 - pair[pair < 0]] = n[pair < 0]
    matrix[pair[pair >= 0]] = n[pair >= 0]
    chosen = sorted(range(size), key=lambda i: (-times[i], likely[i]))[:ANCHORS]
    matrix = matrix.reshape(size, size)[np.ix_(chosen, chosen)]
    return {likely[i]: int(k) + 1 for i, k in zip(chosen, _clusters(matrix + matrix.T), strict=True)}


def _clusters(matrix: np.ndarray) -> np.ndarray:
    """Class of each row by k-means of the rows' square-rooted shares, begun with far-apart rows."""
    x = np.sqrt(matrix / np.maximum(matrix.sum(axis=1, keepdims=True), 1))
    centres = [x[0]]
    while len(centres) < min(CLASSES, len(x)):
        d = np.min([((x - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(x[int(d.argmax())])
    c = np.array(centres)
    for _ in range(25):
        own = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[own == k].mean(axis=0) if (own == k).any() else c[k] for k in range(len(c))])
    return own


def _count_pairs(docs: DataFrame, classes) -> DataFrame:
    """key, n_train, n_all of ``docs(held_out, text)``: (state, token) pairs, and segments as mark, context, context and segment.

    Tokens are counted by occurrence, segments by text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}  # training occurrences above 32 bits, all below

        def out() -> pa.RecordBatch:
            both = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
            made = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(both >> 32), pa.array(both & 0xFFFFFFFF)], ["key", "n_train", "n_all"])
            counts.clear()
            return made

        for batch in batches:
            for part in _big_slices(batch):
                tokens = Tokens(part.column(1))
                train = ~np.array(part.column(0).to_pylist(), dtype=bool)
                keys, place = tokens.pairs(classes.value)
                learned = np.bincount(place, train[tokens.text], minlength=len(keys)).astype(np.int64)
                for w, n in zip(keys, ((learned << 32) + np.bincount(place, minlength=len(keys))).tolist(), strict=True):
                    counts[w] = counts.get(w, 0) + n
                _, text, before, both = tokens.segments()
                some = before > 0
                raw = np.column_stack([before[some], both[some]]).astype(">u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_SEGMENT_MARK + raw[i : i + 16] for i in range(0, len(raw), 16)], pa.binary()),
                        pa.array(train[text[some]].astype(np.int64)),
                        pa.array(np.ones(int(some.sum()), dtype=np.int64)),
                    ],
                    ["key", "n_train", "n_all"],
                )
                if len(counts) > HELD:
                    yield out()
        yield out()

    partial = docs.mapInArrow(run, "key binary, n_train long, n_all long")
    return partial.groupBy("key").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def position_keys(pairs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(pair, key) of every predicted byte: its order, the up to ORDER bytes before it, and itself, packed in 64 bits."""
    joined = np.frombuffer(b"".join(t + b" " for t in pairs), dtype=np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(t) + 1 for t in pairs), dtype=np.int64, count=len(pairs))
    owner = np.repeat(np.arange(len(pairs)), sizes)
    place = np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key = joined.copy()
    for k in range(1, ORDER + 1):
        key[k:] |= np.where(place[k:] >= k, joined[:-k] if len(joined) > k else 0, np.uint64(0)) << np.uint64(8 * k)
    key |= np.minimum(place, ORDER).astype(np.uint64) << np.uint64(56)
    return owner[place > 0], key[place > 0]


def _nodes_of(key: np.ndarray, order: int) -> np.ndarray:
    """The nodes of that order of positions that reach it."""
    return (key & np.uint64((1 << (8 * (order + 1))) - 1)) | np.uint64(order << 56)


class Trie:
    """Sorted nodes (order, context, symbol) with, by context: total T, distinct symbols D, and what a shorter context excludes."""

    def __init__(self, nodes: np.ndarray, counts: np.ndarray):
        order = np.argsort(nodes)
        self.nodes, self.counts = nodes[order], counts[order].astype(np.float64)
        contexts = self.nodes >> np.uint64(8)
        self.contexts, back = np.unique(contexts, return_inverse=True)
        self.total = np.bincount(back, self.counts, minlength=len(self.contexts))
        self.kinds = np.bincount(back, minlength=len(self.contexts)).astype(np.float64)
        # counts of this context's symbols in the context one byte shorter
        length = self.nodes >> np.uint64(56)
        shorter = np.zeros_like(self.nodes)
        for k in range(1, ORDER + 1):
            shorter[length == k] = _nodes_of(self.nodes[length == k], k - 1)
        parent = np.searchsorted(self.nodes, shorter)
        parent[parent == len(self.nodes)] = 0
        mass = np.where(length > 0, self.counts[parent] if len(parent) else 0.0, 0.0)
        self.excluded = np.bincount(back, mass, minlength=len(self.contexts))

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray]) -> Trie:
        """From positions with their counts, and the nodes of orders 0 and 1."""
        parts = [low]
        learned = counts > 0
        keys, counts = keys[learned], counts[learned]
        for k in range(2, ORDER + 1):
            reach = (keys >> np.uint64(56)) >= k
            found, back = np.unique(_nodes_of(keys[reach], k), return_inverse=True)
            parts.append((found, np.bincount(back, counts[reach], minlength=len(found))))
        return cls(*(np.concatenate([p[i] for p in parts]) for i in range(2)))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each position."""
        logs, left = np.zeros(len(keys)), np.ones(len(keys), dtype=bool)
        gone_mass, gone_kinds = np.zeros(len(keys)), np.zeros(len(keys))  # excluded so far, as seen from the next order
        for k in range(ORDER, -1, -1):
            todo = np.flatnonzero(left & (keys >> np.uint64(56) >= k))
            if not len(todo) or not len(self.nodes):
                continue
            node = _nodes_of(keys[todo], k)
            c = np.searchsorted(self.contexts, node >> np.uint64(8))
            c[c == len(self.contexts)] = 0
            known = self.contexts[c] == node >> np.uint64(8)
            todo, c, node = todo[known], c[known], node[known]
            n = np.searchsorted(self.nodes, node)
            n[n == len(self.nodes)] = 0
            hit = self.nodes[n] == node
            total, kinds = self.total[c] - gone_mass[todo], self.kinds[c] - gone_kinds[todo]
            some = kinds > 0  # else all symbols are excluded and the escape is certain
            safe = np.where(some, total, 1.0)
            logs[todo[hit]] += np.log10((self.counts[n[hit]] - 0.5) / safe[hit])
            miss = ~hit & some
            logs[todo[miss]] += np.log10(0.5 * kinds[miss] / safe[miss])
            left[todo[hit]] = False
            gone_mass[todo], gone_kinds[todo] = self.excluded[c], self.kinds[c]
        rest = np.flatnonzero(left)
        logs[rest] -= np.log10(np.maximum(256 - gone_kinds[rest], 1))
        return logs


def _count_positions(pairs: DataFrame) -> DataFrame:
    """key, n (occurrences in training), m (distinct pairs that hold it) of ``pairs(token, n_train)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def merge(parts: list[tuple]) -> tuple:
            found, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return (found, *(np.bincount(back, np.concatenate([p[i] for p in parts]), minlength=len(found)) for i in (1, 2)))

        def out() -> Iterator[pa.RecordBatch]:
            columns = merge(held)
            for at in range(0, len(columns[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000].astype(np.int64)) for c in columns], ["key", "n", "m"])

        for batch in batches:
            for part in slices(batch, "token", rows=50_000):
                owner, keys = position_keys(part.column(0).to_pylist())
                held.append(merge([(keys, part.column(1).to_numpy()[owner], np.ones(len(keys)))]))
                if sum(len(h[0]) for h in held) > 4 * HELD:
                    held = [merge(held)]
                    if len(held[0][0]) > 2 * HELD:
                        yield from out()
                        held = []
        if held:
            yield from out()

    return pairs.mapInArrow(run, "key long, n long, m long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def _score_positions(keys: DataFrame) -> DataFrame:
    """key, m, lp: log10 probability of every position; groups of like last two context bytes are whole in a task."""
    low = keys.where("n > 0").groupBy((F.col("key") % 65536).alias("pair")).agg(F.sum("n").alias("n")).collect()  # at most 2 ** 16 rows
    one = np.array([r["pair"] for r in low], dtype=np.uint64) | np.uint64(1 << 56)
    n = np.array([r["n"] for r in low], dtype=np.float64)
    zero, back = np.unique(one & np.uint64(255), return_inverse=True)
    shared = keys.sparkSession.sparkContext.broadcast((np.concatenate([zero, one]), np.concatenate([np.bincount(back, n, minlength=len(zero)), n])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def score() -> pa.RecordBatch:
            key, n, m = (np.concatenate([w[i] for w in waiting]) for i in range(3))
            lp = Trie.of(key.astype(np.uint64), n, shared.value).log10(key.astype(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(m), pa.array(lp)], ["key", "m", "lp"])

        last = None
        for batch in batches:
            group, *columns = (c.to_numpy() for c in batch.columns)
            if not len(group):
                continue
            cuts, at = np.flatnonzero(np.diff(group)) + 1, 0
            if waiting and group[0] != last:
                cuts = np.concatenate([[0], cuts])
            for cut in cuts.tolist():
                if size + cut - at >= TRIE_KEYS:
                    waiting.append([c[at:cut] for c in columns])
                    yield score()
                    waiting, size, at = [], 0, cut
            waiting.append([c[at:] for c in columns])
            size, last = size + len(group) - at, group[-1]
        if waiting:
            yield score()

    pair = F.expr("CASE WHEN shiftright(key, 56) >= 2 THEN shiftright(key, 8) & 65535 ELSE -1 END")
    dealt = keys.select(pair.cast("int").alias("pair"), "key", "n", "m").repartition("pair").sortWithinPartitions("pair")
    return dealt.mapInArrow(run, "key long, m long, lp double")


def _score_pairs(pairs: DataFrame) -> DataFrame:
    """token, n_train, n_all, lp of ``pairs(token, n_train, n_all)``."""
    counted = materialize(_count_positions(pairs.select("token", "n_train")), "ppm-positions")
    scored = materialize(_score_positions(counted), "ppm-nodes")
    discard(counted)
    often = F.col("m") * NODE_SHARE > int(scored.agg(F.sum("m")).first()[0] or 0)
    got = scored.where(often).toArrow()  # fewer than NODE_SHARE rows
    order = np.argsort(got["key"].to_numpy())
    shared = pairs.sparkSession.sparkContext.broadcast((got["key"].to_numpy()[order].astype(np.uint64), got["lp"].to_numpy()[order]))

    def scored_by(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, value = shared.value
            for batch in batches:
                for part in slices(batch, "token", rows=50_000):
                    owner, keys = position_keys(part.column(0).to_pylist())
                    at = np.searchsorted(known, keys)
                    at[at == len(known)] = 0
                    hit = known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)
                    lp = np.bincount(owner[hit], value[at[hit]] if len(known) else None, minlength=len(part)).astype(np.float64)
                    open_ = np.bincount(owner[~hit], minlength=len(part)) > 0
                    mine, rest = np.flatnonzero(open_ != whole), np.flatnonzero(~hit if not whole else hit[:0])
                    # a pair's own row has a key that no position can have
                    key = np.concatenate([keys[rest].astype(np.int64), -1 - mine])
                    which = np.concatenate([owner[rest], mine])
                    counts = [np.concatenate([np.zeros(len(rest), np.int64), part.column(i).to_numpy()[mine]]) for i in (1, 2)]
                    lp = np.concatenate([np.zeros(len(rest)), lp[mine]])
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(which)), pa.array(key), *map(pa.array, counts), pa.array(lp)], ["token", "key", "n_train", "n_all", "lp"])

        return pairs.select("token", "n_train", "n_all").mapInArrow(run, "token binary, key long, n_train long, n_all long, lp double")

    light = scored.where(~often).select("key", F.col("lp").alias("key_lp"))
    met = scored_by(False).join(light, "key", "left")
    met = met.groupBy("token").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"), F.sum(F.col("lp") + F.coalesce("key_lp", F.lit(0.0))).alias("lp"))
    return met.unionByName(scored_by(True).drop("key"))


def _segment_table(counted: DataFrame) -> DataFrame:
    """key (mark and hash), c, t, d, uses: followers of all contexts that several texts use."""
    marked = counted.where(F.substring("key", 1, 1) == F.lit(_SEGMENT_MARK))
    segments = marked.select(F.substring("key", 2, 8).alias("context"), F.concat(F.lit(_SEGMENT_MARK), F.substring("key", 10, 8)).alias("key"), F.col("n_train").alias("c"), F.col("n_all").alias("uses"))
    contexts = segments.groupBy("context").agg(F.sum("c").alias("t"), F.count_if(F.col("c") > 0).alias("d"), F.sum("uses").alias("texts"), F.count(F.lit(1)).alias("followers"))
    contexts = materialize(contexts.where("texts > 1"), "ppm-contexts")
    often = F.col("followers") * SEGMENT_SHARE > int(contexts.agg(F.sum("followers")).first()[0] or 0)
    hot = contexts.where(often).select("context", F.struct("t", "d").alias("hot"))  # fewer than SEGMENT_SHARE rows
    rest = contexts.where(~often).select(F.col("context").alias("join_key"), F.struct("t", "d").alias("cold"))
    # rows that the broadcast serves go by their own key to the join of the others
    met = segments.join(F.broadcast(hot), "context", "left").withColumn("join_key", F.when(F.col("hot").isNull(), F.col("context")).otherwise(F.col("key")))
    met = met.join(rest, "join_key", "left").withColumn("met", F.coalesce("hot", "cold")).where("met IS NOT NULL")
    out = materialize(met.select("key", "c", "met.t", "met.d", "uses"), "ppm-segments")
    discard(contexts)
    return out


def _hashes(tokens: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], dtype=np.uint64)


def _hashed(rows: DataFrame) -> tuple[np.ndarray, ...]:
    """Columns of ``rows(key, x, y, z)``, with the key's hash, sorted by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column(0).to_pylist()).astype(np.int64)), *batch.columns[1:]], ["key", "x", "y", "z"])

    got = rows.mapInArrow(run, "key long, x double, y double, z double").toArrow()
    key = got["key"].to_numpy().astype(np.uint64)
    order = np.argsort(key)
    return (key[order], *(got[c].to_numpy()[order] for c in "xyz"))


def _look_up(table: tuple[np.ndarray, ...], keys: list[bytes]) -> np.ndarray:
    """Places of keys in a hashed table, -1 where it lacks them."""
    wanted = _hashes(keys)
    at = np.searchsorted(table[0], wanted)
    at[at == len(table[0])] = -1
    return np.where((at >= 0) & (table[0][at] == wanted), at, -1) if len(table[0]) else np.full(len(keys), -1)


def score(docs: DataFrame, *, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learns from rows not held out."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out.alias("held_out"), F.col(f"`{text}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    train = source.where(~F.col("held_out")).select("text")
    classes = spark.sparkContext.broadcast(fit_classes(train))
    counted = materialize(_count_pairs(source.select("held_out", "text"), classes), "ppm-counts")
    pairs = counted.where(F.substring("key", 1, 1) != F.lit(_SEGMENT_MARK)).withColumnRenamed("key", "token")
    # a word's pairs, one for each state at most, come together for its count
    of_word = Window.partitionBy("word")
    scored = _score_pairs(pairs).withColumn("word", F.substring("token", 2, (1 << 31) - 1))
    first = F.row_number().over(of_word.orderBy("token")) == 1
    scored = scored.select("token", "n_train", "n_all", F.sum("n_train").over(of_word).alias("n_word"), first.alias("first"), "lp")
    scored = materialize(scored, "ppm-scored")
    sums = scored.agg(F.sum("n_train"), F.sum("n_all"), F.count_if(F.col("first") & (F.col("n_word") > 0))).first()
    train_tokens, all_tokens, distinct = (int(x or 0) for x in sums)
    below = train_tokens + 0.1 * (distinct + 1)
    segments = _segment_table(counted)
    discard(counted)
    # what is looked up: x, y, z are a token's count and log10 probability, or a segment's c, t and d
    d = lambda name: F.col(name).cast("double")
    often = F.col("n_all") * TOKEN_SHARE > all_tokens
    usual = F.col("uses") * SEGMENT_SHARE > int(segments.agg(F.sum("uses")).first()[0] or 0)
    of_token = scored.select(F.col("token").alias("key"), d("n_word").alias("x"), F.col("lp").alias("y"), F.lit(0.0).alias("z"), often.alias("often"))
    of_segment = segments.select("key", d("c").alias("x"), d("t").alias("y"), d("d").alias("z"), usual.alias("often"))
    hot_tokens = spark.sparkContext.broadcast(_hashed(of_token.where("often").drop("often")))  # fewer than TOKEN_SHARE rows of 32 bytes
    hot_segments = spark.sparkContext.broadcast(_hashed(of_segment.where("often").drop("often")))  # fewer than SEGMENT_SHARE rows
    cold = of_token.unionByName(of_segment).where("NOT often").select("key", F.struct("x", "y", "z").alias("met"))
    base_of = lambda n: np.log10((n + 0.1) / below)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _big_slices(batch):
                tokens = Tokens(part.column(3))
                keys, pair = tokens.pairs(classes.value)
                found = _look_up(hot_tokens.value, keys)
                count, lp = (np.append(c, 0.0)[found] for c in hot_tokens.value[1:3])
                heavy = found >= 0
                base = np.where(heavy, base_of(count), 0.0)
                at, of_text, before, both = tokens.segments()
                segment = np.repeat(np.arange(len(at)), np.diff(at, append=len(pair)))
                first = np.searchsorted(of_text, np.arange(tokens.n_texts))
                sums = np.bincount(segment, lp[pair], minlength=len(at))
                of_doc = lambda v: np.bincount(tokens.text, v[pair], minlength=tokens.n_texts)
                light, asked = np.flatnonzero(~heavy[pair]), np.flatnonzero(before > 0)
                raw = both[asked].astype(">u8").tobytes()
                marked = [_SEGMENT_MARK + raw[i : i + 8] for i in range(0, len(raw), 8)]
                hot = _look_up(hot_segments.value, marked)
                rows = part.column(0).to_numpy()
                n, m, q = tokens.n_texts, len(light), len(asked)
                # rows that need no look-up have a key that no token or segment can have
                own = [b" %d" % r for r in rows.tolist()]
                text = of_text[asked]
                asked_keys = [own[t] if h >= 0 else k for t, h, k in zip(text.tolist(), hot.tolist(), marked, strict=True)]
                known = [np.append(c, np.nan)[hot] for c in hot_segments.value[1:]]
                place = np.concatenate([segment[light] - first[tokens.text[light]], -2 - (asked - first[text]), np.full(n, -1)])
                blank = lambda a: pa.concat_arrays([pa.nulls(m + q, a.type), a])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([rows[tokens.text[light]], rows[text], rows])),
                        pa.array(place.astype(np.int32)),
                        pa.concat_arrays([pa.array(keys, pa.binary()).take(pa.array(pair[light])), pa.array(asked_keys, pa.binary()), pa.array(own, pa.binary())]),
                        *(pa.array(np.concatenate([np.full(m, np.nan), k, np.full(n, np.nan)])) for k in known),
                        blank(part.column(1)),
                        blank(part.column(2)),
                        blank(pa.array(tokens.counts)),
                        blank(pa.array(of_doc((count > 0).astype(float)).astype(np.int64))),
                        blank(pa.array(of_doc(base))),
                        blank(pa.array([sums[a:b].tobytes() for a, b in zip(first, np.append(first[1:], len(at)), strict=True)], pa.binary())),
                    ],
                    ["row", "place", "key", "x", "y", "z", "doc_id", "held_out", "n_tokens", "known", "base", "sums"],
                )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A document's row, with its sums by segment, and what was found for its tokens and segments."""

        def whole(part: pa.RecordBatch) -> pa.RecordBatch:
            row, place, x, y, z = (c.to_numpy() for c in part.columns[:5])
            docs_at = np.flatnonzero(place == -1)
            own = part.take(pa.array(docs_at))
            doc = np.searchsorted(row[docs_at], row)
            held, n_known, base, sums = (own.column(i) for i in (6, 8, 9, 10))
            by_segment = [np.frombuffer(b) for b in sums.to_pylist()]
            first = np.cumsum([0, *map(len, by_segment)])
            lp = np.concatenate(by_segment)
            token = place >= 0
            np.add.at(lp, first[doc[token]] + place[token], y[token])
            extra = np.bincount(doc[token], base_of(x[token]), minlength=len(own))
            more = np.bincount(doc[token], x[token] > 0, minlength=len(own)).astype(np.int64)
            seen = np.flatnonzero(place < -1)
            at, mine = first[doc[seen]] - 2 - place[seen], 1.0 - np.array(held.to_pylist(), dtype=float)[doc[seen]]
            c, t = x[seen] - mine, y[seen] - mine
            d = z[seen] - mine * (c == 0)
            use = t > 0
            at, c, t, d = at[use], c[use], t[use], d[use]
            lp[at] = np.where(c > 0, np.log10(np.maximum(c - 0.5, 0.5) / t), lp[at] + np.log10(np.maximum(d, 1) / (2 * t)))
            score = np.add.reduceat(lp, first[:-1])
            return pa.RecordBatch.from_arrays(
                [own.column(5), held, own.column(7), pa.array(n_known.to_numpy() + more), pa.array(np.full(len(own), train_tokens)), pa.array(base.to_numpy() + extra), pa.array(score)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            row = batch.column(0).to_numpy()
            if not len(row):
                continue
            cut = int(np.searchsorted(row, row[-1]))
            if cut or (waiting and waiting[-1].column(0)[-1].as_py() != row[0]):
                yield whole(pa.concat_batches([*waiting, batch.slice(0, cut)]))
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield whole(pa.concat_batches(waiting))

    numbered = source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    schema = f"row long, place int, key binary, x double, y double, z double, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, sums binary"
    met = numbered.mapInArrow(run, schema).join(cold, "key", "left")
    found = [F.coalesce(F.col("met")[c], F.when(~F.isnan(c), F.col(c))).alias(c) for c in "xyz"]
    met = met.select("row", "place", *found, "doc_id", "held_out", "n_tokens", "known", "base", "sums")
    met = met.where("place = -1 OR x IS NOT NULL").fillna(0.0, ["x", "y", "z"])
    return met.repartition("row").sortWithinPartitions("row").mapInArrow(finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
