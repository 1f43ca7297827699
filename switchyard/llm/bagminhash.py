"""Near-duplicates by BagMinHash signatures over bags of word shingles.

Signature: a shingle's weight is its count, discretised into the dyadic ranges
[0,1), [1,2), [2,4), [4,8) ... Each range of a shingle is a Poisson process of
its own, of rate (signature size * length of the range); its points carry a
component and a weight level, drawn from a hash of (shingle, range, point). A
point counts if its level is below the shingle's weight, so a partly covered
range is thinned, and a component of the signature is the point that comes
first. Two bags agree in a component with probability sum(min)/sum(max), their
weighted Jaccard similarity. Points beyond the time by which all components are
filled are never drawn: their ranges drop out after one vectorised comparison.

Search: equal texts are one node, held by the smallest id. Nodes meet in bands of
the signature. In each bucket all nodes are compared with the smallest one, by
exact multiset overlap of their shingles; found links make components. Nodes that
it did not join meet more pivots of one of their buckets. Pairs of a bucket that are
still in different components after that are compared too, unless a byte of each
component of their signatures rules them out (six deviations off). So no bucket gives
all its pairs, and no pair that shares a bucket goes undecided. With ``BANDS`` bands of ``ROWS`` rows a pair of similarity 0.8 shares
none with probability 3e-6.

Defined cases: texts of fewer than five words are one shingle of all words; null
texts and texts without words link with nothing, each its own class, though equal ones
share a class; null ids count as any id and lose to others; rows equal in id and text
are one document of a group; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from switchyard.llm.arrowtext import slices, texts_of
from switchyard.operators.components import components
from switchyard.storage import discard, materialize

WORDS, SIMILARITY = 5, 0.8
ROWS, BANDS = 6, 42
SIZE = ROWS * BANDS
PIVOTS = 16
#: Share of equal sketch bytes below which a pair can't link; rows and bytes of a bucket that are compared as one block.
MAY_LINK, BLOCK, BLOCK_BYTES = 0.65, 512, 16 << 20
#: Points that are drawn at a time where processes are few.
DRAWS = 1 << 14
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1)."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


class WordHasher:
    """64-bit hashes of the words of texts, as sums over all bytes of texts joined up to about ``PIECE`` bytes.

    A byte counts as a random number times a power of an odd number by its place in the word. The powers
    are kept, up to the longest word so far.
    """

    PIECE = 1 << 20

    def __init__(self):
        self.of_byte = _mix(np.arange(1, 257, dtype=np.uint64) * _A)
        self.of_byte[32] = 0  # so the space after a word counts nothing
        self.powers = np.ones(1, dtype=np.uint64)

    def _hashes(self, joined: bytes) -> np.ndarray:
        """One hash for each of the words that single spaces part."""
        data = np.frombuffer(joined, dtype=np.uint8)
        starts = np.concatenate([[0], np.flatnonzero(data == 32) + 1])
        lengths = np.diff(starts, append=len(data) + 1)
        while len(self.powers) < lengths.max():
            self.powers = np.concatenate([self.powers, self.powers * (self.powers[-1:] * _C)])
        places = np.arange(len(data)) - np.repeat(starts, lengths)[: len(data)]
        return _mix(np.add.reduceat(self.of_byte[data] * self.powers[places], starts))

    def words(self, texts: list[str | None]) -> list[np.ndarray]:
        """The hashes of each text's words, in their order and in lower case."""
        counts, held, size = [], [], 0
        hashes = [np.zeros(0, dtype=np.uint64)]
        for text in texts:
            words = (text or "").lower().split()
            counts.append(len(words))
            for at in range(0, len(words), 1 << 15):
                held.append(" ".join(words[at : at + (1 << 15)]))
                size += len(held[-1])
                if size >= self.PIECE:
                    hashes.append(self._hashes(" ".join(held).encode("utf-8", "surrogatepass")))
                    held, size = [], 0
        if held:
            hashes.append(self._hashes(" ".join(held).encode("utf-8", "surrogatepass")))
        return np.split(np.concatenate(hashes), np.cumsum(counts)[:-1]) if counts else []


def new_memo() -> WordHasher:
    return WordHasher()


def shingle_bags(texts: list[str | None], memo: WordHasher) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted distinct shingle hashes, their counts) of each text."""
    out = []
    for words in memo.words(texts):
        n = min(WORDS, len(words))
        shingles = np.zeros(max(0, len(words) - n + 1) if n else 0, dtype=np.uint64)
        for k in range(n):
            shingles = shingles * _A + words[k : len(words) - n + k + 1]
        out.append(np.unique(_mix(shingles + np.uint64(n)), return_counts=True))
    return out


def _ranges(bags: list[tuple]) -> tuple[np.ndarray, ...]:
    """(bag, process seed, weight, low, length) of all dyadic weight ranges that the bags' counts reach."""
    owner = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    shingles = np.concatenate([b[0] for b in bags])
    counts = np.concatenate([b[1] for b in bags])
    parts, low, at = [(owner, shingles, counts, 0, 1.0)], 1, np.flatnonzero(counts > 1)
    while len(at):
        parts.append((owner[at], shingles[at], counts[at], low, float(low)))
        low *= 2
        at = at[counts[at] > low]
    lows = np.concatenate([np.full(len(p[0]), p[3]) for p in parts])
    seeds = _mix(np.concatenate([p[1] for p in parts]) + lows.astype(np.uint64) * _A)
    return np.concatenate([p[0] for p in parts]), seeds, np.concatenate([p[2] for p in parts]), lows, np.concatenate([np.full(len(p[0]), p[4]) for p in parts])


def _draw_points(owner, state, size: int, horizon: np.ndarray, best: np.ndarray, name: np.ndarray, wide: tuple | None = None) -> None:
    """Lower ``best`` (times by bag and component) by the points of processes of length 1, or ``wide`` (weight, low, length) ones.

    Few processes draw several points each at a time, so that short texts take few rounds too.
    """
    at, drawn = np.zeros(len(state)), 0
    while len(state):
        many = max(1, min(64, DRAWS // len(state)))
        points = _mix(state[:, None] + np.arange(drawn + 1, drawn + many + 1, dtype=np.uint64) * _A)
        gaps = np.log(_unit(points)) / -(size * wide[2] if wide else np.array([size]))[:, None]
        times = at[:, None] + np.cumsum(gaps, axis=1)
        drawn += many
        # later points than all components of a bag have are of no use
        limit = np.minimum(horizon, best.reshape(-1, size).max(axis=1))[owner]
        row, column = np.nonzero(times < limit[:, None])
        draw, t = _mix(points[row, column] ^ _B), times[row, column]
        cell = owner[row] * size + ((draw >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
        wins = t < best[cell]
        if wide:
            wins &= wide[1][row] + np.floor(_unit(_mix(draw + _C)) * wide[2][row]) < wide[0][row]
        wins = np.flatnonzero(wins)
        cell, t = cell[wins], t[wins]
        np.minimum.at(best, cell, t)
        first = t == best[cell]
        name[cell[first]] = draw[wins[first]]
        alive = np.flatnonzero(times[:, -1] < limit)
        owner, state, at = owner[alive], state[alive], times[alive, -1]
        if wide:
            wide = tuple(v[alive] for v in wide)


def signatures(bags: list[tuple], size: int = SIZE) -> np.ndarray:
    """[bag, component]: the hash of the point that comes first. Bags must not be empty."""
    out = np.zeros((len(bags), size), dtype=np.uint64)
    todo, extra = np.arange(len(bags)), 4.0
    while len(todo):
        owner, state, weight, low, length = _ranges([bags[i] for i in todo])
        horizon = (np.log(size) + extra) / np.array([float(bags[i][1].sum()) for i in todo])
        best, name = np.full(len(todo) * size, np.inf), np.zeros(len(todo) * size, dtype=np.uint64)
        one = length == 1  # ranges of length 1 are covered whole
        _draw_points(owner[one], state[one], size, horizon, best, name)
        more = ~one
        _draw_points(owner[more], state[more], size, horizon, best, name, (weight[more], low[more], length[more]))
        full = np.isfinite(best.reshape(len(todo), size)).all(axis=1)
        out[todo[full]] = name.reshape(len(todo), size)[full]
        todo, extra = todo[~full], 2 * extra + np.log(size)
    return out


def overlap(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of two bags; 0 if either is empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both) if both else 0.0


def band_keys(names: np.ndarray) -> np.ndarray:
    """[bag, band] hashes, with the band's number in each."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _B, (len(names), BANDS))
    for row in range(ROWS):
        keys = _mix(keys * _A + names[:, row::ROWS])
    return keys.astype(np.int64)


def _node(text: Column) -> Column:
    """128-bit name of a text."""
    return F.unhex(F.md5(text.cast("binary")))


def _band_table(docs: DataFrame) -> DataFrame:
    """node, doc_id, bands, sketch (both null without words), size in bytes of every row of ``docs(doc_id, text)`` with a text.

    The sketch is the signature's lowest bytes.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = new_memo()
        for batch in batches:
            for part in slices(batch):
                bags = shingle_bags(texts_of(part), memo)
                some = [i for i, bag in enumerate(bags) if len(bag[0])]
                bands: list[bytes | None] = [None] * len(bags)
                sketches = list(bands)
                for group in (some[k : k + 128] for k in range(0, len(some), 128)):
                    names = signatures([bags[i] for i in group])
                    for i, keys, low in zip(group, band_keys(names), names.astype(np.uint8), strict=True):
                        bands[i], sketches[i] = keys.tobytes(), low.tobytes()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bands, pa.binary()), pa.array(sketches, pa.binary()), pa.compute.binary_length(part.column(2)).cast(pa.int64())], ["node", "doc_id", "bands", "sketch", "size"])

    return docs.where("text IS NOT NULL").select(_node(F.col("text")).alias("node"), "doc_id", "text").mapInArrow(run, f"node binary, doc_id {kind}, bands binary, sketch binary, size long")


def _bucket_rows(nodes: DataFrame) -> DataFrame:
    """(bucket, node) of every band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64)
            for at in range(0, len(names), 2000):
                part = names[at : at + 2000]
                yield pa.RecordBatch.from_arrays([pa.array(keys[at * BANDS : (at + len(part)) * BANDS]), pa.array(np.repeat(np.array(part, dtype=object), BANDS), pa.binary())], ["bucket", "node"])

    return nodes.where("bands IS NOT NULL").select("node", "bands").mapInArrow(run, "bucket long, node binary")


def _similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similarity of pairs of nodes (a the smaller one), by exact overlap."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "a_text", "b_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, last, bag = new_memo(), None, None
        for batch in batches:
            for part in slices(batch, "b_text"):
                out = []
                for a, text, other in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), shingle_bags(texts_of(part, "b_text"), memo), strict=True):
                    if a != last:
                        last, bag = a, shingle_bags([text], memo)[0]
                    out.append(overlap(bag, other))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    return joined.mapInArrow(run, "a binary, b binary, similarity double")


def _mixed_buckets(led: DataFrame, found: DataFrame, linked: DataFrame) -> DataFrame:
    """bucket, node, component, far (from the leader), leads: rows of buckets that hold several components."""
    far = F.when(F.col("node") == F.col("leader"), 0.0).otherwise(1 - F.col("similarity"))
    known = led.join(found.select(F.col("a").alias("leader"), F.col("b").alias("node"), "similarity"), ["leader", "node"], "left")
    known = known.join(linked, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"), far.alias("far"), (F.col("node") == F.col("leader")).alias("leads"))
    mixed = known.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("bucket")
    return materialize(known.join(mixed, "bucket"), "near-mixed")


def _last_links(known: DataFrame, nodes: DataFrame, texts: DataFrame, may_link: float) -> DataFrame:
    """u, v: links between components within a bucket, a spanning set of them.

    In a bucket, rows outside its largest component (side 0) meet all rows (side 1), in blocks of bounded rows and
    bytes; rows of the largest component never meet each other. A pair is measured only in the first bucket that it
    shares, if its components are still apart there and at least ``may_link`` of the sketches' bytes agree: at
    similarity 0.8 that share is 0.8 with a deviation of 0.025, so no pair that links is lost (six deviations).
    """
    sized = known.where(~F.col("leads")).join(nodes.select("node", "bands", "sketch", "size"), "node")
    of_component = sized.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    largest = F.max(F.struct("n", "component", "bytes"))
    parts = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")
    groups = of_component.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), largest.alias("top"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    groups = groups.select("bucket", F.col("top.component").alias("largest"), parts(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("few"), parts(F.col("n"), F.col("bytes")).alias("many"))
    rows = sized.join(groups, "bucket").join(texts, "node")
    of = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    carried = ["node", "component", (F.col("component") == F.col("largest")).alias("top"), "bands", "sketch", "text"]
    outside = rows.where("component <> largest").select("bucket", of("few").alias("i"), every("many").alias("j"), F.lit(0).alias("side"), *carried)
    rows = outside.unionByName(rows.select("bucket", every("few").alias("i"), of("many").alias("j"), F.lit(1).alias("side"), *carried))
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side", "node")

    def compare(bucket: int, block: list[tuple], memo: WordHasher) -> Iterator[tuple[bytes, bytes]]:
        side, names, components_, top, bands, sketches, texts_ = zip(*block, strict=True)
        n = side.count(0)
        if not n or n == len(block):
            return
        sketch = np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(len(block), SIZE)
        band = np.frombuffer(b"".join(bands), dtype=np.int64).reshape(len(block), BANDS)
        earlier = int(np.flatnonzero(band[0] == bucket)[0])
        order = np.unique(np.array(names, dtype=object), return_inverse=True)[1]
        kinds = np.unique(np.array(components_, dtype=object), return_inverse=True)[1]
        in_top = np.array(top)
        likely = []
        for at in range(0, n, 64):
            mine = slice(at, min(n, at + 64))
            same = (sketch[mine, None] == sketch[None, n:]).mean(axis=2)
            # two rows outside the largest component meet twice
            ok = (same >= may_link) & (kinds[mine, None] != kinds[None, n:]) & (in_top[None, n:] | (order[mine, None] < order[None, n:]))
            x, y = np.nonzero(ok)
            once = ~(band[at + x, :earlier] == band[n + y, :earlier]).any(axis=1)
            likely += zip((-same[x, y][once]).tolist(), (at + x[once]).tolist(), (n + y[once]).tolist(), strict=True)
        if not likely:
            return
        root: dict = {}

        def find(v):
            while root.setdefault(v, v) != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        bags: dict[int, tuple] = {}
        for _, x, y in sorted(likely):
            u, v = find(components_[x]), find(components_[y])
            if u != v:
                for k in (x, y):
                    if k not in bags:
                        bags[k] = shingle_bags([texts_[k]], memo)[0]
                if overlap(bags[x], bags[y]) >= SIMILARITY:
                    root[u] = v
                    yield names[x], names[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, out, memo = None, [], [], new_memo()
        for batch in batches:
            for part in slices(batch):
                for bucket, i, j, *row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if (bucket, i, j) != key:
                        if len(block) > 1:
                            out += compare(key[0], block, memo)
                        key, block = (bucket, i, j), []
                    block.append(tuple(row))
        if len(block) > 1:
            out += compare(key[0], block, memo)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], ["u", "v"])

    return rows.mapInArrow(run, "u binary, v binary")


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", may_link: float = MAY_LINK) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): nodes(node, doc_id, rows) and members(node, class_node) of classes of several nodes."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = _band_table(source).groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("rows"), *(F.first(c).alias(c) for c in ("bands", "sketch", "size")))
    nodes = rows.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rows")).alias("held"), *(F.first(c).alias(c) for c in ("bands", "sketch", "size")))
    nodes = materialize(nodes.select("node", "held.doc_id", "held.rows", "bands", "sketch", "size"), "near-nodes")
    in_buckets = materialize(_bucket_rows(nodes), "near-buckets")
    buckets = in_buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    led = materialize(in_buckets.join(buckets, "bucket"), "near-led")
    discard(in_buckets)
    pairs = led.where(F.col("node") != F.col("leader")).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    wanted = led.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    held = source.where("text IS NOT NULL").withColumn("node", _node(F.col("text")))
    same = (held["node"] == wanted["node"]) & held["doc_id"].eqNullSafe(wanted["doc_id"])
    texts = materialize(held.join(wanted, same, "left_semi").select("node", "text").dropDuplicates(["node"]), "near-texts")
    found = materialize(_similarities(pairs, texts), "near-pairs")
    links = found.where(F.col("similarity") >= SIMILARITY).select(F.col("a").alias("u"), F.col("b").alias("v"))
    linked = materialize(components(links), "near-classes")
    # each node that its bucket's leader has not joined meets the first PIVOTS nodes of one such bucket, so that large
    # groups of near copies come together without their pairs
    known = _mixed_buckets(led, found, linked)
    order = Window.partitionBy("bucket").orderBy("node")
    pivots = known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS)
    pivots = pivots.select("bucket", F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
    lone = known.where(~F.col("leads")).groupBy("node", "component").agg(F.min("bucket").alias("bucket"))
    met = lone.join(pivots, "bucket").where((F.col("node") != F.col("pivot")) & (F.col("component") != F.col("pivot_component")))
    met = met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    met = materialize(_similarities(met.join(found.select("a", "b"), ["a", "b"], "left_anti"), texts), "near-pairs")
    members, links_all = linked, links
    near = met.where(F.col("similarity") >= SIMILARITY).select(F.col("a").alias("u"), F.col("b").alias("v"))
    if near.take(1):
        links_all = links_all.unionByName(near)
        members = materialize(components(links_all), "near-classes")
        discard(known)
        known = _mixed_buckets(led, found, members)
    last = materialize(_last_links(known, nodes, texts, may_link), "near-links")
    if last.take(1):
        members = materialize(components(links_all.unionByName(last)), "near-classes")
    for table in (led, texts, known):
        discard(table)
    return nodes.select("node", "doc_id", "rows"), members.select("node", F.col("component").alias("class_node"))


def _held_by_class(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """node, class id (smallest doc_id), and the node and row count that hold it, for nodes in a class of several."""
    typed = members.join(nodes, "node").select("class_node", "node", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "rows").alias("held"))
    best = typed.groupBy("class_node").agg(F.min("held").alias("best"))
    return members.join(best, "class_node").select("node", F.col("best.doc_id").alias("class_id"), F.col("best.node").alias("best_node"), F.col("best.rows").alias("best_rows"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", may_link: float = MAY_LINK) -> DataFrame:
    """doc_id, class_id (smallest id of the document's class), kept (whether it is that document)."""
    nodes, members = classes(docs, doc_id=doc_id, text=text, may_link=may_link)
    best = _held_by_class(nodes, members)
    by_node = nodes.join(best, "node", "left").select("node", F.coalesce("class_id", "doc_id").alias("class_id"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _node(F.col(f"`{text}`")).alias("node"))
    out = rows.join(by_node, "node", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns: one document of each class; null texts stay."""
    nodes, members = classes(docs, doc_id=doc_id, text=text)
    best = _held_by_class(nodes, members)
    chosen = nodes.join(best, "node", "left").where(F.col("best_node").isNull() | (F.col("best_node") == F.col("node")))
    chosen = materialize(chosen.select("node", F.col("doc_id").alias("id"), "rows"), "near-chosen")
    # a column of that name may be there already, so both are named by their tables
    single, several = chosen.where("rows = 1"), chosen.where("rows > 1")
    same = lambda c: _node(docs[f"`{text}`"]).eqNullSafe(c["node"]) & docs[f"`{doc_id}`"].eqNullSafe(c["id"])
    kept = docs.join(single, same(single), "left_semi").unionByName(docs.where(docs[f"`{text}`"].isNull()))
    if several.take(1):
        kept = kept.unionByName(docs.join(several, same(several), "left_semi").dropDuplicates([doc_id, text]))
    return kept
