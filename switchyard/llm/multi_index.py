"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut into halves, each with a codebook of its own (k-means on a bounded
sample); the product of the codebooks is a grid of cells. Codebooks grow with the root of
the largest label's rows, so a cell keeps some ``CELL_ROWS`` rows at any size. Every vector
lies in one cell and walks the grid in multi-sequence order: of both halves' centroids,
sorted by how far the vector is from the border of their region, the pair with the least
sum comes next, until the cells left hold no more than a share of 1 - ``recall`` of the
neighbours at the similarity asked for. That reach is calibrated on sampled vectors turned
by exactly that angle in random directions. A pair meets if either visits the other's cell.

A visitor goes once to each first-half centroid that it visits, with the list of its
second-half ones, as an int8 code with the exact length of its error. In a block the codes'
integer products decide all pairs whose cosine is sure on either side of the limit. Rows
with a pair in doubt meet again in the same block with their vectors, in double precision.
Cells are cut into blocks of bounded size, so a cell that holds a third of all rows is many
tasks. A block gives numbers of links and a spanning forest of its links, never all pairs.
Links within one label only.

Defined cases: null, empty, zero, or non-finite vectors (or with null components) and
vectors with a null label link with nothing; vectors meet only their own number
of components; repeated rows are vectors of their own, counted as links of each other, and
share a component with the smallest id; a pair at exactly the limit links; null ids come
back as classes of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchyard.llm.topk import usable
from switchyard.operators.components import components
from switchyard.storage import discard, materialize

#: Rows of a cell of the largest label; sampled rows for each centroid, and at least.
CELL_ROWS, SAMPLE_EACH, SAMPLE = 256, 64, 4096
#: Rows of a block of members and of visitors; visitors that are compared at a time.
MEMBERS, VISITORS, CHUNK = 4096, 8192, 1024
#: Second-half centroids of a block.
BAND = MEMBERS // CELL_ROWS
#: Groups of rows that are cut into several blocks go to every task if they are so few, else they are joined.
BROADCAST_GROUPS = 1 << 18
_KEY = ["label", "size", "first", "band"]


@dataclass
class MultiIndex:
    """Codebooks of the halves of vectors of one size, and how far a vector's visits reach."""

    books: tuple[np.ndarray, np.ndarray]
    reach: float = np.inf

    @classmethod
    def fit(cls, x: np.ndarray, similarity: float, centroids: int, recall: float) -> MultiIndex:
        half = max(1, x.shape[1] // 2)
        index = cls((_k_means(x[:, :half], centroids), _k_means(x[:, half:], centroids)))
        rng = np.random.default_rng(11)
        base = x[rng.integers(0, len(x), 10_000)]
        side = rng.normal(size=base.shape)
        side -= (side * base).sum(axis=1, keepdims=True) * base
        norm = np.linalg.norm(side, axis=1, keepdims=True)
        moved = similarity * base + np.sqrt(1 - similarity**2) * side / np.maximum(norm, 1e-12)
        needed = []
        for at in range(0, len(base), 1000):
            one, two = index.borders(base[at : at + 1000])
            i, j = index.cells(moved[at : at + 1000])
            rows = np.arange(len(one))
            needed.append(one[rows, i] + two[rows, j])
        index.reach = float(np.quantile(np.concatenate(needed), recall)) + 1e-9
        return index

    @classmethod
    def one_cell(cls, size: int) -> MultiIndex:
        half = max(1, size // 2)
        return cls((np.zeros((1, half)), np.zeros((1, size - half))))

    def _distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.books[0].shape[1]
        return tuple(np.maximum(((p**2).sum(axis=1)[:, None] - 2 * p @ c.T + (c**2).sum(axis=1)), 0) for p, c in ((x[:, :half], self.books[0]), (x[:, half:], self.books[1])))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two = self._distances(x)
        return one.argmin(axis=1), two.argmin(axis=1)

    def borders(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By half, squared distance to the border between a centroid's region and the vector's own."""
        out = []
        for d, c in zip(self._distances(x), self.books, strict=True):
            own = d.argmin(axis=1)
            apart = np.sqrt(np.maximum((c**2).sum(axis=1)[own][:, None] - 2 * c[own] @ c.T + (c**2).sum(axis=1), 1e-18))
            out.append(((d - d.min(axis=1, keepdims=True)) / (2 * apart)) ** 2)
        return out[0], out[1]

    def visits(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, first-half centroids, second-half centroids) of each step of the walk, all rows abreast.

        ``ahead[row, a]`` is the next second-half place of the a-th nearest first-half centroid; a step takes the
        least sum of each row, and a row stops when that is beyond the reach.
        """
        one, two = self.borders(x)
        a, b = np.argsort(one, axis=1, kind="stable"), np.argsort(two, axis=1, kind="stable")
        s, t = np.take_along_axis(one, a, 1), np.take_along_axis(two, b, 1)
        t = np.column_stack([t, np.full(len(t), np.inf)])
        rows, ahead, sums = np.arange(len(x)), np.zeros(s.shape, dtype=np.int64), s + t[:, :1]
        while len(rows):
            k = np.arange(len(rows))
            best = sums.argmin(axis=1)
            go = sums[k, best] <= self.reach
            rows, ahead, sums, s, t, best = rows[go], ahead[go], sums[go], s[go], t[go], best[go]
            if not len(rows):
                return
            k = np.arange(len(rows))
            place = ahead[k, best]
            yield rows, a[rows, best], b[rows, place]
            ahead[k, best] = place + 1
            sums[k, best] = s[k, best] + t[k, place + 1]


def _k_means(x: np.ndarray, centroids: int, rounds: int = 12) -> np.ndarray:
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(3)
    centres = x[rng.permutation(len(x))[:centroids]].copy()
    for _ in range(rounds):
        own = np.concatenate([((c**2).sum(axis=1)[:, None] - 2 * c @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1) for c in np.array_split(x, max(1, len(x) // 4096))])
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a bipartite link matrix as (row, column) pairs, breadth first."""
    out: list[tuple[int, int]] = []
    new_rows, new_columns = links.any(axis=1), links.any(axis=0)
    while new_rows.any():
        rows = np.array([new_rows.argmax()])
        new_rows[rows] = False
        while len(rows):
            ahead = links[rows] & new_columns
            columns = np.flatnonzero(ahead.any(axis=0))
            out += zip(rows[ahead[:, columns].argmax(axis=0)].tolist(), columns.tolist(), strict=True)
            new_columns[columns] = False
            back = links[:, columns] & new_rows[:, None]
            rows = np.flatnonzero(back.any(axis=1))
            out += zip(rows.tolist(), columns[back[rows].argmax(axis=1)].tolist() if len(rows) else [], strict=True)
            new_rows[rows] = False
    return out


def near_duplicates(vectors: DataFrame, *, similarity: float = 0.93, recall: float = 0.99, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    ``recall`` is the share of neighbours at exactly ``similarity`` whose cells a walk reaches; nearer ones, and
    pairs that either side may find, are reached more often.
    """
    spark = vectors.sparkSession
    kept = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    source = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast(kept).alias("vector"))
    # the row number must stay what it is, so it is written once
    base = materialize(source, "mi-rows")
    sum_sq = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    clean = base.where(usable("vector") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).where(sum_sq > 0)
    clean = clean.withColumn("vector", F.col("vector").cast("array<double>"))
    total, largest = (int(x or 0) for x in clean.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first())
    label_type = base.schema["label"].dataType.simpleString()
    links = spark.createDataFrame([], "row long, n long")
    members = spark.createDataFrame([], "node long, component long")
    if total:
        centroids = int(np.ceil(np.sqrt(largest / CELL_ROWS)))
        wanted = max(SAMPLE, SAMPLE_EACH * centroids)
        pick = F.xxhash64(F.lit("codebook"), "vec_id", "vector")
        sample = clean.where(F.pmod(pick, F.lit(1_000_000)) < -(-4 * wanted * 1_000_000 // total)).orderBy(pick).limit(wanted).select("vector").collect()
        by_size: dict[int, list] = {}
        for r in sample:
            by_size.setdefault(len(r["vector"]), []).append(r["vector"])
        shared = spark.sparkContext.broadcast({n: MultiIndex.fit(_unit(np.array(v)), similarity, centroids, recall) for n, v in by_size.items()})
        key = f"label {label_type}, size int, first int, band int"
        row = "visitor boolean, row long, cell long, cells binary, code binary"
        asked = materialize(clean.select("row", "label", "vector").mapInArrow(_visiting(shared), f"{key}, {row}"), "mi-visits")
        blocks = _blocks(asked).repartition(*_KEY, "v_part", "m_part").sortWithinPartitions(*_KEY, "v_part", "m_part", "visitor", "row")
        out = f"row long, n long, u long, v long, {key}, v_part int, m_part int, visitor boolean, again long, cell long, cells binary, code binary"
        sure = materialize(blocks.select(*_KEY, "v_part", "m_part", "visitor", "row", "cell", "cells", "code").mapInArrow(_linking(similarity, exact=False), out), "mi-links")
        doubtful = sure.where("again IS NOT NULL").drop("row", "n", "u", "v").withColumnRenamed("again", "row").join(clean.select("row", "vector"), "row")
        doubtful = doubtful.repartition(*_KEY, "v_part", "m_part").sortWithinPartitions(*_KEY, "v_part", "m_part", "visitor", "row")
        doubtful = doubtful.select(*_KEY, "v_part", "m_part", "visitor", "row", "cell", "cells", "code", "vector")
        resolved = materialize(doubtful.mapInArrow(_linking(similarity, exact=True), out), "mi-links")
        found = sure.unionByName(resolved)
        links = materialize(found.where("row IS NOT NULL").groupBy("row").agg(F.sum("n").alias("n")), "mi-counts")
        members = components(found.where("u IS NOT NULL").select("u", "v"))
        for table in (asked, sure, resolved):
            discard(table)
    ids = members.join(base.select(F.col("row").alias("node"), "vec_id"), "node")
    least = ids.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    of_row = ids.join(least, "component").select(F.col("node").alias("row"), "component_id").join(links, "row", "left").select("row", "component_id", "n")
    out = base.select("row", "vec_id").join(of_row, "row", "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _blocks(asked: DataFrame) -> DataFrame:
    """``asked`` with block numbers: every visitor of a group meets every member of it in one block."""
    sizes = asked.groupBy(*_KEY).agg(F.count_if("visitor").alias("visitors"), F.count_if(~F.col("visitor")).alias("own"))
    large = materialize(
        sizes.where(f"visitors > {VISITORS} OR own > {MEMBERS}")
        .select(*_KEY, F.ceil(F.greatest("visitors", F.lit(1)) / VISITORS).cast("int").alias("v_parts"), F.ceil(F.greatest("own", F.lit(1)) / MEMBERS).cast("int").alias("m_parts")),
        "mi-large",
    )
    if not large.take(1):
        return asked.withColumns({"v_part": F.lit(0), "m_part": F.lit(0)})
    asked = asked.join(F.broadcast(large) if large.count() <= BROADCAST_GROUPS else large, _KEY, "left")
    one = lambda n: F.coalesce(F.col(n), F.lit(1))
    spread = lambda n: F.array(F.pmod(F.xxhash64("row"), one(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), one(n) - 1)
    asked = asked.withColumn("v_part", F.explode(F.when(F.col("visitor"), spread("v_parts")).otherwise(every("v_parts"))))
    return asked.withColumn("m_part", F.explode(F.when(F.col("visitor"), every("m_parts")).otherwise(spread("m_parts"))))


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(int8 codes, (scale, length of the error) of each unit vector)."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, np.column_stack([scale, np.linalg.norm(x - codes * scale[:, None], axis=1)])


def _visiting(shared):
    """Each vector in its own cell, and a visitor row in each band of a first-half centroid that it visits.

    ``cells`` holds a member's visited cells, or a visitor's second-half centroids; ``cell`` is the row's own cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                rows, labels, vectors = part.column(0).to_numpy(), part.column(1), part.column(2)
                lengths = pa.compute.list_value_length(vectors).to_numpy()
                for size in np.unique(lengths):
                    of_size = np.flatnonzero(lengths == size)
                    x = _unit(vectors.take(pa.array(of_size)).flatten().to_numpy().reshape(len(of_size), size))
                    index = shared.value.get(int(size)) or MultiIndex.one_cell(int(size))
                    steps = list(index.visits(x))
                    who, first, second = (np.concatenate([s[k] for s in steps]) for k in range(3))
                    i, j = index.cells(x)
                    codes, scales = encode(x)
                    raw = [s.tobytes() + c.tobytes() for s, c in zip(scales, codes, strict=True)]
                    # by row, all visited cells; by (row, first, band), the second-half centroids
                    order = np.lexsort((second, first, who))
                    who, first, second = who[order], first[order], second[order]
                    cells = ((first << 32) | second).astype("<i8")
                    of_row = np.searchsorted(who, np.arange(len(x) + 1))
                    new = np.ones(len(who), dtype=bool)
                    new[1:] = (np.diff(who) != 0) | (np.diff(first) != 0) | (np.diff(second // BAND) != 0)
                    starts = np.flatnonzero(new)
                    lists = np.split(second.astype("<i4"), starts[1:])
                    n = len(x)
                    rowed = np.concatenate([np.arange(n), who[starts]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            labels.take(pa.array(of_size[rowed])),
                            pa.array(np.full(len(rowed), size), pa.int32()),
                            pa.array(np.concatenate([i, first[starts]]).astype(np.int32)),
                            pa.array((np.concatenate([j, second[starts]]) // BAND).astype(np.int32)),
                            pa.array(np.arange(len(rowed)) >= n),
                            pa.array(rows[of_size[rowed]]),
                            pa.array(((i << 32) | j)[rowed]),
                            pa.array([*(cells[of_row[k] : of_row[k + 1]].tobytes() for k in range(n)), *(s.tobytes() for s in lists)], pa.binary()),
                            pa.array([raw[k] for k in rowed], pa.binary()),
                        ],
                        [*_KEY, "visitor", "row", "cell", "cells", "code"],
                    )

    return run


def _linking(similarity: float, exact: bool):
    """Numbers of links and forest edges of each block, and the rows in doubt; input is sorted by block, members first.

    With ``exact``, rows bring their vectors, and only pairs in doubt are decided.
    """

    class Side:
        def __init__(self, rows: list[tuple]):
            self.table = rows
            self.row = np.array([r[0] for r in rows])
            self.cell = np.array([r[1] for r in rows])
            raw = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8).reshape(len(rows), -1)
            self.scale, self.error = raw[:, :16].copy().view(np.float64).T
            size = raw.shape[1] - 16
            # integer products of int8 codes are exact in single precision up to 1,040 components
            self.codes = raw[:, 16:].view(np.int8).astype(np.float32 if size <= 1040 else np.float64)
            self.x = _unit(np.array([r[4] for r in rows])) if exact else None
            self.doubt = np.zeros(len(rows), dtype=bool)

    def block(visitors: Side, members: Side) -> Iterator[tuple]:
        wanted = [np.frombuffer(r[2], "<i4") for r in visitors.table]
        who, second = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted]), np.concatenate(wanted)
        own_second = members.cell & 0xFFFFFFFF
        paths = [np.frombuffer(r[2], "<i8") for r in members.table]
        counts = [np.zeros(len(visitors.row), dtype=np.int64), np.zeros(len(members.row), dtype=np.int64)]
        for j in np.unique(own_second):
            b = np.flatnonzero(own_second == j)
            guests = who[second == j]
            for a in (guests[at : at + CHUNK] for at in range(0, len(guests), CHUNK)):
                dots = (visitors.codes[a] @ members.codes[b].T).astype(np.float64) * visitors.scale[a][:, None] * members.scale[b][None]
                slack = visitors.error[a][:, None] + (1 + visitors.error[a])[:, None] * members.error[b][None] + 1e-12
                links = dots - slack >= similarity
                doubt = ~links & (dots + slack >= similarity)
                other = visitors.row[a][:, None] != members.row[b][None]
                doubt &= other
                if exact:
                    links = doubt & (visitors.x[a] @ members.x[b].T >= similarity)
                else:
                    links &= other
                    visitors.doubt[a[doubt.any(axis=1)]] = True
                    members.doubt[b[doubt.any(axis=0)]] = True
                if not links.any():
                    continue
                counts[0][a] += links.sum(axis=1)
                # a member counts a visitor only if it doesn't visit that visitor's cell itself
                for k in np.flatnonzero(links.any(axis=0)):
                    own = visitors.cell[a[links[:, k]]]
                    counts[1][b[k]] += int((~np.isin(own, paths[b[k]])).sum())
                yield from ((None, None, int(visitors.row[a[r]]), int(members.row[b[c]])) for r, c in _forest(links))
        for side, n in zip((visitors, members), counts, strict=True):
            yield from ((int(side.row[k]), int(n[k]), None, None) for k in np.flatnonzero(n))

    def settle(key: list, members: list, visitors: list) -> Iterator[tuple]:
        if not members or not visitors:
            return
        a, b = Side(visitors), Side(members)
        yield from ((*found, *[None] * 11) for found in block(a, b))
        for side, visitor in ((a, True), (b, False)):
            yield from ((None, None, None, None, *key, visitor, *side.table[k][:4]) for k in np.flatnonzero(side.doubt))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, out, label_type = None, ([], []), [], None

        def flush() -> pa.RecordBatch:
            types = [*[pa.int64()] * 4, label_type, *[pa.int32()] * 5, pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["row", "n", "u", "v", *_KEY, "v_part", "m_part", "visitor", "again", "cell", "cells", "code"])

        for batch in batches:
            label_type = batch.column(0).type
            for *now, visitor, row, cell, cells, code in _rows(batch, exact):
                if now != key:
                    if key is not None:
                        out += settle(key, *sides)
                    key, sides = now, ([], [])
                    if len(out) > 10_000:
                        yield flush()
                sides[visitor].append((row, cell, cells, *code))
        if key is not None:
            out += settle(key, *sides)
        if out:
            yield flush()

    return run


def _rows(batch: pa.RecordBatch, exact: bool) -> Iterator[tuple]:
    """Rows with (code,) or (code, vector) last."""
    columns = [c.to_pylist() for c in batch.columns]
    last = [columns[-2], columns[-1]] if exact else [columns[-1]]
    return zip(*columns[: -len(last)], zip(*last, strict=True), strict=True)
