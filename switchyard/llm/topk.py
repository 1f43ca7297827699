"""Exact top-k search by inner product with no-random-access (NRA) aggregation.

The components of a query are cut into ``LISTS`` slices. Each slice gives a list of a
block's candidates, sorted by the slice's inner product with the query; a score is the sum
over the lists. Lists are read from the top, all to the same depth. Of a candidate, values
that have been read are known, and the others lie between the list's last read value and its
end, which gives lower and upper bounds of its score. Reading goes on in doubling depths
until no candidate outside the few that are left, read or unread, can beat the k-th lower
bound (which earlier blocks of the task raise); then the scores of those are resolved.

Candidates and queries are dealt to the blocks of a grid by one shuffle: a candidate goes
to every column of its row, a query to every row of its column. The grid has as many blocks
as the pairs need, and the shape that moves the fewest rows. A task keeps k rows a query of
its block, and a ranked window merges the blocks of a query.

Defined cases: vectors that are null, empty, or hold null or non-finite components take
no part; a vector meets only vectors of its own number of components; with ``row``, a
column that tells rows apart, each query row is answered for itself and only its own row is
left out; without it ids tell rows apart, so repeated query ids are answered once, by their
first vector in order, and candidates with the query's id are left out; null query ids are answered
only with ``row``; equal scores go to the smaller id, null ids last; scores beyond 2**53 are summed in whole
numbers and raise OverflowError beyond 63 bits; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Slices of a vector; candidates and queries that are read together.
LISTS, BLOCK, CHUNK = 4, 4096, 256
#: Pairs of a task, and pairs for which another task is worth while (up to ``LEAST_TASKS``).
PAIRS, FEW_PAIRS, LEAST_TASKS = 1 << 33, 1 << 22, 64


def usable(vector: str):
    """Whether a vector column has components, all of them finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def grid(candidates: int, queries: int) -> tuple[int, int]:
    """Rows (of candidates) and columns (of queries) of the grid."""
    pairs = candidates * queries
    tasks = max(1, min(LEAST_TASKS, pairs // FEW_PAIRS), pairs // PAIRS)
    columns = max(1, round((tasks * queries / max(1, candidates)) ** 0.5))
    return -(-tasks // columns), columns


def nra_block(queries: np.ndarray, x: np.ndarray, own: tuple[np.ndarray, np.ndarray], k: int, known: np.ndarray) -> list[np.ndarray]:
    """By query, the candidates' rows that may be in the best k.

    ``own`` is pairs of queries and candidates that they must not get; ``known[q]`` is the
    k-th best score found elsewhere (ties with it must be kept).
    """
    n = len(x)
    barred = np.zeros((len(queries), n), dtype=bool)
    barred[own] = True
    lists = [queries[:, c] @ x[:, c].T for c in np.array_split(np.arange(x.shape[1]), min(LISTS, x.shape[1]))]
    ends = [part.min(axis=1) for part in lists]
    out: list = [None] * len(queries)
    open_, depth = np.arange(len(queries)), min(n, max(4 * k, n // 16))
    while len(open_):
        lower, upper = np.zeros((len(open_), n)), np.zeros((len(open_), n))
        for part, end in zip(lists, ends, strict=True):
            values = part[open_]
            last = np.partition(values, n - depth, axis=1)[:, n - depth, None]
            read = values >= last
            lower += np.where(read, values, end[open_, None])
            upper += np.where(read, values, last)
        lower[barred[open_]] = upper[barred[open_]] = -np.inf
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_), -np.inf)
        may = (upper >= np.maximum(kth, known[open_])[:, None]) & ~barred[open_]
        settled = (may.sum(axis=1) <= 8 * k) | (depth == n)
        for i in np.flatnonzero(settled):
            out[open_[i]] = np.flatnonzero(may[i])
        open_, depth = open_[~settled], min(n, 4 * depth)
    return out


def _exact(queries: np.ndarray, x: np.ndarray) -> bool:
    """Whether all inner products are whole in double precision."""
    return float(np.abs(queries).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**53


class _Best:
    """The best k of each query of a block of the grid so far."""

    def __init__(self, rows: list, ids: list, vectors: np.ndarray, k: int):
        self.rows, self.ids, self.vectors, self.k = np.array(rows), ids, vectors, k
        self.held: list[list[tuple]] = [[] for _ in ids]  # (-score, id is null, id)

    def meet(self, rows: list, ids: list, x: np.ndarray) -> None:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
        rank = np.empty(len(ids), dtype=np.int64)
        rank[order] = np.arange(len(ids))
        at_row: dict = {}
        for i, r in enumerate(rows):
            at_row.setdefault(r, []).append(i)
        for at in range(0, len(self.rows), CHUNK):
            q = self.vectors[at : at + CHUNK]
            pairs = [(i, c) for i, r in enumerate(self.rows[at : at + CHUNK].tolist()) for c in at_row.get(r, ())]
            own = tuple(np.array(pairs, dtype=np.int64).reshape(-1, 2).T)
            known = np.array([-h[-1][0] if len(h) == self.k else -np.inf for h in self.held[at : at + CHUNK]], dtype=float)
            whole = _exact(q, x)
            likely = nra_block(q, x, own, self.k, known) if whole else [np.setdiff1d(np.arange(len(x)), own[1][own[0] == i]) for i in range(len(q))]
            for i, found in enumerate(likely):
                if whole:
                    scores = (x[found] @ q[i]).astype(np.int64)
                    best = np.lexsort((rank[found], -scores))[: self.k]
                    new = [(-int(scores[b]), ids[found[b]]) for b in best]
                else:
                    sums = [sum(int(a) * int(b) for a, b in zip(q[i], x[f], strict=True)) for f in found]
                    new = sorted(((-s, ids[f]) for s, f in zip(sums, found, strict=True)), key=lambda p: (p[0], p[1] is None, p[1] or 0))[: self.k]
                mixed = self.held[at + i] + [(s, name is None, name) for s, name in new]
                self.held[at + i] = sorted(mixed, key=lambda p: (p[0], p[1], p[2] if p[2] is not None else 0))[: self.k]


def top_k(candidates: DataFrame, queries: DataFrame, *, k: int = 5, vec_id: str = "vec_id", vector: str = "vector", row: str | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k best of ``candidates`` for each of ``queries`` (vectors of whole numbers)."""

    def pick(df: DataFrame) -> DataFrame:
        named = df.select(F.col(f"`{row or vec_id}`").alias("row"), F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
        return named.where(usable("vector"))

    rows, asked = pick(candidates), pick(queries)
    if row is None:
        asked = asked.where("row IS NOT NULL").groupBy("row", "vec_id").agg(F.min("vector").alias("vector"))
    id_type, row_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "row"))
    down, across = grid(rows.count(), asked.count())
    number = F.monotonically_increasing_id()
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = lambda n: F.pmod(number, F.lit(n)).cast("int")
    # a row gets its number before it is copied
    dealt = rows.withColumn("down", spread(down)).select("down", every(across).alias("across"), F.lit(True).alias("candidate"), "row", "vec_id", "vector")
    asked = asked.withColumn("across", spread(across)).select(every(down).alias("down"), "across", F.lit(False).alias("candidate"), "row", "vec_id", "vector")
    dealt = dealt.unionByName(asked)
    dealt = dealt.repartition(down * across, "down", "across").sortWithinPartitions("down", "across", "candidate")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, asking, best, waiting, row_form, id_form = None, {}, {}, {}, None, None

        def meet(size: int) -> None:
            names = waiting.pop(size)
            if size in asking:
                q = asking.pop(size)
                best[size] = _Best(*map(list, zip(*((r, i) for r, i, _ in q), strict=True)), np.array([v for *_, v in q]), k)
            if size in best:
                best[size].meet([r for r, _, _ in names], [i for _, i, _ in names], np.array([v for *_, v in names]))

        def result() -> Iterator[pa.RecordBatch]:
            for size in list(waiting):
                meet(size)
            flat = [(r, q, name, -s) for b in best.values() for r, q, held in zip(b.rows.tolist(), b.ids, b.held, strict=True) for s, _, name in held]
            asking.clear()
            best.clear()
            for at in range(0, len(flat), 10_000):
                columns = zip(*flat[at : at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (row_form, id_form, id_form, pa.int64()), strict=True)], ["query_row", "query_id", "vec_id", "score"])

        for batch in batches:
            row_form, id_form = batch.column(3).type, batch.column(4).type
            for down_, across_, candidate, r, i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (down_, across_) != block:
                    yield from result()
                    block = (down_, across_)
                side = (waiting if candidate else asking).setdefault(len(v), [])
                side.append((r, i, v))
                if candidate and len(side) == BLOCK:
                    meet(len(v))
        yield from result()

    found = dealt.mapInArrow(run, f"query_row {row_type}, query_id {id_type}, vec_id {id_type}, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
