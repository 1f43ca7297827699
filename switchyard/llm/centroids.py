"""Centroid clustering in whole numbers, with distances screened by block norms.

Vectors are scaled and floored to integers once, and kept with a compressed
vector: one signed byte a component (the component over a power of two that the
vector's largest one sets, rounded), and for each segment of components the norm
of what rounding left over. With ``x = y + e``, ``y`` from the bytes, the
Cauchy-Schwarz inequality gives ``x.c <= y.c + sum over segments of |e_s| |c_s|``
and so a lower bound of the squared distance from the compressed vector, the
centroid and its segment norms. A round takes each vector's exact integer
distance to the centroid that looks nearest, and further exact distances only to
centroids whose bound does not exceed the best one found so far; all others are
pruned. Equal distances go to the smaller number. The bounds allow for rounding,
so the result is that of computing every distance.

Each round is one pass over the written table. A task sends one row a centroid
(count, sum of each component, exact distances taken), which Spark adds up; only
centroids, whose number is a parameter, come to the driver. A lost executor's
tasks are done again with the same centroids.

Defined cases: vectors that are null, of another length or hold null or
non-finite components take no part and have no row; repeated rows count each;
null ids take part with the empty text as their decimal; fewer vectors than
centroids make fewer clusters; no vector gives no row; other columns are
ignored. A scaled component of 2**27 or more raises ValueError, since distances
would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchyard.llm.arrowtext import need
from switchyard.llm.topk import usable
from switchyard.storage import materialize

#: Components a segment.
SEGMENT = 8
_LARGEST = 1 << 27
#: Share of the squared norms that rounding of a bound stays below, with room.
_SLACK = 1e-12
#: Vectors compared at a time.
_BLOCK = 4096


def segment_norms(values: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Norm of each segment of the rows of whole numbers or halves."""
    starts = np.arange(0, values.shape[1], segment)
    return np.sqrt(np.add.reduceat(np.square(values, dtype=np.float64), starts, axis=1))


def compress(points: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compressed vectors: bytes of the components, the power of two that they count, and the segments' norms of what is left."""
    most = np.abs(points).max(axis=1, initial=0)
    shift = np.maximum(0, np.ceil(np.log2((most + 1) / 127.5))).astype(np.int8)
    unit = np.ldexp(1.0, shift)[:, None]
    codes = np.rint(points / unit).astype(np.int8)
    return codes, shift, segment_norms(points - codes * unit, segment)


class Sketches:
    """Compressed vectors as a table holds them: the shift, the bytes, the norms; and the vectors' own squared norms."""

    def __init__(self, codes: np.ndarray, shift: np.ndarray, norms: np.ndarray, squares: np.ndarray):
        self.values = np.concatenate([codes * np.ldexp(1.0, shift)[:, None], norms], axis=1)
        self.squares = squares.astype(np.float64)

    @classmethod
    def of(cls, points: np.ndarray, segment: int = SEGMENT) -> Sketches:
        wide = points.astype(np.int64)
        return cls(*compress(points, segment), np.einsum("ij,ij->i", wide, wide))

    def bounds(self, centers: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """Lower bound of each squared distance to each centroid."""
        beside = np.concatenate([centers, segment_norms(centers, segment)], axis=1)
        squares = np.square(centers, dtype=np.float64).sum(axis=1)
        bound = self.squares[:, None] + squares[None, :] - 2 * (self.values @ beside.T)
        return bound - _SLACK * (np.sqrt(self.squares)[:, None] + np.sqrt(squares)[None, :]) ** 2


def nearest(points: np.ndarray, sketches: Sketches, centers: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, int]:
    """Each point's nearest centroid (the smaller number of equals), the squared distance, and how many exact distances it took."""
    rows, bound = np.arange(len(points)), sketches.bounds(centers, segment)

    def exact(at: np.ndarray, which: np.ndarray | int) -> np.ndarray:
        gap = points[at].astype(np.int64) - centers[which]
        return np.einsum("ij,ij->i", gap, gap)

    best = bound.argmin(axis=1)
    distance, taken = exact(rows, best), len(points)
    bound[rows, best] = np.inf
    for c in range(len(centers)):
        at = np.flatnonzero(bound[:, c] <= distance)
        if len(at):
            other = exact(at, c)
            taken += len(at)
            closer = (other < distance[at]) | ((other == distance[at]) & (c < best[at]))
            at, other = at[closer], other[closer]
            best[at], distance[at] = c, other
    return best, distance, taken


@dataclass
class Clustering:
    """Vectors with their clusters, the final centroids, and the share of all distances that each round computed exactly."""

    vectors: DataFrame  #: vec_id, cluster, distance
    centers: np.ndarray
    exact_share: list[float] = field(default_factory=list)

    def digests(self) -> list[str]:
        """Lower-case hex sha256 of each centroid's components in decimal, joined by commas."""
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centers.tolist()]


def _points(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, Sketches]:
    def rows(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(name)).to_pylist()), kind).reshape(batch.num_rows, -1)

    shift, square = (batch.column(batch.schema.get_field_index(name)).to_numpy() for name in ("shift", "square"))
    return rows("point", "<i4").reshape(-1, dims), Sketches(rows("codes", "i1"), shift, rows("norms", "<f8"), square)


def _prepared(vectors: DataFrame, vec_id: str, vector: str, dims: int, scale: int, segment: int) -> DataFrame:
    source = need(vectors, vec_id=vec_id, vector=vector)
    source = source.where(usable("vector") & (F.size("vector") == dims)).withColumn("vector", F.col("vector").cast("array<double>"))
    kind = source.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            scaled = np.floor(float(scale) * values)
            if (np.abs(scaled) >= _LARGEST).any():
                raise ValueError(f"a component times {scale} is {_LARGEST} or more, so distances would not fit a long")
            points = scaled.astype("<i4")
            codes, shift, norms = compress(points, segment)
            wide = points.astype(np.int64)
            raw = [pa.array([row.tobytes() for row in part], type=pa.binary()) for part in (points, codes, norms.astype("<f8"))]
            columns = [batch.column(0), raw[0], pa.array(np.einsum("ij,ij->i", wide, wide)), raw[1], pa.array(shift), raw[2]]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "point", "square", "codes", "shift", "norms"])

    return source.mapInArrow(run, f"vec_id {kind}, point binary, square long, codes binary, shift byte, norms binary")


def first_centers(prepared: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in order; equal ones by the vectors' bytes."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = prepared.select(mark.alias("mark"), "point").orderBy("mark", "point").limit(k).collect()
    return np.frombuffer(b"".join(bytes(r.point) for r in rows), "<i4").reshape(-1, dims).astype(np.int64)


def _round(prepared: DataFrame, centers: np.ndarray, segment: int) -> tuple[np.ndarray, float]:
    """Centroids after one round, and the share of exact distances."""
    k, dims = centers.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, taken = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                points, sketches = _points(batch.slice(at, _BLOCK), dims)
                best, _, exact = nearest(points, sketches, centers, segment)
                order = np.argsort(best, kind="stable")
                here, starts = np.unique(best[order], return_index=True)
                sums[here] += np.add.reduceat(points[order].astype(np.int64), starts, axis=0)
                counts += np.bincount(best, minlength=k)
                taken += exact
        used = np.flatnonzero(counts)
        exacts = np.zeros(len(used), dtype=np.int64)
        exacts[:1] = taken
        columns = [pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(exacts), pa.array(sums[used].tolist(), type=pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "members", "taken", "sums"])

    parts = prepared.drop("vec_id").mapInArrow(run, "cluster int, members long, taken long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("members").alias("members"), F.sum("taken").alias("taken"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)])
    after, taken, members = centers.copy(), 0, 0
    for row in total.collect():  # one row a centroid
        after[row.cluster] = [row[f"s{i}"] // row.members for i in range(dims)]
        taken, members = taken + row.taken, members + row.members
    return after, taken / max(1, members * k)


def cluster(
    vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, segment: int = SEGMENT
) -> Clustering:
    """Assigns vectors to ``k`` centroids after ``rounds`` rounds of moving them to the floor of their vectors' mean."""
    prepared = materialize(_prepared(vectors, vec_id, vector, dims, scale, segment), "cluster-points")
    centers, shares = first_centers(prepared, k, seed, dims), []
    for _ in range(rounds if len(centers) else 0):
        centers, share = _round(prepared, centers, segment)
        shares.append(share)
    kind = prepared.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                best, distance, _ = nearest(*_points(part, dims), centers, segment)
                columns = [part.column(part.schema.get_field_index("vec_id")), pa.array(best.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return Clustering(materialize(prepared.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), "clusters"), centers, shares)


def report(found: Clustering) -> DataFrame:
    """vec_id, cluster, distance, and of its cluster: cluster_inertia and centroid_sha256; inertia over all vectors."""
    spark = found.vectors.sparkSession
    sums = {r.cluster: r.inertia for r in found.vectors.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # one row a centroid
    rows = [(c, sums.get(c, 0), sum(sums.values()), digest) for c, digest in enumerate(found.digests())]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.vectors.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
