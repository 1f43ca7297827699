"""Line dedup over levelled sorted runs of line hashes.

State: runs of (128-bit line key hash, number of documents), kept in a folder of
shared storage from call to call. A run is cut into buckets by hash, each bucket
sorted by it, so joins with runs are merges that neither shuffle nor sort them. A
new batch of documents is reduced to its own keys, merge-anti-joined with the keys
that earlier runs have already decided (found in ``min_docs`` documents), and what
stays is added as a run of level 0. When a level holds ``fanout`` runs they are
compacted into one run of the next level. All levels together give each key's
documents in all that was added. Pre-aggregation in every task keeps a line that all
documents share to one row a batch of rows.

The most frequent keys, up to ``BROADCAST_KEYS``, go to every worker; rarer ones, of which
none can be hot, meet their lines in a shuffle join.

Defined cases: a null or empty text is one empty line; empty keys are never
dropped (``min_code_points`` at least 1); a document counts once for a line it
repeats; repeated rows count as documents of their own; an empty table gives an
empty result; a text whose lines all go becomes empty.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchyard.llm.arrowtext import fold_crc, need, slices
from switchyard.storage import delete, discard, materialize, shared_dir

BLANK = b" \t\n\x0b\x0c\r"
#: So many keys (16 bytes each) go to every worker; more are joined by shuffle.
BROADCAST_KEYS = 1 << 20


def _key_hash(line: bytes, min_code_points: int) -> bytes | None:
    key = line.strip(BLANK).lower()  # bytes.lower touches A-Z only
    if not key or (len(key) < 4 * min_code_points and len(key.decode("utf-8", "replace")) < min_code_points):
        return None
    return xxhash.xxh3_128_digest(key)


def _raw_texts(part: pa.RecordBatch, index: int) -> list[bytes]:
    return [t or b"" for t in part.column(index).cast(pa.binary()).to_pylist()]


def _line_counts(docs: DataFrame, n_batches: int, min_code_points: int) -> DataFrame:
    """(batch, key, docs): documents of a batch of Arrow rows that hold a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for part in slices(batch):
                for number, text in zip(part.column(0).to_pylist(), _raw_texts(part, 1), strict=True):
                    counts.update((number, h) for h in {_key_hash(x, min_code_points) for x in text.split(b"\n")} if h)
            if counts:
                numbers, keys = zip(*counts, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts.values(), pa.int64())], ["batch", "key", "docs"])

    numbered = docs.select((F.pmod(F.col("number"), F.lit(n_batches))).cast("int").alias("batch"), "text")
    return numbered.mapInArrow(run, "batch int, key binary, docs long").groupBy("batch", "key").agg(F.sum("docs").alias("docs"))


class LineStore:
    """Levelled sorted runs below ``folder``; ``min_docs`` documents decide a key.

    The folder may hold runs of earlier calls or sessions: ``runs`` in it lists them. ``buckets`` (by default the
    session's shuffle partitions) is fixed by the first call; a bucket of a run is one sorted file.
    """

    def __init__(self, spark: SparkSession, folder: str, *, min_docs: int, fanout: int = 4, buckets: int | None = None):
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._tables: set[str] = set()
        # a bucket is one file, so what is sorted within it needs no other sort
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        if self._exists(f"{folder}/runs"):
            for r in sorted(spark.read.parquet(f"{folder}/runs").collect(), key=lambda r: (r["level"], r["place"])):
                self._place(r["level"]).append(r["name"])
                self.buckets = r["buckets"]

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def _place(self, level: int) -> list[str]:
        while level >= len(self.levels):
            self.levels.append([])
        return self.levels[level]

    def run(self, name: str) -> DataFrame:
        """A run as a bucketed, sorted table."""
        if name not in self._tables:
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} (key BINARY, docs BIGINT) USING parquet "
                f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
            )
            self._tables.add(name)
        return self.spark.table(name)

    def _write(self, counts: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        dealt = counts.select("key", "docs").repartition(self.buckets, "key")
        dealt.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.folder}/{name}").saveAsTable(name)
        self._tables.add(name)
        self._place(level).append(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.discard(name)
        delete(self.spark, f"{self.folder}/{name}")

    def _names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _merged(self, names: list[str]) -> DataFrame:
        # read as plain files: a union of bucketed scans claims a partitioning that it may lose when it runs
        files = self.spark.read.schema("key binary, docs long").parquet(*[f"{self.folder}/{name}" for name in names])
        return files.groupBy("key").agg(F.sum("docs").alias("docs"))

    def undecided(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch(key, ...)`` whose key no run has decided, by merge joins with the runs."""
        for name in self._names():
            decided = self.run(name).where(F.col("docs") >= self.min_docs).select("key")
            batch = batch.join(decided.hint("merge"), "key", "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """Add a batch's (key, docs), one row a key, and compact levels that are full."""
        self._write(self.undecided(batch), 0)
        level, old = 0, []
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)
            old += full
            level += 1
        rows = [(level, place, name, self.buckets) for level, names in enumerate(self.levels) for place, name in enumerate(names)]
        self.spark.createDataFrame(rows, "level int, place int, name string, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/runs")
        for name in old:  # only when nothing names them any more
            self._drop(name)

    def decided(self) -> DataFrame:
        """key, docs of keys found in ``min_docs`` documents or more, over all runs."""
        if not self._names():
            return self.spark.createDataFrame([], "key binary, docs long")
        return self._merged(self._names()).where(F.col("docs") >= self.min_docs)

    def clear(self) -> None:
        """Forget and delete all runs."""
        for name in self._names():
            self._drop(name)
        self.levels = []
        delete(self.spark, self.folder)


def frequent_line_keys(docs: DataFrame, *, min_docs: int, doc_id: str = "doc_id", text: str = "text", min_code_points: int = 1, n_batches: int = 4, fanout: int = 4, store: LineStore | None = None) -> DataFrame:
    """Hashes (``key``) of lines found in at least ``min_docs`` documents, and those documents' number so far (``docs``).

    Documents are fed batch by batch through the runs of ``store``, which keeps them for later calls, or of a
    store of its own.
    """
    spark = docs.sparkSession
    kept = store or LineStore(spark, f"{shared_dir(spark)}/line-store-{uuid.uuid4().hex}", min_docs=min_docs, fanout=fanout)
    source = docs.select(fold_crc(F.col(f"`{doc_id}`")).alias("number"), F.col(f"`{text}`").alias("text"))
    counts = materialize(_line_counts(source, n_batches, min_code_points), "line-batches")
    for number in range(n_batches):
        kept.add(counts.where(F.col("batch") == number).select("key", "docs"))
    discard(counts)
    out = materialize(kept.decided(), "line-keys")
    if store is None:
        kept.clear()
    return out


def _keep(text: bytes, drop: Callable[[bytes], bool], min_code_points: int) -> tuple[bytes, int, int]:
    lines = text.split(b"\n")
    kept = [x for x in lines if (h := _key_hash(x, min_code_points)) is None or not drop(h)]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _apply(table: DataFrame, keys: DataFrame, index: int, schema, finish: Callable, min_code_points: int) -> DataFrame:
    """Drop lines with these keys from column ``index``; ``finish(part, kept)`` makes the output batch."""
    # the most frequent keys: BROADCAST_KEYS rows at most
    n_keys = keys.count()
    often = keys.select("key") if n_keys <= BROADCAST_KEYS else keys.orderBy(F.desc("docs"), "key").limit(BROADCAST_KEYS).select("key")
    shared = table.sparkSession.sparkContext.broadcast(frozenset(often.toArrow()["key"].to_pylist()))
    if n_keys <= BROADCAST_KEYS:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop = shared.value.__contains__
            for batch in batches:
                for part in slices(batch, batch.schema.names[index]):
                    yield finish(part, [_keep(t, drop, min_code_points) for t in _raw_texts(part, index)])

        return table.mapInArrow(run, schema)

    # too many keys for every worker: each document gets just the other keys of its own lines
    names = table.columns
    base = materialize(table.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("row", F.monotonically_increasing_id()), "line-docs")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, found = [], []
                for row, text in zip(part.column(0).to_pylist(), _raw_texts(part, 1), strict=True):
                    own = {_key_hash(x, min_code_points) for x in text.split(b"\n")} - {None} - shared.value
                    rows += [row] * len(own)
                    found += own
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(found, pa.binary())], ["row", "key"])

    own = base.select("row", F.col(f"c{index}").alias("text")).mapInArrow(hashes, "row long, key binary")
    drops = own.join(keys, "key", "left_semi").groupBy("row").agg(F.collect_list("key").alias("drops"))

    def run_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.schema.names[index]):
                own = [frozenset(d or ()) for d in part.column(len(names)).to_pylist()]
                kept = [_keep(t, lambda h, d=d: h in d or h in shared.value, min_code_points) for t, d in zip(_raw_texts(part, index), own, strict=True)]
                plain = pa.RecordBatch.from_arrays([part.column(i) for i in range(len(names))], names=names)
                yield finish(plain, kept)

    return base.join(drops, "row", "left").select(*[f"c{i}" for i in range(len(names))], "drops").mapInArrow(run_own, schema)


def line_report(docs: DataFrame, keys: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_code_points: int = 1) -> DataFrame:
    """doc_id, text (kept lines), n_lines, n_dropped for every document."""
    source = need(docs, doc_id=doc_id, text=text)
    kind = source.schema["doc_id"].dataType.simpleString()

    def finish(part: pa.RecordBatch, kept: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([k[0] for k in kept], pa.binary()).cast(pa.string()), pa.array([k[1] for k in kept], pa.int64()), pa.array([k[2] for k in kept], pa.int64())]
        return pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "text", "n_lines", "n_dropped"])

    return _apply(source, keys, 1, f"doc_id {kind}, text string, n_lines long, n_dropped long", finish, min_code_points)


def drop_lines(docs: DataFrame, keys: DataFrame, *, text: str = "text", n_chars: str | None = "n_chars", min_code_points: int = 1) -> DataFrame:
    """``docs`` with all columns, the lines gone from ``text`` and ``n_chars`` counted anew; null texts stay null."""
    index, names = docs.columns.index(text), docs.columns
    counted = names.index(n_chars) if n_chars in names else None

    def finish(part: pa.RecordBatch, kept: list[tuple]) -> pa.RecordBatch:
        columns = part.columns
        was = columns[index]
        now = pa.compute.if_else(was.is_null(), pa.scalar(None, was.type), pa.array([k[0] for k in kept], pa.binary()).cast(was.type))
        columns[index] = now
        if counted is not None:
            changed = pa.array([k[2] > 0 for k in kept])
            size = pa.compute.utf8_length(now).cast(columns[counted].type)
            columns[counted] = pa.compute.if_else(changed, size, columns[counted])
        return pa.RecordBatch.from_arrays(columns, names=names)

    return _apply(docs, keys, index, docs.schema, finish, min_code_points)
