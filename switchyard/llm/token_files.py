"""Token ids in files of fixed-width bits: a writer, a reader with random access, and a corpus of such files on Spark.

A file holds the ids of consecutive documents as one stream, each id in the
least number of bits that the vocabulary needs, and can be read from any place:

    section    content
    blocks     4096 ids each (the last one fewer, filled with zeros to a multiple of 64), bit ``i * width`` of a block
               begins id ``i``; bits count from the least significant one of the first byte
    documents  an Arrow IPC stream: doc_id (any type) and start (place of the first id in the stream)
    offsets    for each block its place in the file and the crc32 of its bytes, two unsigned 64-bit integers
    trailer    magic ``SWYTOK01``, ids, blocks, place of documents, place of offsets, file number, width (six unsigned 64-bit integers)

One newline byte follows every section and every block. All numbers are
little-endian. 64 ids fill ``width`` whole 64-bit words, so both directions are
64 shifts over whole columns of numpy arrays.

Spark writes the files: ranges of ascending document id (ties by the text's hash, then
by place in the scan, so that even a table of equal rows spreads) are found from
those keys alone. Documents are encoded where they are read, and their ids go
straight to the task of their range, so that they lie on disk twice, in the shuffle and in the files; each task packs its range and hands its
sections over as raw lines, which Spark's own writer commits. No task holds more
than a batch of documents and the tables of its own file, no local folder is used
and a lost task is done again.

Defined cases: a null or empty text is just the end id; null ids come first;
rows equal in id are ordered by their text's hash; repeated rows are written each
for itself; a very long text runs over as many blocks as it needs; an empty
table makes no document; other columns are ignored.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from switchyard.llm.arrowtext import need, slices, texts_of
from switchyard.llm.byte_bpe import encoder, forget
from switchyard.storage import discard, materialize

MAGIC, BLOCK, _GROUP = b"SWYTOK01", 4096, 64
_TRAILER = struct.Struct("<8s6Q")
#: Ids that one file takes, about, and bytes of text for an id, by which the number of files is set before there are ids.
FILE_IDS, ID_BYTES = 1 << 24, 4


def width_for(vocabulary: int) -> int:
    """Least bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, filled up with zeros to a multiple of 64 ids."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} does not fit {width} bits")
    whole = {8: "<u1", 16: "<u2", 32: "<u4"}.get(width)  # bits of whole numbers are those numbers
    padded = np.zeros(-(-len(ids) // _GROUP) * _GROUP, dtype=whole or np.uint64)
    padded[: len(ids)] = ids
    if whole:
        return padded.tobytes()
    groups = np.ascontiguousarray(padded.reshape(-1, _GROUP).T)
    words = np.zeros((width, groups.shape[1]), dtype="<u8")
    for i in range(_GROUP):
        word, shift = divmod(i * width, 64)
        words[word] |= groups[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= groups[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).tobytes()


def unpack_bits(raw: bytes | memoryview, width: int) -> np.ndarray:
    """Ids (unsigned 32 bits) of whole groups of 64."""
    if width in (8, 16, 32):
        return np.frombuffer(raw, f"<u{width // 8}").astype("<u4")
    words = np.ascontiguousarray(np.frombuffer(raw, "<u8").reshape(-1, width).T)
    groups, mask = np.empty((_GROUP, words.shape[1]), dtype="<u4"), np.uint64((1 << width) - 1)
    for i in range(_GROUP):
        word, shift = divmod(i * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        groups[i] = value & mask
    return np.ascontiguousarray(groups.T).reshape(-1)


class PackedFile:
    """One file, from its bytes or a memory map; reads only the blocks that hold what is asked for."""

    def __init__(self, raw):
        self.raw = memoryview(raw)
        if len(self.raw) <= _TRAILER.size:
            raise ValueError("not a token file: too short")
        magic, self.n_ids, blocks, documents, offsets, self.number, self.width = _TRAILER.unpack(self.raw[-_TRAILER.size - 1 : -1])
        if magic != MAGIC:
            raise ValueError("not a token file: no trailer")
        self.blocks = np.frombuffer(self.raw[offsets : offsets + 16 * blocks], "<u8").reshape(-1, 2)
        self._documents = self.raw[documents : offsets - 1]

    @classmethod
    def open(cls, path: str) -> PackedFile:
        """A file on a disk of this machine, mapped into memory."""
        import mmap

        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def documents(self) -> pa.Table:
        """doc_id and start of every document, in order."""
        return pa.ipc.open_stream(pa.py_buffer(self._documents)).read_all()

    def ids(self, start: int = 0, count: int | None = None) -> np.ndarray:
        """``count`` ids from ``start`` on (all by default). A damaged block raises ValueError with its place."""
        count = self.n_ids - start if count is None else count
        if start < 0 or count < 0 or start + count > self.n_ids:
            raise IndexError(f"ids {start} to {start + count} of {self.n_ids}")
        if not count:
            return np.zeros(0, dtype="<u4")
        first, last = start // BLOCK, (start + count - 1) // BLOCK
        parts = []
        for b in range(first, last + 1):
            at, crc = map(int, self.blocks[b])
            size = -(-min(BLOCK, self.n_ids - b * BLOCK) // _GROUP) * self.width * 8
            part = self.raw[at : at + size]
            if zlib.crc32(part) != crc:
                raise ValueError(f"block {b} at byte {at} is damaged")
            parts.append(part)
        got = unpack_bits(b"".join(parts), self.width)
        return got[start - first * BLOCK : start - first * BLOCK + count]


class Packer:
    """Makes the sections of one file from documents in order; holds one block of ids and the file's tables."""

    def __init__(self, width: int, number: int = 0):
        self.width, self.number = width, number
        self.n_ids = self.place = 0
        self.open: list[np.ndarray] = []
        self.held = 0
        self.blocks: list[tuple[int, int]] = []
        self.documents: list[pa.RecordBatch] = []

    def _section(self, raw: bytes) -> bytes:
        self.place += len(raw) + 1
        return raw

    def _close(self, ids: np.ndarray) -> Iterator[bytes]:
        raw = pack_bits(ids, self.width)
        step = BLOCK // _GROUP * self.width * 8
        for at in range(0, len(raw), step):
            part = raw[at : at + step]
            self.blocks.append((self.place, zlib.crc32(part)))
            yield self._section(part)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> Iterator[bytes]:
        """Sections that documents of these sizes fill with these ids, one after the other."""
        starts = self.n_ids + np.cumsum(sizes) - sizes
        self.documents.append(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts)], ["doc_id", "start"]))
        self.open.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= BLOCK:
            ids = np.concatenate(self.open)
            whole = len(ids) // BLOCK * BLOCK
            self.open, self.held = [ids[whole:].copy()], len(ids) - whole
            yield from self._close(ids[:whole])

    def finish(self) -> Iterator[bytes]:
        """What is left, and the tables; nothing if there was no document."""
        if not self.documents:
            return
        if self.held:
            yield from self._close(np.concatenate(self.open))
        sink, documents = pa.BufferOutputStream(), self.place
        with pa.ipc.new_stream(sink, self.documents[0].schema) as out:
            for batch in self.documents:
                out.write_batch(batch)
        yield self._section(sink.getvalue().to_pybytes())
        offsets = self.place
        yield self._section(np.array(self.blocks, dtype="<u8").tobytes())
        yield self._section(_TRAILER.pack(MAGIC, self.n_ids, len(self.blocks), documents, offsets, self.number, self.width))


def encode(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, kept: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_ids, ids and the columns ``kept`` of every document, with the end id: little-endian, of two bytes where the vocabulary allows, else four."""
    source = need(docs, doc_id=doc_id, text=text, **{c: c for c in kept})
    kind, end = source.schema["doc_id"].dataType.simpleString(), np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer_path)
        form = _whole_bytes(width_for(made.tokenizer.get_vocab_size()))
        for batch in batches:
            for part in slices(batch):
                raw = made.encode(texts_of(part))
                sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4 + 1
                ids = np.frombuffer(end.join([*raw, b""]), "<u4").astype(form)
                places = np.concatenate([[0], np.cumsum(sizes)]) * ids.itemsize
                held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(raw), [None, pa.py_buffer(places), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), held.cast(pa.binary()), *part.columns[2:]], ["doc_id", "n_ids", "ids", *kept])

    also = "".join(f", {c} {source.schema[c].dataType.simpleString()}" for c in kept)
    return source.mapInArrow(run, f"doc_id {kind}, n_ids long, ids binary{also}")


def _whole_bytes(width: int) -> str:
    return "<u2" if width <= 16 else "<u4"


def vocabulary(tokenizer_path: str) -> int:
    """Ids that a tokenizer file has."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path).get_vocab_size()


def write(docs: DataFrame, path: str, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, file_ids: int = FILE_IDS) -> None:
    """Writes all documents in ascending order of id below ``path``, one file for about ``file_ids`` ids."""
    source, width = need(docs, doc_id=doc_id, text=text), width_for(vocabulary(tokenizer_path))
    form = _whole_bytes(width)
    source = source.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    size = source.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) / ID_BYTES + 1)).first()[0] or 0
    firsts = _firsts(source.select("doc_id", "tie", "row"), order, max(1, math.ceil(size / file_ids)))
    dealt = source if firsts is None else source.crossJoin(F.broadcast(firsts)).withColumn("file", _file()).drop("firsts", "groups")
    dealt = dealt.withColumn("file", F.lit(0)) if firsts is None else dealt
    files = 1 if firsts is None else firsts.select(F.aggregate("firsts", F.lit(1), lambda n, g: n + F.size(g))).first()[0]
    encoded = encode(dealt, tokenizer_path, end_id=end_id, kept=("tie", "row", "file"))
    dealt = encoded.repartitionById(files, F.col("file")).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        forget()
        packer = Packer(width, TaskContext.get().partitionId())

        def out(sections: Iterator[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(sections), type=pa.binary())], ["section"])

        for batch in batches:
            for part in slices(batch, "ids"):
                held = part.column(1).cast(pa.large_binary())
                places = np.frombuffer(held.buffers()[1], "<i8")[held.offset :][: len(held) + 1]
                ids = np.frombuffer(held.buffers()[2], "u1")[places[0] : places[-1]].view(form)
                yield out(packer.add(part.column(0), ids, np.diff(places) // ids.itemsize))
        yield out(packer.finish())

    sections = dealt.select("doc_id", "ids").mapInArrow(run, "section binary")
    # A text line may hold any bytes; the writer adds the newline that the format has after every section.
    sections.select(F.col("section").cast("string").alias("value")).write.option("compression", "none").option("maxRecordsPerFile", 0).option("lineSep", "\n").text(path)
    if firsts is not None:
        discard(firsts)


def _firsts(keys: DataFrame, order: list, files: int) -> DataFrame | None:
    """One row of ``firsts``, the first keys of all files but the first in groups of some thirty, and ``groups``, the first key of
    every group but the first; None for a single file. Keys alone are dealt to find them."""
    if files < 2:
        return None
    key = F.struct("doc_id", "tie", "row").alias("key")
    dealt = keys.repartitionByRange(files, *order).select(key)
    each = dealt.groupBy(F.spark_partition_id().alias("file")).agg(F.min("key").alias("key"))
    sorted_keys = F.array_sort(F.collect_list("key"))
    step = max(2, math.isqrt(files))
    row = each.agg(sorted_keys.alias("all")).select(F.slice("all", 2, files).alias("all")).where(F.size("all") > 0)
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("all") - 1) / step).cast("int")), lambda i: F.slice(F.col("all"), i * step + 1, step))
    row = row.select(cut.alias("firsts")).withColumn("groups", F.transform(F.slice("firsts", 2, files), lambda g: F.get(g, 0)))
    row = materialize(row, "token-ranges")
    if row.take(1):
        return row
    discard(row)
    return None


def _file():
    """The number of a row's file: how many firsts lie at or before its key. Its group is looked up first, then its place there."""
    step, key = F.size(F.get("firsts", F.lit(0))), F.struct("doc_id", "tie", "row")
    group = F.size(F.filter("groups", lambda g: g <= key))
    return (group * step + F.size(F.filter(F.get("firsts", group), lambda f: f <= key))).cast("int")


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def read(spark: SparkSession, path: str, of_document: Callable[[np.ndarray], int] = crc32, name: str = "ids_crc32", id_type: str = "long") -> DataFrame:
    """doc_id, start (over all files), n_tokens and ``name``: a number from the ids of each document in the files below ``path``.

    The rows are written once; the files' totals, one row a file, then give each file its first place.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for raw in batch.column(0):
                file = PackedFile(raw.as_buffer())
                documents = file.documents()
                starts = documents.column("start").to_numpy()
                ends = np.append(starts[1:], file.n_ids)
                step = max(1, len(starts) // max(1, file.n_ids >> 20))
                for at in range(0, len(starts), step):  # about a million ids at a time
                    here, until = starts[at : at + step], ends[at : at + step]
                    ids = file.ids(int(here[0]), int(until[-1] - here[0]))
                    got = [of_document(ids[a:b]) for a, b in zip((here - here[0]).tolist(), (until - here[0]).tolist(), strict=True)]
                    keys = documents.column("doc_id").slice(at, step).combine_chunks()
                    columns = [pa.array(np.full(len(here), file.number, dtype=np.int64)), keys, pa.array(here), pa.array(until - here), pa.array(got, type=pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "begin", "n_tokens", name])

    rows = materialize(files.mapInArrow(run, f"number long, doc_id {id_type}, begin long, n_tokens long, `{name}` long"), "token-rows")
    sizes = rows.groupBy("number").agg(F.sum("n_tokens").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select("number", before.alias("base"))  # one row a file
    return rows.join(F.broadcast(bases), "number").select("doc_id", (F.col("begin") + F.col("base")).alias("start"), "n_tokens", name)
