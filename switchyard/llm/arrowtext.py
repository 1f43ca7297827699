"""Helpers for Arrow-batched text operators: bounded slices, bounded caches, crc folds."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents (and about how many text bytes) that a Python worker holds in work at a time.
SLICE_ROWS, SLICE_BYTES = 512, 8 << 20


def need(df: DataFrame, **columns: str) -> DataFrame:
    """Just the columns an operator reads, under the operator's own names (other columns may clash)."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def slices(batch: pa.RecordBatch, text: str = "text", rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive slices of bounded rows and, but for single long texts, bounded bytes."""
    sizes = batch.column(batch.schema.get_field_index(text))
    lengths = pa.compute.fill_null(pa.compute.binary_length(sizes), 0).to_pylist() if len(batch) else []
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and (i - start >= rows or held + n > SLICE_BYTES):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def fold_crc(column: Column | str) -> Column:
    """crc32 of the decimal text of an id; null ids count as the empty text."""
    known = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(known.cast("string"), F.lit("")).cast("binary"))


def release() -> None:
    """Give back to the machine what this worker's ended tasks no longer hold; the allocators keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


class BoundedMemo(dict):
    """A dict that starts anew when it is full, so that a worker's memory stays bounded."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room_for(self, n: int) -> None:
        if len(self) + n > self.limit:
            self.clear()


class TokenRows:
    """Rows of numbers for distinct tokens, computed once each and memoised up to ``limit`` tokens."""

    def __init__(self, compute, width: int, dtype, limit: int = 600_000):
        self.compute, self.memo, self.limit = compute, {}, limit
        self.table = np.zeros((1024, width), dtype=dtype)

    def _learn(self, tokens: list) -> None:
        n = len(self.memo)
        while n + len(tokens) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for at in range(0, len(tokens), 50_000):
            part = tokens[at : at + 50_000]
            self.table[n : n + len(part)] = self.compute(part)
            self.memo.update(zip(part, range(n, n + len(part)), strict=True))
            n += len(part)

    def rows(self, docs: list[list]) -> list[np.ndarray]:
        """Index into :attr:`table` of each document's tokens; good until the next call."""
        found = [list(map(self.memo.get, tokens)) for tokens in docs]
        gaps = {i: {t for t, r in zip(docs[i], rows, strict=True) if r is None} for i, rows in enumerate(found) if None in rows}
        unseen = set().union(*gaps.values())
        if unseen and len(self.memo) + len(unseen) > self.limit:
            self.memo.clear()
            unseen, gaps = set().union(*docs), dict.fromkeys(range(len(docs)))
        self._learn(list(unseen))
        for i in gaps:
            found[i] = list(map(self.memo.__getitem__, docs[i]))
        return [np.array(r, dtype=np.int64) for r in found]
