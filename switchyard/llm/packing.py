"""Sum-of-squares online packing of token sequences into fixed windows.

Method: every document is cut into whole windows and a rest. A rest of ``s``
ids goes to the fill level ``h`` for which the sum of squared counts of
partially filled windows, after the placement, is least. The counts live in one
array indexed by fill level; for a level ``h`` the sum changes by
``2*(N[h+s] - N[h] + 1)``, for a new window by ``2*N[s] + 1``, and a window that
becomes full leaves the sum. Equal changes prefer the fuller window.

Each partition packs its own documents in one pass, without a shuffle, and
holds only the open windows' ids. At its end the pieces in open windows are cut
again to fill whole windows, and what is left over is cut into power-of-two
sequences, which need no padding.

Inputs and results that are defined: a null or empty text is just the end id;
a very long text is encoded and cut like any other; repeated rows are packed
each for itself; an empty table gives an empty result; other columns are
ignored. Recomputing a lost partition gives the same pieces, since the result
depends on the rows and their order in the scan's partition only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from switchyard.llm.arrowtext import need, slices, texts_of
from switchyard.llm.byte_bpe import encoder

WINDOW, END_ID = 2048, 1
#: Sequence ids of one partition follow each other from partition << 40.
_SHARD_BITS = 40


class SquarePacker:
    """The level array and the windows that are open at each level."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list] = [[] for _ in range(window + 1)]

    def level_for(self, size: int) -> int:
        """The fill level (0: a new window) that a rest of ``size`` ids goes to."""
        levels = self.count[1 : self.window - size + 1]
        best, change = 0, 2 * int(self.count[size]) + 1 if size < self.window else 0
        used = np.flatnonzero(levels)
        if len(used):
            after = self.count[used + 1 + size] if size else levels[used]
            cost = 2 * (after - levels[used] + 1)
            if used[-1] + 1 + size == self.window:  # a full window leaves the sum
                cost[-1] = 1 - 2 * levels[used[-1]]
            at = len(cost) - 1 - int(np.argmin(cost[::-1]))
            if cost[at] <= change:
                best = int(used[at]) + 1
        return best

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece where it belongs; returns the window's pieces if it is full now."""
        level = self.level_for(size)
        held = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        held.append(piece)
        if level + size == self.window:
            return held
        self.count[level + size] += 1
        self.open[level + size].append(held)
        return None

    def rest(self) -> Iterator[list]:
        """Pieces of the open windows, fullest first."""
        for level in range(self.window, 0, -1):
            yield from self.open[level]


def _power_parts(n: int) -> list[int]:
    """``n`` as a sum of powers of two, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class _Shard:
    """Packs one partition; rows: doc_id, start, length, crc, doc_tokens, sequence, offset."""

    def __init__(self, shard: int, window: int):
        self.packer, self.window = SquarePacker(window), window
        self.next_id = shard << _SHARD_BITS
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def add(self, doc_id, ids: bytes) -> None:
        total, whole = len(ids) // 4, len(ids) // 4 // self.window * self.window
        for start in range(0, whole, self.window):
            self._emit([(doc_id, start, ids[start * 4 : (start + self.window) * 4], total)])
        if total > whole and (full := self.packer.place((doc_id, whole, ids[whole * 4 :], total), total - whole)):
            self._emit(full)

    def finish(self) -> None:
        left = [p for pieces in self.packer.rest() for p in pieces]
        size = sum(len(p[2]) // 4 for p in left)
        targets = [self.window] * (size // self.window) + _power_parts(size % self.window)
        queue, at, took = iter(left), None, 0
        for target in targets:
            pieces, room = [], target
            while room:
                if at is None:
                    at, took = next(queue), 0
                doc_id, start, ids, total = at
                n = min(room, len(ids) // 4 - took)
                pieces.append((doc_id, start + took, ids[took * 4 : (took + n) * 4], total))
                took, room = took + n, room - n
                if took == len(ids) // 4:
                    at = None
            self._emit(pieces)


def pack(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents in windows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    source = need(docs, doc_id=doc_id, text=text)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, encode, form = _Shard(TaskContext.get().partitionId(), window), encoder(tokenizer_path).encode, None

        def out() -> pa.RecordBatch:
            columns = list(zip(*shard.rows, strict=True))
            shard.rows = []
            names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
            return pa.RecordBatch.from_arrays([pa.array(columns[0], type=form), *(pa.array(c, type=pa.int64()) for c in columns[1:])], ["doc_id", *names])

        for batch in batches:
            form = batch.schema.field("doc_id").type
            for part in slices(batch):
                for name, ids in zip(texts_of(part, "doc_id"), encode(texts_of(part)), strict=True):
                    shard.add(name, ids + end)
            if shard.rows:
                yield out()
        shard.finish()
        if shard.rows:
            yield out()

    return source.mapInArrow(run, schema)
