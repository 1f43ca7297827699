"""SentencePiece models run by the tokenizers library.

The model's protobuf is read by a small wire-format parser; normaliser, metaspace
marker, pieces with scores (BPE or unigram) and byte fallback are rebuilt as a
tokenizers pipeline. Words (a run of markers and what follows) are encoded once
each in multithreaded batches and memoised; a text's ids are its words' ids.
That is exact as long as no piece holds a marker after another character, which
is checked when the model is read (else texts are encoded whole).

Defined cases: null and empty texts have no ids; very long texts are cut into
words first, so memory follows the text; unknown characters become byte pieces
(or the unknown piece where the model has no byte fallback); an empty table
gives an empty result; other columns are ignored, repeated rows are kept.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from switchyard.llm.arrowtext import BoundedMemo, need, slices, texts_of
from switchyard.llm.byte_bpe import pieces_of

MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def wire_fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) pairs of a protobuf message: ints, bytes, or 4 and 8 raw bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(raw):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            n, at = varint(at)
            value, at = raw[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = raw[at : at + n], at + n
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says; defaults are those of the format."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = 1  # 1 unigram, 2 BPE
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @classmethod
    def read(cls, path: str) -> PieceModel:
        model = cls()
        with open(path, "rb") as f:
            raw = f.read()
        for number, value in wire_fields(raw):
            if number == 1:
                p = dict(wire_fields(value))
                model.pieces.append((p.get(1, b"").decode(), struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0], p.get(3, _NORMAL)))
            elif number == 2:
                t = dict(wire_fields(value))
                model.kind, model.byte_fallback, model.unk_id = t.get(3, 1), bool(t.get(35, 0)), t.get(40, 0)
            elif number == 3:
                n = dict(wire_fields(value))
                model.charsmap = n.get(2, b"")
                model.add_dummy_prefix, model.remove_extra_whitespaces, model.escape_whitespaces = (bool(n.get(k, 1)) for k in (3, 4, 5))
        return model


class PieceCodec:
    """Encoder and decoder of one model; ``memo_entries`` bounds a worker's memory."""

    def __init__(self, path: str, memo_entries: int = 500_000):
        self.model = PieceModel.read(path)
        self.memo = BoundedMemo(memo_entries)
        self.backend = self._backend()
        self.by_word = not any(MARK in p.lstrip(MARK) for p, _, _ in self.model.pieces)
        self.words = BoundedMemo(memo_entries)
        m = self.model
        #: Newlines are a byte piece, no piece holds one, and normalising is just marking spaces.
        self.plain = self.by_word and m.kind == 2 and m.byte_fallback and m.add_dummy_prefix and m.escape_whitespaces and not m.charsmap and not m.remove_extra_whitespaces and not any("\n" in p or kind == _USER for p, _, kind in m.pieces)
        self.line = np.asarray(self.backend.encode("\n", add_special_tokens=False).ids, dtype="<u4").tobytes()
        self.bytes_of = [self._bytes_of(p, kind) for p, _, kind in self.model.pieces]

    def _backend(self):
        from tokenizers import AddedToken, Tokenizer, models

        m = self.model
        names = [p for p, _, _ in m.pieces]
        if m.kind == 1:
            backend = Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=m.unk_id, byte_fallback=m.byte_fallback))
        elif m.kind == 2:
            ids = {p: i for i, p in enumerate(names)}
            ranked = []
            for i, (p, score, kind) in enumerate(m.pieces):
                if kind in (_NORMAL, _USER):
                    ranked += [(-score, i, ids[p[:k]], ids[p[k:]], p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
            ranked.sort()
            merges = [(x[4], x[5]) for x in ranked]
            backend = Tokenizer(models.BPE(vocab=ids, merges=merges, unk_token=names[m.unk_id], fuse_unk=True, byte_fallback=m.byte_fallback))
        else:
            raise ValueError(f"model type {m.kind} isn't BPE or unigram")
        user = [AddedToken(p, special=False, normalized=False) for p, _, kind in m.pieces if kind == _USER]
        if user:
            backend.add_tokens(user)
        return backend

    def _bytes_of(self, piece: str, kind: int) -> bytes:
        if kind == _BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == _UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == _CONTROL else piece.replace(MARK, " ").encode()

    def normalise(self, text: str) -> str:
        """The text as the model sees it: mapped, spaces as markers, the dummy prefix in front."""
        m = self.model
        if m.charsmap:
            from tokenizers.normalizers import Precompiled

            text = Precompiled(m.charsmap).normalize_str(text)
        if m.remove_extra_whitespaces:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        if m.add_dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if m.escape_whitespaces else text

    def _learn(self, unseen: list[str]) -> None:
        for word, got in zip(unseen, self.backend.encode_batch_fast(unseen, add_special_tokens=False), strict=True):
            self.memo[word] = np.asarray(got.ids, dtype="<u4").tobytes()

    def _encode_any(self, text: str) -> bytes:
        n = self.normalise(text)
        words = _WORD.findall(n) if self.by_word else [n] if n else []
        wanted = set(words)
        self.memo.room_for(len(wanted))
        self._learn([w for w in wanted if w not in self.memo])
        return b"".join(map(self.memo.__getitem__, words))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes.

        Texts without runs of spaces are split at spaces and, where newlines can be
        byte pieces only, at newlines; the words' ids come from the memo.
        """
        out: list[bytes] = [b""] * len(texts)
        found, odd = {}, []
        unseen: set[str] = set()
        get = self.words.get
        for i, t in enumerate(texts):
            if not t:
                continue
            if not self.plain or "  " in t or t[0] in " \n" or t[-1] in " \n" or MARK in t or " \n" in t or "\n " in t or "\n\n" in t:
                odd.append(i)
                continue
            words = pieces_of(t)
            ids = list(map(get, words))
            gaps = [k for k, x in enumerate(ids) if x is None] if None in ids else []
            missing = [words[k] for k in gaps]
            unseen.update(missing)
            found[i] = ids, gaps, missing
        # a text's first word has a newline in front; its ids are that newline's and the word's without a marker
        lead = {w for i in found if (w := MARK + _first(texts[i])) not in self.memo}
        self.memo.room_for(len(lead))
        self._learn(list(lead))
        if unseen:
            forms = [w[1:] if w[0] == "\n" else MARK + w for w in unseen]
            self.words.room_for(len(unseen))
            for w, got in zip(unseen, self.backend.encode_batch_fast(forms, add_special_tokens=False), strict=True):
                self.words[w] = (self.line if w[0] == "\n" else b"") + np.asarray(got.ids, dtype="<u4").tobytes()
        for i, (ids, gaps, missing) in found.items():
            for k, w in zip(gaps, missing, strict=True):
                ids[k] = self.words[w]
            first = MARK + _first(texts[i])
            if first not in self.memo:
                self._learn([first])
            ids[0] = self.memo[first]
            out[i] = b"".join(ids)
        for i in odd:
            out[i] = self._encode_any(texts[i])
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids; broken byte sequences become U+FFFD, the dummy prefix goes."""
        raw = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        if self.model.add_dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _first(text: str) -> str:
    """The first word of a text without runs of white space."""
    return text.split(" ", 1)[0].split("\n", 1)[0]


_OPEN: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """This worker's codec for a model file; it outlives single tasks."""
    if path not in _OPEN:
        _OPEN[path] = PieceCodec(path)
    return _OPEN[path]


def encode(docs: DataFrame, model_path: str, *, doc_id: str = "doc_id", text: str = "text", parity_every: int = 1) -> DataFrame:
    """Ids and the decoded text of every document.

    Columns: doc_id, ids array<int>, decoded string, parity boolean. parity compares a
    row with the sentencepiece library itself; it is done for one row in
    ``parity_every`` (by the text's crc32; 1: every row) and null elsewhere. Null texts count as empty.
    """
    source = need(docs, doc_id=doc_id, text=text)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, c in _encoded(batches, model_path):
            parity = _parity(model_path, texts_of(part), ids, parity_every)
            arrays = [np.frombuffer(i, dtype="<i4") for i in ids]
            offsets = np.cumsum([0, *map(len, arrays)])
            flat = np.concatenate(arrays) if arrays else np.zeros(0, "<i4")
            lists = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(flat, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array([c.decode(i) for i in ids], type=pa.string()), pa.array(parity, type=pa.bool_())], ["doc_id", "ids", "decoded", "parity"])

    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string, parity boolean")


def digest(docs: DataFrame, model_path: str, *, doc_id: str = "doc_id", text: str = "text", parity_every: int = 1) -> DataFrame:
    """As :func:`encode`, with digests: doc_id, n_ids, ids_crc32, decoded_sha256, round_trip, parity."""
    source = need(docs, doc_id=doc_id, text=text)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, c in _encoded(batches, model_path):
            texts = texts_of(part)
            back = [c.decode(i) for i in ids]
            columns = [
                pa.array([len(i) // 4 for i in ids], type=pa.int64()),
                pa.array([zlib.crc32(i) for i in ids], type=pa.int64()),
                pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], type=pa.string()),
                pa.array([b == (t or "") for b, t in zip(back, texts, strict=True)], type=pa.bool_()),
                pa.array(_parity(model_path, texts, ids, parity_every), type=pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "round_trip", "parity"])

    return source.mapInArrow(run, f"doc_id {kind}, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean, parity boolean")


def _encoded(batches: Iterator[pa.RecordBatch], model_path: str) -> Iterator[tuple]:
    c = codec(model_path)
    for batch in batches:
        for part in slices(batch):
            yield part, c.encode(texts_of(part)), c


_CHECKERS: dict[str, object] = {}


def _parity(model_path: str, texts: list, ids: list[bytes], every: int) -> list[bool | None]:
    if model_path not in _CHECKERS:
        import sentencepiece

        _CHECKERS[model_path] = sentencepiece.SentencePieceProcessor(model_file=model_path)
    out: list[bool | None] = []
    for t, i in zip(texts, ids, strict=True):
        if every == 1 or zlib.crc32((t or "").encode()) % every == 0:
            out.append(np.asarray(_CHECKERS[model_path].encode_as_numpy(t or ""), dtype="<u4").tobytes() == i)
        else:
            out.append(None)
    return out
