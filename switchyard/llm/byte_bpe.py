"""Byte-level BPE ids by the tokenizers library, memoised by chunk of text.

The tokenizer's own pre-splitting never joins text across the border in front
of an optional space and a run of non-space characters, so the ids of such a
chunk do not depend on its surroundings. Each distinct chunk is encoded once by
the library; a text's ids are its chunks' ids, joined. Texts that hold a
special token's string go through the library whole, since such a string cuts
the text before any splitting.
"""

from __future__ import annotations

import gc
import re

import numpy as np

from switchyard.llm.arrowtext import BoundedMemo, release

#: White space as in Unicode's White_Space property, which the tokenizer's splitting uses.
_WS = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_BLANK = re.compile(f"[{_WS}]+$")

_OPEN: dict[str, "ChunkEncoder"] = {}


#: White space that keeps a text off the quick path; ordinary there are single spaces and single newlines.
_ODD = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_MARKS = ".,;:!?*$%&#|()"


def regular(text: str) -> bool:
    """Whether white space is only single spaces and newlines between other characters."""
    return not ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n" or _ODD.search(text))


def pieces_of(text: str) -> list[str]:
    """Words of a regular text; a word that begins a line has a newline in front, the text's first one too."""
    return ("\n" + text).replace("\n", " \n").split(" ")[1:]


class ChunkEncoder:
    """Ids of texts as little-endian uint32 bytes. ``memo_entries`` bounds a worker's memory."""

    def __init__(self, path: str, memo_entries: int = 700_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks = BoundedMemo(memo_entries)
        self.words = BoundedMemo(memo_entries)
        (self.newline,) = self._whole("\n")

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _ids(self, chunks: list[str]) -> dict[str, bytes]:
        """Encode chunks together: a newline between two chunks is always a token of its own."""
        out, joined = {}, []
        for c in chunks:
            if _BLANK.match(c):
                out[c] = self._whole(c).tobytes()
            else:
                joined.append(c)
        for at in range(0, len(joined), 20_000):
            part = joined[at : at + 20_000]
            ids = np.asarray(self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(ids == self.newline)
            raw, start = ids.tobytes(), 0
            for c, end in zip(part, [*(cuts * 4).tolist(), len(raw)], strict=True):
                out[c] = raw[start:end]
                start = end + 4
        return out

    def _learn(self, wanted: set[str]) -> None:
        """Memoise unseen chunks of texts off the quick path."""
        unseen = [c for c in wanted if c not in self.chunks]
        if len(self.chunks) + len(unseen) > self.chunks.limit:
            self.chunks.clear()
            unseen = list(wanted)
        self.chunks.update(self._ids(unseen))

    def _learn_words(self, unseen: set[str]) -> None:
        """Ids of words as :func:`pieces_of` gives them. Letters and the marks after them are chunks of their own.

        A chunk with a space in front is a word too, so it is held as that word alone.
        """
        parts = {}
        for w in unseen:
            body = w[1:] if w[0] == "\n" else " " + w
            core = body.rstrip(_MARKS)
            parts[w] = (core, body[len(core) :]) if len(core) < len(body) and core.removeprefix(" ").isalpha() else (body,)
        ids = {c: self.words.get(c[1:]) if c[0] == " " else self.chunks.get(c) for p in parts.values() for c in p}
        fresh = self._ids([c for c, x in ids.items() if x is None])
        ids.update(fresh)
        line = np.array([self.newline], dtype="<u4").tobytes()
        self.words.room_for(len(parts) + len(fresh))
        self.words.update((c[1:], x) for c, x in fresh.items() if c[0] == " ")
        for w, p in parts.items():
            self.words[w] = (line if w[0] == "\n" else b"") + b"".join(map(ids.__getitem__, p))
        ends = [c for c in fresh if c[0] in _MARKS]
        self.chunks.room_for(len(ends))
        self.chunks.update((c, fresh[c]) for c in ends)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Null counts as empty. Equal to the library's encode(add_special_tokens=False) on each text."""
        collects = gc.isenabled()
        gc.disable()  # nothing here refers back to itself, and walking through the memos costs a tenth of the time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        found, odd = {}, {}
        unseen: set[str] = set()
        get = self.words.get
        for i, t in enumerate(texts):
            if not t:
                continue
            if any(s in t for s in self.specials):
                out[i] = self._whole(t).tobytes()
            elif regular(t):
                words = pieces_of(t)
                ids = list(map(get, words))
                if None in ids:
                    gaps = [k for k, x in enumerate(ids) if x is None]
                    missing = [words[k] for k in gaps]
                    unseen.update(missing)
                    found[i] = ids, gaps, missing
                else:
                    out[i] = b"".join(ids)[4:]
            else:
                odd[i] = _CHUNK.findall(t)
        if unseen:
            self._learn_words(unseen)
            now = self.words.__getitem__
            for i, (ids, gaps, missing) in found.items():
                for k, x in zip(gaps, map(now, missing), strict=True):
                    ids[k] = x
                out[i] = b"".join(ids)[4:]
        for i, chunks in odd.items():
            self._learn(set(chunks))
            out[i] = b"".join(map(self.chunks.__getitem__, chunks))
        return out


def encoder(path: str) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file; it outlives single tasks."""
    if path not in _OPEN:
        release()  # of what the worker's earlier tasks held, whatever they were
        _OPEN[path] = ChunkEncoder(path)
    return _OPEN[path]


def forget() -> None:
    """Give back the memory of this worker's encoders to the machine, before work of another kind."""
    _OPEN.clear()
    release()
