import glob
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("public_tokenizers")

from switchyard.llm import queries, token_files  # noqa: E402

BPE = queries.tokenizer_file("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(0, (1 << w) - 1), max_size=300))))
def test_bits_round_trip(case):
    width, ids = case
    raw = token_files.pack_bits(np.array(ids, dtype=np.uint32), width)
    assert len(raw) == -(-len(ids) // 64) * 8 * width
    assert token_files.unpack_bits(raw, width)[: len(ids)].tolist() == ids
    bits = int.from_bytes(raw, "little")
    assert [(bits >> (i * width)) & ((1 << width) - 1) for i in range(len(ids))] == ids


def test_width_is_the_least():
    assert [token_files.width_for(v) for v in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        token_files.pack_bits(np.array([8]), 3)


def packed(width=17, sizes=(0, 1, 4095, 4096, 9000, 3)):
    rng = np.random.default_rng(2)
    documents = [rng.integers(0, 1 << width, n).astype(np.uint32) for n in sizes]
    packer = token_files.Packer(width, 7)
    sections = [s for i, d in enumerate(documents) for s in packer.add(pa.array([i]), d, np.array([len(d)]))] + list(packer.finish())
    return documents, b"".join(s + b"\n" for s in sections)


def test_any_stretch_can_be_read():
    documents, raw = packed()
    file, ids = token_files.PackedFile(raw), np.concatenate(documents)
    assert (file.n_ids, file.number, file.width) == (len(ids), 7, 17) and len(file.blocks) == -(-len(ids) // 4096)
    rng = np.random.default_rng(3)
    for a, b in np.sort(rng.integers(0, len(ids) + 1, (50, 2)), axis=1).tolist():
        assert np.array_equal(file.ids(a, b - a), ids[a:b])
    assert file.documents().column("start").to_pylist() == [0, 0, 1, 4096, 8192, 17192]
    with pytest.raises(IndexError):
        file.ids(0, len(ids) + 1)


def test_only_touched_blocks_are_read():
    documents, raw = packed()
    hurt = bytearray(raw)
    hurt[token_files.PackedFile(raw).blocks[2, 0]] ^= 1
    file = token_files.PackedFile(bytes(hurt))
    assert np.array_equal(file.ids(0, 8192), np.concatenate(documents)[:8192])
    with pytest.raises(ValueError, match="block 2 at byte"):
        file.ids(8192, 1)


def test_not_a_file():
    for raw in (b"", b"x" * 200):
        with pytest.raises(ValueError):
            token_files.PackedFile(raw)


TEXTS = [None, "", "a b", "<|endoftext|> x", "é 漢字\x00\n\n", "word " * 9000, "same", "same"]


@pytest.fixture()
def docs(spark):
    rows = [(i, t, "c", i) for i, t in enumerate(TEXTS)] + [(None, "no id", "c", 0), (None, None, "c", 1), (3, "again", "c", 1), (-5, "first", "c", 2)] + [(6, "same", "c", 3)] * 40
    return spark.createDataFrame(rows, "doc_id long, text string, start string, row int").repartition(5)


def library(text):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids + [0]
    return len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("file_ids", [1 << 24, 500])
def test_files_hold_what_the_library_gives(spark, docs, tmp_path, file_ids):
    token_files.write(docs, f"file://{tmp_path}/t", BPE, file_ids=file_ids)
    rows = token_files.read(spark, f"file://{tmp_path}/t").collect()
    want = [(r.doc_id, *library(r.text)) for r in docs.collect()]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    files = [token_files.PackedFile.open(f) for f in sorted(glob.glob(f"{tmp_path}/t/part-*"))]
    assert [f.number for f in files] == sorted(f.number for f in files) and {f.width for f in files} == {16}
    assert sum(f.n_ids for f in files) == sum(r.n_tokens for r in rows)
    stream = np.concatenate([f.ids() for f in files])
    assert all(zlib.crc32(stream[r.start : r.start + r.n_tokens].tobytes()) == r.ids_crc32 for r in rows)


def test_equal_rows_spread_over_files(spark, tmp_path):
    same = spark.range(4000).selectExpr("7L as doc_id", "'one text for all' as text")
    token_files.write(same, f"file://{tmp_path}/t", BPE, file_ids=2_000)
    sizes = [token_files.PackedFile.open(f).n_ids for f in glob.glob(f"{tmp_path}/t/part-*")]
    assert len(sizes) >= 6 and max(sizes) < 3 * sum(sizes) / len(sizes)
    assert token_files.read(spark, f"file://{tmp_path}/t").agg({"start": "max"}).first()[0] == 5 * 3999


def test_empty_table_and_long_ids(spark, docs, tmp_path):
    token_files.write(docs.where("false"), f"file://{tmp_path}/none", BPE)
    assert token_files.read(spark, f"file://{tmp_path}/none").count() == 0
    named = docs.selectExpr("concat('n', doc_id) as name", "text as body")
    token_files.write(named, f"file://{tmp_path}/named", BPE, doc_id="name", text="body")
    assert {r.doc_id for r in token_files.read(spark, f"file://{tmp_path}/named", id_type="string").collect()} == {f"n{i}" for i in [*range(8), -5]} | {None}


def test_an_encoder_holds_a_word_once(monkeypatch):
    """A word's letters were held as a chunk and as a word before, and memory of ended tasks stayed with a worker that had no encoder yet."""
    import public_tokenizers

    from switchyard.llm import byte_bpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    made, words = byte_bpe.ChunkEncoder(path), [f"{a}rimo{b}" for a in "bdfgklmnprst" for b in "aeiou"]
    texts = [" ".join(f"{w}, {w} {w}." for w in words), "\n".join(words), "...,, *. (a) b1, x\ny,", "  odd \t text, "]
    for text, got in zip(texts, made.encode(texts), strict=True):
        assert got == made._whole(text).tobytes()
    assert made.encode(texts) == [made._whole(t).tobytes() for t in texts]
    assert len(made.words) + len(made.chunks) < 4 * len(words) + 30
    called = []
    monkeypatch.setattr(byte_bpe, "release", lambda: called.append(1))
    monkeypatch.setattr(byte_bpe, "_OPEN", {})
    byte_bpe.encoder(path)
    byte_bpe.encoder(path)
    assert len(called) == 1


def test_ids_are_not_written_as_rows(spark, docs, tmp_path, monkeypatch):
    """Ids lay on disk three times before: as rows, in the shuffle and in the files."""
    written, materialize = [], token_files.materialize
    monkeypatch.setattr(token_files, "materialize", lambda df, name: written.append(df.columns) or materialize(df, name))
    token_files.write(docs, f"file://{tmp_path}/t", BPE, file_ids=500)
    assert written == [["firsts", "groups"]] and len(glob.glob(f"{tmp_path}/t/part-*")) > 9
