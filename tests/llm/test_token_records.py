from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import token_records as R
from tests.llm.cases import awkward, frame, plain

FILE = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "the", "in", "Er", " ", "  ", "\n", "é", "É", "ß", "İ", "Σ", "ΑΣ", "日本", "\u0301", "ª", "1", "٣", "20", ".", ",", "'s", "'", "'ll", "***", "!?", "…", "<|endoftext|>", "<|", "|>", "\x1c", "\x85", "\u2003", "\xa0", "K", "ǅ", "ﬁ", "🙂", "\x00", "ö", "zz"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_chunks_give_what_whole_texts_give(library, monkeypatch):
    monkeypatch.setattr(R, "CACHE", 30)
    with open(FILE, encoding="utf-8") as f:
        encoder = R.ChunkEncoder.of(f.read())
    assert encoder.chunks
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_frames_are_checked():
    for key, ids in ((5, np.array([1, 2], "<u2")), (None, np.array([70_000], "<u4")), (-1, np.zeros(0, "<u2"))):
        record = R.frame(key, ids)
        got, back = R.unframe(record[:12], record[12:])
        assert got == key and back.tolist() == ids.tolist()
        for i in range(len(record)):
            broken = bytearray(record)
            broken[i] ^= 1
            with pytest.raises(ValueError, match="damaged"):
                R.unframe(bytes(broken[:12]), bytes(broken[12:]))


def test_files_hold_the_documents_in_order(spark, library):
    rows = awkward()
    for clash in (False, True):
        index = R.write_records(frame(spark, rows, clash), FILE, end_id=2)
        got = R.read_shards(spark, index).collect()
        want = {}
        for key, text, *_ in rows:
            ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
            want.setdefault(key, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at = 0
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == at
            want[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
            at += r["n_tokens"]
        assert not any(want.values())
        keys = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
        assert keys == sorted(keys, key=lambda k: (k is None, k))


def test_shuffled_reads_by_the_index(spark, library):
    index = R.write_records(frame(spark), FILE, end_id=2)
    some = index.where("doc_id in (1, 8, 12)").orderBy(F.desc("doc_id"))
    got = {r["doc_id"]: r["ids"] for r in R.read_indexed(some).collect()}
    texts = {k: t for k, t, *_ in awkward()}
    assert got == {k: [*library.encode(texts[k], add_special_tokens=False).ids, 2] for k in (1, 8, 12)}


def test_empty_table(spark):
    index = R.write_records(frame(spark, []), FILE, end_id=2)
    assert plain(index) == [] and plain(R.read_shards(spark, index)) == []
