from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from sluice.llm import pieces as P
from tests.llm.cases import awkward, frame, plain

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", "in", "er", " ", "  ", "\n", "é", "ß", "日", "𝒳", "\x00", "\t", "1", "20", ".", "▁", "###", "n", "s", "t", "\u0301", " " * 17, " " * 40, "</s>", "<0x0A>", "aaaa", "z" * 60]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return P.Coder(P.Vocabulary.load(MODEL))


def test_encoding_and_decoding_match_the_library(library, coder):
    r = random.Random(5)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(4000)] + [t for _, t, *_ in awkward() if t is not None]
    for text, (raw, decoded) in zip(texts, coder.code_all(texts), strict=True):
        ids = library.encode(text)
        assert coder.encode(text) == ids, text
        assert np.frombuffer(raw, "<u4").tolist() == [1, *ids, 2], text
        assert decoded == library.decode([1, *ids, 2]) == coder.decode([1, *ids, 2])


def test_decoding_of_any_ids_matches_the_library(library, coder):
    r = random.Random(6)
    for _ in range(2000):
        ids = [r.choice([0, 1, 2, 3 + r.randint(0, 255), 259, 260, r.randint(259, 31999)]) for _ in range(r.randint(0, 8))]
        assert coder.decode(ids) == library.decode(ids)


def test_a_small_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(P, "CACHE", 5)
    small = P.Coder(P.Vocabulary.load(MODEL))
    texts = [f"word{i % 7} other{i} the house\nagain" for i in range(60)]
    assert [np.frombuffer(raw, "<u4").tolist() for raw, _ in small.code_all(texts)] == [[1, *library.encode(t), 2] for t in texts]


def test_documents(spark, library):
    def row(key, text):
        ids = [1, *library.encode(text or ""), 2]
        return key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    want = sorted((row(k, t) for k, t, *_ in awkward()), key=repr)
    assert plain(P.encode_digests(frame(spark), MODEL)) == want == plain(P.encode_digests(frame(spark, clash=True), MODEL))
    assert P.encode_digests(frame(spark, []), MODEL).count() == 0
    first = P.encode_documents(frame(spark, [(1, "the house", "en", "a", 9)]), MODEL).first()
    assert first["ids"] == [1, *library.encode("the house"), 2] and first["decoded"] == "the house"
