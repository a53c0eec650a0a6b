from __future__ import annotations

import numpy as np

from sluice.llm import languages as L
from tests.conftest import SF_ORACLE
from tests.llm.cases import awkward, frame, plain, prose


def slow_counts(text: str) -> dict:
    cleaned = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    cleaned = " " + " ".join(cleaned.split()) + " " if cleaned.strip() else " "
    out: dict = {}
    for i in range(len(cleaned) - 2):
        if cleaned[i + 1] != " ":
            out[cleaned[i : i + 3]] = out.get(cleaned[i : i + 3], 0) + 1
    return out


def test_trigrams_cover_the_whole_text(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 7)
    for text in ["the house, the  tree!", "", " ", "a", "ÄÖ ü1x", prose(1, 50)]:
        counts, letters = L.trigram_counts(text)
        want = np.zeros(L.BUCKETS, int)
        for gram, n in slow_counts(text).items():
            L._count(one := np.zeros(L.BUCKETS, np.int64), np.array([ord(c) for c in gram], np.uint32))
            want += one * n
        assert (counts == want).all() and letters == sum(c.isalpha() for c in text.lower())


def model():
    rows = np.zeros((2, L.BUCKETS))
    rows[0] = L.trigram_counts(prose(1, 3000, "the of and house tree"))[0]
    rows[1] = L.trigram_counts(prose(2, 3000, "der die und haus baum"))[0]
    return L.LanguageModel.of(["aa", "bb"], rows)


def test_mixtures_are_found_and_penalised():
    m = model()
    one, two = prose(1, 200, "the of and house tree"), prose(2, 200, "der die und haus baum")
    assert L.language_of(m, one)[::2] == ("aa", ["aa"]) and L.language_of(m, two)[::2] == ("bb", ["bb"])
    language, score, chosen = L.language_of(m, one + " " + two)
    assert sorted(chosen) == ["aa", "bb"] and 0.3 < score < 0.7
    assert L.language_of(m, None) == L.language_of(m, "12 !") == ("und", 0.0, [])


def test_awkward_rows(spark):
    df = frame(spark)
    out = plain(L.predict_languages(df))
    assert out == plain(L.predict_languages(frame(spark, clash=True))) and len(out) == len(awkward())
    by_id = {r[0]: r for r in out}
    assert by_id[4][1] == by_id[5][1] == by_id[6][1] == by_id[12][1] == "und" and by_id[1][1] == "en"
    assert all(0 <= r[2] <= 1 for r in out)
    assert plain(L.predict_languages(frame(spark, []))) == []
    unlabelled = [(k, t, None, s, n) for k, t, _, s, n in awkward()]
    assert {r[1] for r in plain(L.predict_languages(frame(spark, unlabelled)))} == {"und"}


def test_rejected_documents_go(spark):
    df = frame(spark, clash=True)
    told = {r[0] for r in plain(L.predict_languages(df)) if r[1] != "und" and r[2] >= 0.4}
    kept = L.keep_identified(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == told >= {1, 2, 3, 8, 9, 10} and not told & {4, 5, 6, 12}
    assert {r["doc_id"] for r in L.keep_identified(df, least=0.0).collect()} == {1, 2, 3, 7, 8, None, 9, 10, 11, 13, 14}
    assert {r["doc_id"] for r in L.keep_identified(df, allowed=["xx"]).collect()} == {10}
    assert L.keep_identified(frame(spark, [])).count() == 0


def slow_shares(likelihood, counts, rounds=40):
    """Expectation-maximisation in plain Python: proportions of the languages of each trigram's likelihoods."""
    k, n = len(likelihood[0]), sum(counts)
    shares = [1 / k] * k
    for _ in range(rounds):
        new = [1.0] * k
        for row, c in zip(likelihood, counts, strict=True):
            whole = sum(p * s for p, s in zip(row, shares, strict=True))
            for i in range(k):
                new[i] += c * row[i] * shares[i] / whole
        new = [x / (n + k) for x in new]
        moved = max(abs(a - b) for a, b in zip(new, shares, strict=True))
        shares = new
        if moved < 1e-3:
            break
    return shares


def test_mixtures_equal_plain_expectation_maximisation():
    import math

    r = np.random.default_rng(4)
    for k in (2, 3, 5):
        for _ in range(10):
            likelihood, counts = r.dirichlet(np.ones(40), k).T + 1e-9, r.integers(1, 9, 40).astype(float)
            shares, value = L.mixture(likelihood, counts)
            want = slow_shares(likelihood.tolist(), counts.tolist())
            assert np.abs(shares - want).max() < 1e-9
            assert abs(value - sum(c * math.log(sum(p * s for p, s in zip(row, want, strict=True))) for row, c in zip(likelihood.tolist(), counts.tolist(), strict=True))) < 1e-6


def test_the_set_of_languages_is_that_of_all_sets_in_order():
    # greedy by proportion: every further language has to pay its price
    r = np.random.default_rng(5)
    for _ in range(20):
        likelihood = r.dirichlet(np.full(L.BUCKETS, 0.02), 3).T + 1e-7
        model = L.LanguageModel(["a", "b", "c"], likelihood)
        counts = np.zeros(L.BUCKETS)
        parts = r.choice(3, r.integers(1, 4), replace=False)
        for part in parts:
            np.add.at(counts, r.choice(L.BUCKETS, 400, p=likelihood[:, part] / likelihood[:, part].sum()), 1)
        chosen, _ = L.infer(model, counts)
        assert set(chosen) == set(parts.tolist()) and abs(sum(chosen.values()) - 1) < 1e-9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = L.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
