from __future__ import annotations

import hashlib
import re

import numpy as np

from sluice.llm import decontaminate as D
from tests.llm.cases import awkward, frame, plain, prose

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall((text or "").encode().lower())


def benchmark_rows():
    return [(1, prose(80, 30)), (2, prose(81, 10)), (10, "short item!"), (3, None), (4, ""), (5, "?!"), (6, "日本語 текст"), (2, prose(81, 10))]


def documents_rows():
    item = prose(80, 30).split()
    return awkward() + [
        (20, prose(21, 40) + " " + ". ".join(item[5:20]).upper() + " " + prose(22, 40), "en", "a", 0),
        (21, "A short-item, here. " + prose(23, 30), "en", "a", 0), (22, prose(81, 10), "en", "a", 0), (23, " ".join(item[:9]), "en", "a", 0),
    ]


def slow(text, items):
    w = words(text)
    hit, found = [False] * len(w), set()
    for item, other in items:
        o = words(other)
        size = min(10, len(o))
        for i in range(len(o) - size + 1 if o else 0):
            for j in range(len(w) - size + 1):
                if w[j : j + size] == o[i : i + size]:
                    found.add(item)
                    hit[j : j + size] = [True] * size
    ids = ",".join(sorted(map(str, found)))
    return len(w), sum(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), any(hit)


def test_scan_matches_brute_force_in_one_and_in_many_slices(spark):
    benchmark = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    rows = documents_rows()
    want = sorted(((k, *slow(t, benchmark_rows())) for k, t, *_ in rows), key=repr)
    assert plain(D.scan(frame(spark, rows), benchmark)) == want
    assert plain(D.scan(frame(spark, rows, clash=True), benchmark, limit=60)) == want


def test_spans_are_cut_and_mostly_hit_documents_go(spark):
    benchmark = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    df = frame(spark, documents_rows(), clash=True)
    for limit in (D.SET_BYTES, 60):
        out = D.decontaminate(df, benchmark, limit=limit)
        assert out.columns == df.columns
        texts = {r["doc_id"]: r["text"] for r in out.collect()}
        assert 22 not in texts and texts[23] == dict((i, t) for i, t, *_ in documents_rows())[23]
        assert texts[20] == prose(21, 40) + "  " + prose(22, 40)
        assert texts[21] == "A , here. " + prose(23, 30)
        assert texts[4] is None and texts[5] == ""


def test_slices_are_cut_as_one(spark):
    # each item goes to a slice of its own by the limit; items overlap in 20, and 30% and 30% of 21's words are hit
    first, second = prose(90, 30).split(), prose(91, 30).split()
    items = [(i, " ".join(w)) for i, w in enumerate((first[:20], first[12:], second[:15], second[15:]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (20, f"{prose(92, 40)} {' '.join(first)} {prose(93, 40)}", "en", "a", 0),
        (21, f"{' '.join(second[:15])} {prose(94, 20)} {' '.join(second[15:])}", "en", "a", 0),
        (None, f"{prose(95, 40)} {' '.join(first)}", "en", "a", 0), (None, f"{prose(96, 40)} {' '.join(second)}", "en", "a", 0),
    ]
    assert D._parts(benchmark, 20) > 10
    want = sorted([(20, prose(92, 40) + "  " + prose(93, 40)), (None, prose(95, 40) + " "), (None, prose(96, 40) + " ")], key=repr)
    for limit in (D.SET_BYTES, 20):
        assert plain(D.decontaminate(frame(spark, rows, clash=True), benchmark, limit=limit).select("doc_id", "text")) == want


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert D.scan(frame(spark, []), benchmark).count() == 0
    assert not any(r["contaminated"] for r in D.scan(frame(spark), benchmark).collect())


def test_words_and_spans():
    text = "Ab-c9 É_x\x7f日"
    assert D.item_words(text) == words(text)
    assert D.spans_of(np.array([1, 1, 0, 1], bool)) == [{"first": 0, "last": 2}, {"first": 3, "last": 4}]
    assert D.without_spans("a b, c d", np.array([0, 1, 1, 0], bool)) == "a  d"


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(D, "_hashes", lambda ids, starts, size: np.full(len(starts), 7, np.uint64))
    items = [(1, "a b c d"), (2, "b c d e"), (3, "x"), (1, "a b c d"), (4, "c d e f a b c d")]
    made = D.WindowSet.of(items, 3)
    for text in ("a b c d e f", "z a b c z", "x y", "f a b", "", "c d"):
        mask, found = made.hits(D.item_words(text))
        w = D.item_words(text)
        want, hit = set(), [False] * len(w)
        for item, other in items:
            o = D.item_words(other)
            size = min(3, len(o))
            for i in range(len(o) - size + 1):
                for j in range(len(w) - size + 1):
                    if w[j : j + size] == o[i : i + size]:
                        want.add(item)
                        hit[j : j + size] = [True] * size
        assert (mask.tolist(), found) == (hit, want), text


def test_a_window_takes_few_bytes():
    import pickle

    items = [(i, prose(500 + i, 2000)) for i in range(100)]
    made = D.WindowSet.of(items, 10)
    n = sum(len(w.hashes) for w in made.windows.values())
    arrays = made.text.nbytes + sum(a.nbytes for w in made.windows.values() for a in (w.hashes, w.starts, w.owners, w.firsts))
    assert n > 190_000 and arrays < 25 * n and len(pickle.dumps(made)) < 30 * n
