from __future__ import annotations

import random

import pytest

from sluice.llm import toxicity as T
from tests.llm.cases import awkward, frame, plain, prose

LABELS = "doc_id long, quality int, toxic int"


def slow_segments(scores: list[float]) -> list[tuple[int, int]]:
    """Maximal segments by recursion: the best one, then the same on its left and right."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-9 and (best is None or total > best[0] + 1e-9 or (abs(total - best[0]) <= 1e-9 and j - i < best[2] - best[1])):
                best = (total, i, j)
    if best is None:
        return []
    _, i, j = best
    return slow_segments(scores[:i]) + [(i, j)] + [(a + j + 1, b + j + 1) for a, b in slow_segments(scores[j + 1 :])]


@pytest.mark.parametrize("seed", range(60))
def test_segments_match_the_recursive_definition(seed):
    r = random.Random(seed)
    # distinct powers, so that no two segments tie
    scores = [r.random() * 3 + 0.001 * i if r.random() < 0.4 else -0.25 for i in range(r.randint(0, 30))]
    got = T.segments([(i, s) for i, s in enumerate(scores) if s > 0])
    assert [(a, b) for _, a, b in got] == slow_segments(scores)
    for s, a, b in got:
        assert abs(s - sum(scores[a : b + 1])) < 1e-9


def corpus():
    r = random.Random(0)
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 80).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(6):
                words.insert(r.randrange(len(words)), r.choice(["wretch", "vermin", "filth", "zlor" + r.choice("abcdefghijk") * 2]))
        rows.append((1000 + i, " ".join(words), "en", "a", 0))
        labels.append((1000 + i, 1, int(toxic)))
    return rows, labels


def test_toxic_documents_are_found_and_clean_ones_left(spark):
    rows, labels = corpus()
    rows += [(1, prose(999, 60) + " wretch and vermin, filth", "en", "a", 0), (2, prose(998, 60), "en", "a", 0)] + [(3000 + r[0], *r[1:]) if r[0] is not None else r for r in awkward()]
    out = {r["doc_id"]: r for r in T.predict_toxicity(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    wrong = [i for i, _, y in labels if out[i]["predicted"] != y]
    assert len(wrong) <= 8
    assert out[1]["predicted"] == 1 and out[2]["predicted"] == 0 and out[1]["passages"]
    assert all(0 <= r["score"] <= 1 for r in out.values()) and out[3004]["score"] < 0.5 and out[3005]["score"] < 0.5


def test_without_labels_nothing_is_toxic(spark):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], LABELS)
    for clash in (False, True):
        rows = plain(T.predict_toxicity(frame(spark, clash=clash), labels))
        assert len(rows) == len(awkward()) and all(r[-1] == 0 and r[1] < 1e-6 for r in rows)
    assert plain(T.predict_toxicity(frame(spark, []), spark.createDataFrame([], LABELS))) == []


def test_the_rate_solves_its_equation():
    import math

    rate = T.karlin_rate({5.0: 10, 3.0: 5}, 100_000)
    p5, p3 = 10.5 / 100_001, 5.5 / 100_001
    assert abs(p5 * math.exp(5 * rate) + p3 * math.exp(3 * rate) + (1 - p5 - p3) * math.exp(T.GAP * rate) - 1) < 1e-6
