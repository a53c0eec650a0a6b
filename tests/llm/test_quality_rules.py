from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from sluice.llm import quality_rules as Q
from tests.llm.cases import awkward, frame, plain, prose


def slow_repeats(words: list, width: int = 8) -> int:
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(width)}
    return len(covered)


@pytest.mark.parametrize("seed", range(12))
def test_repeated_windows_match_brute_force(seed):
    import random

    r = random.Random(seed)
    words = [r.choice("ab" if seed % 2 else "abcdefgh") for _ in range(r.randint(0, 60))]
    assert Q.repeated_in_windows(words) == slow_repeats(words)
    assert Q.repeated_in_windows(words, 3) == slow_repeats(words, 3)


def test_features_of_awkward_texts():
    assert Q.text_features(None) == Q.text_features("") == (0,) * len(Q.FEATURES)
    f = dict(zip(Q.FEATURES, Q.text_features("a b\n\na b\na # é\n \n"), strict=True))
    assert (f["n_words"], f["word_chars"], f["n_symbols"], f["n_dup_lines"]) == (7, 7, 1, 1)


def test_verdicts_on_awkward_rows(spark):
    rows = plain(Q.quality_verdicts(frame(spark)))
    assert rows == plain(Q.quality_verdicts(frame(spark, clash=True)))
    assert len(rows) == len(awkward())
    by_words = {r[0]: r for r in rows if r[0] is not None}
    assert by_words[4][1:6] == (0,) * 5 and by_words[4][12] is True and by_words[4][-1] is False
    assert plain(Q.quality_verdicts(frame(spark, []))) == []


def test_weak_supervision_keeps_good_and_drops_faulty_documents(spark):
    def sentence(seed, n):
        return " ".join(f"the {w}" if i % 4 == 0 else w for i, w in enumerate(prose(seed, n).split()))

    good = [(i, "\n".join(sentence(10 * i + k, 25) for k in range(3)), "en", "a", 0) for i in range(60)]
    shouting = [(100 + i, " ".join(w.upper() + "!!" for w in sentence(i, 40).split()) + "\n" + "BUY NOW!!\n" * 30, "en", "a", 0) for i in range(10)]
    symbols = [(200 + i, " ".join(w + "###" for w in sentence(i, 60).split()), "en", "a", 0) for i in range(10)]
    kept = {r["doc_id"]: r["kept"] for r in Q.quality_verdicts(frame(spark, good + shouting + symbols)).collect()}
    assert all(kept[i] for i in range(60))
    assert not any(kept[i] for i in kept if i >= 100)


def test_fit_finds_the_better_rule():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.8
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) for a in (0.95, 0.9, 0.65)], 1) * 2 - 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = Q.fit(patterns, counts.astype(float), ("a", "b", "c"))
    assert model.on_good[0] > model.on_good[2] and 0.6 < model.good < 0.95
    assert Q.fit(np.zeros((0, 2), int), np.zeros(0), ("a", "b")).good == 0.85


def slow_counts(text: str | None) -> dict[str, int]:
    """Every count, from its definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    chars = "".join(words)
    return {
        "n_words": len(words), "word_chars": len(chars), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated), "n_lines": len(lines), "n_upper": sum(c.isupper() for c in text), "n_letters": len(chars),
        "n_digits": sum(c in "0123456789" for c in text), "n_adjacent": sum(a == b for a, b in zip(words, words[1:], strict=False)),
        "n_stops": sum(re.sub("[A-Z]", lambda m: m[0].lower(), w).encode() in Q.STOPS for w in words),
    }


def slow_votes(c: dict[str, int]) -> list[int]:
    def part(a: str, b: str) -> float:
        return c[a] / max(c[b], 1)

    n, mean = c["n_words"], part("word_chars", "n_words")
    pairs = [
        (n < 20, n >= 40), (mean < 2.5 or mean > 14, 3 <= mean <= 10), (part("n_symbols", "n_words") > 0.1, c["n_symbols"] == 0),
        (part("n_dup_lines", "n_lines") > 0.3, c["n_dup_lines"] == 0 and c["n_lines"] >= 3), (part("n_repeat_words", "n_words") > 0.3, c["n_repeat_words"] == 0 and n >= 40),
        (part("n_adjacent", "n_words") > 0.3, part("n_adjacent", "n_words") < 0.05 and n >= 20), (part("n_upper", "n_letters") > 0.3, part("n_upper", "n_letters") < 0.1 and n >= 20),
        (part("n_digits", "n_letters") > 0.2, c["n_digits"] == 0 and n >= 20), (part("n_stops", "n_words") < 0.05 and n >= 20, part("n_stops", "n_words") >= 0.08 and n >= 20),
    ]
    return [-1 if bad else 1 if good else 0 for bad, good in pairs]


def slow_posteriors(votes: list[list[int]], rounds: int = 300) -> list[float]:
    """Expectation-maximisation document by document."""
    k = len(votes[0])
    right, wrong, good = [0.97] * k, [0.25] * k, 0.85  # accuracies on good and on bad documents

    def posterior(v: list[int]) -> float:
        yes, no = good, 1 - good
        for j, x in enumerate(v):
            if x:
                yes *= right[j] if x > 0 else 1 - right[j]
                no *= 1 - wrong[j] if x > 0 else wrong[j]
        return yes / (yes + no)

    for _ in range(rounds):
        q = [posterior(v) for v in votes]
        for j in range(k):
            cast = [(p, v[j]) for p, v in zip(q, votes, strict=True) if v[j]]
            a = (sum(p for p, x in cast if x > 0) + 9.7) / (sum(p for p, _ in cast) + 10)
            b = (sum(1 - p for p, x in cast if x < 0) + 2.5) / (sum(1 - p for p, _ in cast) + 10)
            right[j] = min(max(a, 0.6), 0.995)
            wrong[j] = min(max(b, 1.2 * (1 - right[j])), 0.95)
        good = min(max(sum(q) / len(q), 0.05), 0.95)
    return [posterior(v) for v in votes]


def test_whole_result_matches_brute_force(spark):
    rows = awkward() + [(100 + i, "\n".join(prose(10 * i + k, 15 + i) for k in range(3)), "en", "a", 0) for i in range(30)]
    rows += [(200 + i, prose(i, 12) + "\n" + "Buy it NOW!! 100% #1\n" * (i + 1) + prose(i, 30), "en", "a", 0) for i in range(12)]
    rows += [(300 + i, " ".join([prose(i, 9)] * (i + 1)), "en", "a", 0) for i in range(8)]
    counts = [slow_counts(t) for _, t, *_ in rows]
    posteriors = slow_posteriors([slow_votes(c) for c in counts])
    want = []
    for (key, *_), c, p in zip(rows, counts, posteriors, strict=True):
        failed = c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
        want.append((key, *(c[f] for f in Q.FEATURES), failed, not failed and p >= 0.5, p))
    got = [(*r[:-2], r[-1], r[-2]) for r in Q.quality_verdicts(frame(spark, rows)).collect()]
    # the fit stops once it moves by less than 1e-9 a round
    for g, w in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert g[:-1] == w[:-1] and g[-1] == pytest.approx(w[-1], abs=1e-5)
