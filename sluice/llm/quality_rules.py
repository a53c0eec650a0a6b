"""Quality rules by weak supervision.

Each rule votes good, bad or abstains on a document.  Expectation-maximisation
over the counts of vote patterns estimates every rule's accuracy and the share
of good documents; the posterior probability of "good" decides, instead of
requiring that all rules pass.

The patterns are at most 3 to the number of rules, whatever the corpus holds,
so the fit runs on that bounded table; counting the patterns and scoring the
documents stay in Spark.

Null and empty texts have no words: every count is 0, and the base rules fail
them.  Repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_rows, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_stops", "n_adjacent"]
#: Frequent function words of the languages expected; a rule looks for their share.
STOPS = frozenset("the of and to in is that for with as was by are this or de la le les et des que en el un una los las por y der die und das von mit den im zu ein".encode().split())


def repeated_in_windows(words: list, width: int = WINDOW) -> int:
    """Words that lie in a ``width``-word window found twice or more, the first included.

    Windows are numbered exactly by doubling: equal halves have equal numbers.
    """
    n = len(words)
    if n <= width:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    size = 1
    while size * 2 <= width:
        _, ids = np.unique(ids[:-size] * (n + 1) + ids[size:], return_inverse=True)
        size *= 2
    if size < width:
        gap = width - size
        _, ids = np.unique(ids[:-gap] * (n + 1) + ids[gap:], return_inverse=True)
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_features(text: str | None) -> tuple[int, ...]:
    """The counts in FEATURES, over the whole text."""
    if not text:
        return (0,) * len(FEATURES)
    raw = text.encode()
    words = raw.split()
    lines = [line for line in text.split("\n") if line.encode().strip()]
    blanks = sum(raw.count(c) for c in b" \t\n\v\f\r")
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    letters = len(text) - blanks
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    return (
        len(words), len(text) - blanks, len(raw) - len(raw.translate(None, SYMBOLS.encode())), len(lines) - len(set(lines)),
        repeated_in_windows(words), len(lines), upper, letters, digits, sum(w in STOPS for w in raw.lower().split()),
        sum(map(bytes.__eq__, words, words[1:])),
    )


def document_features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, FEATURES...) for each row of ``docs``."""

    def make(keys: list, texts: list) -> Iterator[tuple]:
        for k, t in zip(keys, texts, strict=True):
            yield (k, *text_features(t))

    kind = dict(docs.dtypes)[key]
    return map_rows(docs, [key, text], make, f"`{key}` {kind}, " + ", ".join(f"{f} bigint" for f in FEATURES))


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def vote(bad: Column, good: Column) -> Column:
    """-1 where ``bad``, else 1 where ``good``, else 0 (the rule abstains)."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def default_rules() -> dict[str, Column]:
    """Name -> vote in -1, 0, 1 over the FEATURES columns."""
    words, mean = F.col("n_words"), share("word_chars", "n_words")
    return {
        "length": vote(words < 20, words >= 40),
        "word_length": vote((mean < 2.5) | (mean > 14), mean.between(3, 10)),
        "symbols": vote(share("n_symbols", "n_words") > 0.1, F.col("n_symbols") == 0),
        "dup_lines": vote(share("n_dup_lines", "n_lines") > 0.3, (F.col("n_dup_lines") == 0) & (F.col("n_lines") >= 3)),
        "repeats": vote(share("n_repeat_words", "n_words") > 0.3, (F.col("n_repeat_words") == 0) & (words >= 40)),
        "stutter": vote(share("n_adjacent", "n_words") > 0.3, (share("n_adjacent", "n_words") < 0.05) & (words >= 20)),
        "capitals": vote(share("n_upper", "n_letters") > 0.3, (share("n_upper", "n_letters") < 0.1) & (words >= 20)),
        "digits": vote(share("n_digits", "n_letters") > 0.2, (F.col("n_digits") == 0) & (words >= 20)),
        "stop_words": vote((share("n_stops", "n_words") < 0.05) & (words >= 20), (share("n_stops", "n_words") >= 0.08) & (words >= 20)),
    }


@dataclass(frozen=True)
class RuleModel:
    """Of each rule, how often its vote is right on good and on bad documents; and the share of good documents."""

    names: tuple[str, ...]
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]
    good: float

    def weights(self) -> list[tuple[float, float]]:
        """Log-odds that a vote for good, and one for bad, adds."""
        return [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in zip(self.on_good, self.on_bad, strict=True)]


def fit(patterns: np.ndarray, counts: np.ndarray, names: tuple[str, ...], rounds: int = 300, prior: float = 10.0) -> RuleModel:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and their counts.

    A rule has two accuracies, one on each kind of document, since most rules say little by finding nothing
    wrong and much by finding a fault.  Abstentions carry no evidence.  ``prior`` pseudo-votes hold an accuracy
    near its start where a rule hardly votes; the bounds keep a vote for bad from ever counting as good.
    """
    on_good, on_bad, good = np.full(len(names), 0.97), np.full(len(names), 0.25), 0.85
    total = counts.sum()
    up, down = (patterns > 0).astype(float), (patterns < 0).astype(float)
    for _ in range(rounds if total else 0):
        logit = math.log(good / (1 - good)) + up @ np.log(on_good / (1 - on_bad)) + down @ np.log((1 - on_good) / on_bad)
        q = (1 / (1 + np.exp(-logit)))[:, None] * counts[:, None]
        p = counts[:, None] - q
        new_good = ((q * up).sum(0) + 0.97 * prior) / ((q * (up + down)).sum(0) + prior)
        new_bad = ((p * down).sum(0) + 0.25 * prior) / ((p * (up + down)).sum(0) + prior)
        new_good = np.clip(new_good, 0.6, 0.995)
        new_bad = np.clip(new_bad, 1.2 * (1 - new_good), 0.95)
        good = float(np.clip(q.sum() / total, 0.05, 0.95))
        done = max(np.abs(new_good - on_good).max(), np.abs(new_bad - on_bad).max()) < 1e-9
        on_good, on_bad = new_good, new_bad
        if done:
            break
    return RuleModel(names, tuple(on_good.tolist()), tuple(on_bad.tolist()), good)


def fit_rules(features: DataFrame, rules: dict[str, Column]) -> RuleModel:
    """Fit on the vote patterns of all rows; what reaches the driver has at most 3 ** len(rules) rows."""
    names = tuple(rules)
    found = features.select(*(c.alias(n) for n, c in rules.items())).groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).collect()
    patterns = np.array([[r[n] for n in names] for r in found], dtype=np.int64).reshape(-1, len(names))
    order = np.lexsort(patterns.T[::-1]) if len(found) else []
    return fit(patterns[order], np.array([r["__n"] for r in found], dtype=float)[order], names)


def posterior(model: RuleModel, rules: dict[str, Column]) -> Column:
    """Probability that a row is good, as an expression over its votes."""
    logit = F.lit(math.log(model.good / (1 - model.good)))
    for name, (up, down) in zip(model.names, model.weights(), strict=True):
        logit = logit + F.when(rules[name] > 0, up).when(rules[name] < 0, down).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def quality_verdicts(docs: DataFrame, rules: dict[str, Column] | None = None, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id, FEATURES, base_failed, quality (posterior), kept."""
    rules = rules or default_rules()
    features = stored(document_features(docs), "quality")
    model = fit_rules(features, rules)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return features.withColumns({"base_failed": failed, "quality": posterior(model, rules)}).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
