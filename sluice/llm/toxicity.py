"""Toxicity by maximum-scoring segments.

Every token has a score: the log-odds between toxic and other documents, with
an informative Dirichlet prior, where these are significant; a small negative
score otherwise.  A linear-time scan (Ruzzo and Tompa, 1999) finds all maximal
segments of a document.  A segment's score S is calibrated by extreme-value
theory (Karlin and Altschul, 1990): with n tokens, lambda*S - ln(K*n) is its
normalised score, above 0 for significant passages.  The sum over significant
passages is turned into a probability by logistic regression.

A word that is not significant itself takes the score of its prefix of 3 to 5
letters where the other words of that prefix are, which finds inflected forms
of one stem; not, however, where clean documents hold that very word.

The fit uses at most ``SAMPLE`` labelled documents of each class, chosen by
hash, so the lexicon, which is broadcast, and the calibration table are
bounded by that sample.  Scoring reads every whole text.

Null and empty texts have no segment and get the score of a document without
any.  Copies of a text count once in the fit; a document labelled both ways
counts as toxic; a corpus without labels gives score 0 to all.  Repeated rows
get equal results; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bounded_sample, held_out, map_rows, stored

#: Labelled documents of each class that the model is fitted on, at most.
SAMPLE = 20_000
PREFIXES = (3, 4, 5)
PRIOR = 100.0
#: Score of a token that tells nothing.
GAP = -0.25
#: Scores of words that a worker keeps.
CACHE = 1_000_000
_WORD = re.compile(r"[^\W\d_]+")


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def prefixes_of(word: str) -> Iterator[str]:
    """The word's proper prefixes, marked by a dash."""
    for n in PREFIXES:
        if len(word) > n:
            yield word[:n] + "-"


def segments(scored: Iterable[tuple[int, float]], gap: float = GAP) -> list[tuple[float, int, int]]:
    """All maximal scoring segments, as (score, first, last), of a sequence given by its positive places.

    ``scored`` has place and positive score in order; each place between scores ``gap``.
    """
    found: list[tuple[float, float, int, int]] = []  # total before, total after, first, last
    total, at = 0.0, 0
    for place, score in scored:
        total += gap * (place - at)
        before, after, first, at = total, total + score, place, place + 1
        total = after
        # join with the segments between the nearest one of a smaller total before and this one
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= before:
                j -= 1
            if j < 0 or found[j][1] >= after:
                break
            before, first = found[j][0], found[j][2]
            del found[j:]
        found.append((before, after, first, place))
    return [(b - a, first, last) for a, b, first, last in found]


@dataclass
class ToxicModel:
    """Scores of significant features, the extreme-value parameters, and the calibration."""

    scores: dict[str, float] = field(default_factory=dict)  # words, and prefixes with a dash; 0 for exceptions
    rate: float = 1.0  # lambda
    k: float = 1.0
    slope: float = 0.0
    offset: float = -50.0

    def evidence(self, n: int, found: list[tuple[float, int, int]]) -> tuple[float, list[tuple[float, int, int]]]:
        """Sum of the significant segments' normalised scores, or else the best one's (at most 0); and those segments."""
        base = math.log(max(1.0, self.k * n))
        normal = [(self.rate * s - base, first, last) for s, first, last in found]
        good = [x for x in normal if x[0] > 0]
        if good:
            return min(60.0, sum(x[0] for x in good)), good
        return max([-base, *(x[0] for x in normal)]), []

    def probability(self, evidence: float) -> float:
        z = self.slope * evidence + self.offset
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


class Scorer:
    """A model with this process's cache of word scores."""

    def __init__(self, model: ToxicModel) -> None:
        self.model, self.cache = model, {}

    def score(self, word: str) -> float:
        known = self.cache.get(word)
        if known is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            scores = self.model.scores
            known = scores.get(word)
            if known is None:
                known = max((scores[f] for f in prefixes_of(word) if f in scores), default=0.0)
            self.cache[word] = known
        return known

    def read(self, text: str | None) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of tokens and maximal segments of a text."""
        words = tokens_of(text)
        return len(words), segments([(i, s) for i, s in enumerate(map(self.score, words)) if s > 0])


def _labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(toxic, text) of the sampled labelled documents, each text once."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = bounded_sample(known.where(~held_out()), "toxic", "doc_id", most)
    own = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most two times ``most`` labels
    return stored(own.groupBy(F.xxhash64("text").alias("h")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")).drop("h"), "toxicity")


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> ToxicModel:
    """Learn from the labelled documents outside the held-out fold."""
    train = _labelled(docs, labels, most)
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return ToxicModel()

    words = stored(_counts(train, lambda word: [word], frozenset()), "toxicity")
    scores = _significant(words, n1, n0)
    stems = _significant(_counts(train, prefixes_of, frozenset(scores)), n1, n0)
    if stems:  # clean words of these stems; both lists are bounded by the sample
        known = words.where("y0 >= 2").where(F.array_contains(F.transform(F.lit(list(PREFIXES)), lambda n: F.concat(F.substring("feature", F.lit(1), n), F.lit("-")).isin(list(stems))), True))
        scores = {r["feature"]: 0.0 for r in known.collect()} | stems | scores
    model = ToxicModel(scores)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def read(classes: list, texts: list) -> Iterator[tuple]:
        scorer = Scorer(held.value)
        for toxic, text in zip(classes, texts, strict=True):
            n, found = scorer.read(text)
            hits = Counter(round(s * 4) / 4 for s in (scorer.score(w) for w in tokens_of(text)) if s > 0)
            yield toxic, n, max((s for s, _, _ in found), default=0.0), list(hits), list(hits.values())

    reads = stored(map_rows(train, ["toxic", "text"], read, "toxic int, n bigint, best double, hit array<double>, times array<bigint>"), "toxicity")
    clean = reads.where("toxic = 0")
    total = clean.agg(F.sum("n")).first()[0] or 1
    places = {r["s"]: r["t"] for r in clean.select(F.explode(F.arrays_zip("hit", "times")).alias("x")).groupBy(F.col("x.hit").alias("s")).agg(F.sum("x.times").alias("t")).collect()}
    rate = karlin_rate(places, total)
    # K from the clean documents' best segments: the mean of exp(lambda*S)/n where one exists, at least one in a thousand tokens.
    tail = clean.where("best > 0").agg(F.avg(F.exp(F.least(F.lit(rate) * F.col("best"), F.lit(50.0))) / F.col("n"))).first()[0]
    model = ToxicModel(scores, rate, min(1.0, max(1e-3, tail or 0.0)))
    return _calibrated(model, train)


def _counts(train: DataFrame, features, without: frozenset) -> DataFrame:
    """(feature, y1, y0): in how many toxic and other documents the features of words outside ``without`` occur."""

    def count(classes: list, texts: list) -> Iterator[tuple]:
        held = (Counter(), Counter())
        for toxic, text in zip(classes, texts, strict=True):
            held[toxic].update({f for w in set(tokens_of(text)) - without for f in features(w)})
        for f in held[0].keys() | held[1].keys():
            yield f, held[1][f], held[0][f]

    return map_rows(train, ["toxic", "text"], count, "feature string, y1 bigint, y0 bigint").groupBy("feature").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))


def _significant(counts: DataFrame, n1: int, n0: int) -> dict[str, float]:
    """Log-odds of the features that toxic documents hold significantly more often; at most 8 each.

    The Dirichlet prior has the weight of PRIOR documents, dealt out at the feature's share of all documents.
    """
    share = (F.col("y1") + F.col("y0")) / (n1 + n0)
    a1, a0 = F.col("y1") + PRIOR * share, F.col("y0") + PRIOR * share
    odds = F.log(a1 / (n1 + PRIOR - a1)) - F.log(a0 / (n0 + PRIOR - a0))
    found = counts.where((F.col("y1") >= 5) & (a1 < n1 + PRIOR) & (a0 < n0 + PRIOR)).select("feature", odds.alias("odds"), (odds / F.sqrt(1 / a1 + 1 / a0)).alias("z"))
    return {r["feature"]: min(8.0, r["odds"]) for r in found.where("z > 4 and odds > 2.5").collect()}


def karlin_rate(places: dict[float, int], total: int, gap: float = GAP) -> float:
    """The lambda > 0 at which the mean of exp(lambda * score) over clean tokens is 1; scores seldom seen get a pseudo-count."""
    pool = dict(places) or {8.0: 0}
    weight = {s: (t + 0.5) / (total + 1) for s, t in pool.items()}
    rest = 1 - sum(weight.values())
    if sum(s * p for s, p in weight.items()) + gap * rest >= 0:
        return 0.05
    low, high = 0.0, 20.0
    for _ in range(200):
        mid = (low + high) / 2
        value = rest * math.exp(mid * gap) + sum(p * math.exp(min(700.0, mid * s)) for s, p in weight.items())
        low, high = (mid, high) if value < 1 else (low, mid)
    return max(0.05, low)


def _calibrated(model: ToxicModel, train: DataFrame) -> ToxicModel:
    """Fit the logistic curve on the counts of evidence values in steps of a quarter: a table of a few hundred rows."""
    held = train.sparkSession.sparkContext.broadcast(model)

    def read(classes: list, texts: list) -> Iterator[tuple]:
        scorer = Scorer(held.value)
        for toxic, text in zip(classes, texts, strict=True):
            yield toxic, round(model_evidence(scorer, text) * 4) / 4

    rows = map_rows(train, ["toxic", "text"], read, "toxic int, x double").groupBy("x").agg(F.sum("toxic").alias("y1"), F.count(F.lit(1)).alias("n")).collect()
    x = np.array([r["x"] for r in rows])
    y, n = np.array([r["y1"] for r in rows], float), np.array([r["n"] for r in rows], float)
    # Both classes weigh the same; a ridge keeps the slope finite where the classes are apart.
    w1, w0 = n.sum() / (2 * max(1, y.sum())), n.sum() / (2 * max(1, (n - y).sum()))
    features, beta = np.stack([x, np.ones_like(x)], 1), np.array([0.1, 0.0])
    ridge = np.diag([1.0, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (w1 * y * (1 - p) - w0 * (n - y) * p) - ridge @ beta
        hessian = (features * ((w1 * y + w0 * (n - y)) * p * (1 - p))[:, None]).T @ features + ridge
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return ToxicModel(model.scores, model.rate, model.k, float(max(0.0, beta[0])), float(beta[1]))


def model_evidence(scorer: Scorer, text: str | None) -> float:
    return scorer.model.evidence(*scorer.read(text))[0]


def score_toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """Per row of ``docs``: doc_id, score, passages (significant segments: first and last token, normalised score)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(keys: list, texts: list) -> Iterator[tuple]:
        scorer = Scorer(held.value)
        for key, text in zip(keys, texts, strict=True):
            evidence, good = scorer.model.evidence(*scorer.read(text))
            yield key, scorer.model.probability(evidence), [{"first": a, "last": b, "score": s} for s, a, b in good]

    return map_rows(docs, ["doc_id", "text"], make, "doc_id bigint, score double, passages array<struct<first:bigint,last:bigint,score:double>>")


def predict_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most: int = SAMPLE) -> DataFrame:
    """Fit on the labelled documents outside the held-out fold; score all documents."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels, most))
    return scored.withColumns({"held_out": held_out(), "predicted": (F.col("score") >= threshold).cast("int")})
