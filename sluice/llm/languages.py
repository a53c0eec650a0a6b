"""Language identification by multilingual mixture inference.

A document is a mixture of languages.  Expectation-maximisation estimates its
proportions from the likelihoods of its letter trigrams; the set of languages
is chosen by penalised likelihood, adding the next strongest language while
that pays; the language of the largest proportion is predicted.

The trigram likelihoods are learned from labelled rows: at most ``SAMPLE`` of
each language, chosen by hash.  What reaches the driver is one row for each
language and trigram bucket, and the model sent out has that size.

Null texts and texts without a letter are ``und`` with score 0.  A corpus
without labelled rows gives ``und`` for all.  Ties go to the language first in
the alphabet; repeated rows get equal results; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bounded_sample, held_out, map_rows, ship

UNKNOWN = "und"
#: Labelled rows of each language that the model is fitted on, at most.
SAMPLE = 5000
BUCKETS = 1 << 15
#: Characters that are turned into trigrams at a time.
BLOCK = 1 << 18
_letters: np.ndarray | None = None


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters[points]


def trigram_counts(text: str | None) -> tuple[np.ndarray, int]:
    """Counts of the text's letter trigrams by bucket, over all of it, and how many letters it has.

    Letters are lower-cased; everything else is a blank, and neighbouring blanks are one.  A trigram with a blank
    in its middle doesn't count.
    """
    counts, letters = np.zeros(BUCKETS, np.int64), 0
    carry = np.array([32], np.uint32)
    for start in range(0, len(text or ""), BLOCK):
        points = np.frombuffer(text[start : start + BLOCK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = _is_letter(points)
        letters += int(is_letter.sum())
        points = np.concatenate([carry, np.where(is_letter, points, 32)])
        points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
        carry = points[-2:]
        _count(counts, points)
    if carry[-1] != 32:
        _count(counts, np.append(carry, np.uint32(32)))
    return counts, letters


def _count(counts: np.ndarray, points: np.ndarray) -> None:
    if len(points) < 3:
        return
    a, b, c = points[:-2], points[1:-1], points[2:]
    mixed = (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    counts += np.bincount((mixed >> np.uint32(17))[b != 32], minlength=BUCKETS)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in alphabetical order, and the likelihood of each bucket under each."""

    languages: tuple[str, ...]
    likelihood: np.ndarray  # BUCKETS x languages

    @classmethod
    def of(cls, languages: list[str], counts: np.ndarray, weight: float = 2000.0) -> LanguageModel:
        """``counts`` is languages x BUCKETS; ``weight`` pseudo-counts follow the shares over all languages."""
        total = counts.sum(0) + 0.5
        smooth = counts + weight * total / total.sum()
        return cls(tuple(languages), np.ascontiguousarray((smooth / smooth.sum(1, keepdims=True)).T))


def fit_languages(docs: DataFrame, most: int = SAMPLE) -> LanguageModel:
    """Learn from the labelled rows of ``docs``: those with text and lang."""
    labelled = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")

    def make(texts: list, languages: list) -> Iterator[tuple]:
        sums: dict[str, np.ndarray] = {}
        for text, language in zip(texts, languages, strict=True):
            counts, _ = trigram_counts(text)
            sums[language] = sums[language] + counts if language in sums else counts
        for language, counts in sums.items():
            for bucket in np.flatnonzero(counts).tolist():
                yield language, bucket, int(counts[bucket])

    found = map_rows(bounded_sample(labelled, "lang", "doc_id", most), ["text", "lang"], make, "lang string, bucket int, n bigint")
    rows = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique().tolist())
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        counts[rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return LanguageModel.of(languages, counts)


def mixture(likelihood: np.ndarray, counts: np.ndarray, rounds: int = 40, prior: float = 1.0) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``likelihood`` by expectation-maximisation, and the log-likelihood.

    ``prior`` pseudo-trigrams of each language keep a proportion above zero.
    """
    k, n = likelihood.shape[1], counts.sum()
    shares = np.full(k, 1 / k)
    for _ in range(rounds if k > 1 else 0):
        joint = likelihood * shares
        new = (counts / joint.sum(1)) @ joint + prior
        new /= n + k * prior
        moved = np.abs(new - shares).max()
        shares = new
        if moved < 1e-3:
            break
    return shares, float(counts @ np.log(likelihood @ shares))


def infer(model: LanguageModel, counts: np.ndarray, penalty: float = 8.0) -> tuple[dict[int, float], np.ndarray]:
    """The chosen languages (by number) with their proportions; and the proportions with all languages allowed.

    A further language must raise the log-likelihood by more than ``penalty`` times half the log of the number
    of trigrams: trigrams overlap, so their likelihoods tell the same several times.
    """
    found = np.flatnonzero(counts)
    held, weight = model.likelihood[found], counts[found].astype(float)
    k = len(model.languages)
    if k == 1 or not len(found):
        return {0: 1.0}, np.full(k, 1 / k)
    shares, _ = mixture(held, weight)
    order = np.argsort(-shares, kind="stable")
    price = penalty * 0.5 * np.log(weight.sum() + 1)
    single = weight @ np.log(held)
    best = [int(np.argmax(single))]
    chosen, value = {best[0]: 1.0}, float(single[best[0]]) - price
    for language in order.tolist():
        if language in best:
            continue
        trial = [*best, language]
        own, likelihood = mixture(held[:, trial], weight)
        if likelihood - price * len(trial) <= value:
            break
        best, value = trial, likelihood - price * len(trial)
        chosen = dict(zip(trial, own.tolist(), strict=True))
    return chosen, shares


def language_of(model: LanguageModel, text: str | None) -> tuple[str, float, list[str]]:
    """Language predicted, its proportion with all languages allowed, and the languages chosen."""
    counts, letters = trigram_counts(text)
    if not letters or not model.languages:
        return UNKNOWN, 0.0, []
    chosen, shares = infer(model, counts)
    top = min(chosen, key=lambda i: (-chosen[i], i))
    return model.languages[top], float(min(1.0, max(0.0, shares[top]))), [model.languages[i] for i in chosen]


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, score, languages (as language_of)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts, strict=True):
            yield key, *language_of(held.value, text)

    return map_rows(docs, ["doc_id", "text"], make, "doc_id bigint, lang_pred string, score double, languages array<string>")


def predict_languages(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Fit on the labelled rows outside the held-out fold and predict all rows."""
    model = fit_languages(docs.where(~held_out()), most)
    return identify(docs, model).withColumn("held_out", held_out())


def keep_identified(docs: DataFrame, most: int = SAMPLE, least: float = 0.4, allowed: Collection[str] | None = None) -> DataFrame:
    """``docs`` with its columns, the rows whose language is told: one of ``allowed`` (None: any), with a proportion of ``least``.

    Null texts and texts without a letter have no language.  A text of a few letters, or one of several languages none
    of which leads, has proportions near those of no evidence at all and goes, too.
    """
    import pyarrow as pa

    ship(docs.sparkSession)
    at = docs.columns.index("text")
    held = docs.sparkSession.sparkContext.broadcast(fit_languages(docs.where(~held_out()), most))

    def told(text: str | None) -> bool:
        language, share, _ = language_of(held.value, text)
        return language != UNKNOWN and share >= least and (allowed is None or language in allowed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [told(text) for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
