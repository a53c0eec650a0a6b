"""A training corpus from ``documents``: five stages of ``sluice.llm``, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All but the last
return the columns of ``documents``; where a text changes, n_chars follows it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, languages, pieces, repeats, simhash
from sluice.llm.common import documents, stored


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, where it has this column, as its texts have now."""
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else docs


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; null texts and texts without a letter go."""
    return languages.keep_identified(docs)


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group whose fingerprints of three-word shingles differ in 3 bits at most."""
    return simhash.drop_near_duplicates(docs, radius=3, width=3)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur anywhere else; a document of nothing else keeps an empty text."""
    return _counted(repeats.remove_repeats(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; those that are mostly such passages go."""
    return _counted(decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return pieces.encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identified),
    ("simhash", near_deduplicated),
    ("suffix_dedup", without_repeats),
    ("decontaminate", decontaminated),
    ("sentencepiece", encoded),
]

#: SQL can't express the language model, the fingerprints and the tokenizer; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
