from __future__ import annotations

import hashlib
import re

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from sluice.llm import languages, queries
from sluice.llm.common import held_out
from tests.conftest import SF_SMALL
from tests.llm.cases import frame, plain, prose
from tests.llm.test_decontaminate import words
from tests.llm.test_repeats import slow_gone
from tests.llm.test_simhash import slow_kept
from tests.oracle_check import digest, duck


def test_every_query_is_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    columns, want = duck(SF_SMALL, queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]


def test_stages_chain_and_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash", "suffix_dedup", "decontaminate", "sentencepiece"]
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        if i < 4:
            assert out.dtypes == docs.dtypes, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert left <= ids and left, name
        ids = left


def cut(text: str, gone) -> str:
    """The characters of which some byte stays."""
    out, at = [], 0
    for c in text:
        size = len(c.encode())
        if not all(gone[at : at + size]):
            out.append(c)
        at += size
    return "".join(out)


def without_items(text: str, items: list[tuple]) -> str | None:
    """The text without its hit words and what lies between two of them; None if over half of the words are hit."""
    raw = text.encode()
    places = [m.span() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", raw)]
    w = [raw[a:b].lower() for a, b in places]
    hit = [False] * len(w)
    for _, other in items:
        o = words(other)
        size = min(10, len(o))
        for i in range(len(o) - size + 1 if o else 0):
            for j in range(len(w) - size + 1):
                if w[j : j + size] == o[i : i + size]:
                    hit[j : j + size] = [True] * size
    if not any(hit):
        return text
    if 2 * sum(hit) > len(hit):
        return None
    gone = [False] * len(raw)
    for j, h in enumerate(hit):
        if h:
            upto = places[j + 1][0] if j + 1 < len(hit) and hit[j + 1] else places[j][1]
            gone[places[j][0] : upto] = [True] * (upto - places[j][0])
    return bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode()


def fixture_rows() -> tuple[list[tuple], list[tuple]]:
    """Documents with copies, near copies, shared passages, benchmark passages, repeated and missing ids; and the items."""
    french = "le la des une maison arbre rivière pierre lumière eau dans avec"
    base = [prose(300 + i, 80 + 10 * i, **({"words": french} if i % 2 else {})) for i in range(8)]
    passage, items = prose(400, 60), [(1, prose(401, 25)), (2, prose(402, 14)), (3, "a few words"), (4, None)]
    rows = [(i, t, "fr" if i % 2 else "en", "a") for i, t in enumerate(base)]
    rows += [(20, base[0], "en", "b"), (None, base[0], "en", "b"), (21, base[1].replace(" ", "  "), "fr", "b"), (22, base[2] + " end", "en", "b")]
    rows += [(30, f"{base[3][:300]} {passage} {base[4][:200]}", "en", "c"), (31, f"{prose(310, 60)}\n{passage}", "en", "c")]
    rows += [(40, f"{prose(311, 50)}. {items[0][1].upper()}! {prose(312, 50)}", "en", "d"), (41, items[1][1], "en", "d"), (42, f"{prose(313, 30)} A few, words {items[1][1]}", "en", "d")]
    rows += [(50, None, "en", "e"), (51, "", "en", "e"), (52, "12 ??", None, "e"), (53, prose(314, 70), "en", "e"), (53, prose(315, 70), "en", "e"), (53, prose(315, 70), "en", "e"), (None, prose(316, 70), None, "e")]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows], items


def test_the_pipeline_equals_plain_python(spark, tmp_path):
    rows, items = fixture_rows()
    frame(spark, rows, clash=True).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    # language: the model is fitted once, its use on each text is held against plain Python in test_languages
    model = languages.fit_languages(frame(spark, rows).where(~held_out()))
    told = [r for r in rows if (found := languages.language_of(model, r[1]))[0] != "und" and found[1] >= 0.4]
    assert {r[0] for r in rows} - {r[0] for r in told} == {50, 51, 52}
    one = slow_kept(told)
    gone = slow_gone([t.encode() for _, t in one], 200)
    whole = [(k, cut(t, g)) for (k, t), g in zip(one, gone, strict=True)]
    assert sum(a != b for a, b in zip(one, whole, strict=True)) >= 4
    clean = [(k, x) for k, t in whole if (x := without_items(t, items)) is not None]
    assert {k for k, _ in whole} - {k for k, _ in clean} == {41} and len(clean) < len(rows) - 6
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for k, t in clean:
        ids = [1, *library.encode(t), 2]
        want.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert plain(got) == sorted(want, key=repr)


def test_stages_on_awkward_rows(spark):
    for rows in (None, []):
        docs = frame(spark, rows, clash=True)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())
