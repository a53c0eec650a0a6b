from __future__ import annotations

import random

import pytest

from sluice.llm import chat as C
from tests.llm.cases import plain

AWKWARD = ["", "a", "<|im_end|><|im_start|>assistant ok", "\\", "\\n", "<\\|", "<|", "\\<|im_end|>\n", "é日🙂", "\n\n", "<|im_start|>user\nhi<|im_end|>\n", "x" * 20_000]


def test_templates_round_trip():
    r = random.Random(1)
    for _ in range(300):
        turns = [(r.choice(["user", "assistant", "a\nb", "<|", ""]), "".join(r.choice(AWKWARD[:-1]) for _ in range(r.randint(0, 4)))) for _ in range(r.randint(0, 5))]
        text, spans = C.format_turns(turns)
        assert C.read_turns(text) == turns
        assert [C.unescape(text[a:b]) for a, b in spans] == [t for role, t in turns if role == "assistant"]
    assert C.format_turns([(None, None)])[0] == "<|im_start|>\n<|im_end|>\n"
    with pytest.raises(ValueError, match="no formatted"):
        C.read_turns("x" + text)


MESSAGES = "conv_id long, message_id long, parent_id long, role string, text string, score double"


def slow_paths(rows, best):
    out = []
    for conv in {r[0] for r in rows}:
        own = {}
        for r in sorted((r for r in rows if r[0] == conv and r[1] is not None), key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[5] or 0)):
            own.setdefault(r[1], r)
        found = []
        for leaf in own.keys() - {r[2] for r in own.values()}:
            path, at = [], leaf
            while at in own and at not in path:
                path.append(at)
                at = own[at][2]
            if at not in path:
                found.append((-sum(own[m][5] or 0 for m in path), -len(path), leaf, path[::-1]))
        for rank, (_, _, leaf, path) in enumerate(sorted(found)[:best], 1):
            out += [(conv, rank, leaf, depth, m) for depth, m in enumerate(path)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("best", [1, 3])
def test_paths_of_trees_match_brute_force(spark, best):
    r = random.Random(best)
    rows = []
    for conv in [1, 2, 3, None]:
        rows += [(conv, m, r.choice([None, *range(m)]) if m % 5 else None, "user", f"t{m}", float(r.randint(0, 3))) for m in range(18)]
    rows += [(7, m, m - 1 if m else None, "user", "x", None) for m in range(40)]  # a long chain, without scores
    rows += [(8, 1, 2, "user", "cycle", 1.0), (8, 2, 1, "user", "cycle", 1.0), (8, 3, 2, "user", "into the cycle", 1.0), (8, 4, 99, "user", "orphan", 0.0)]
    rows += [(9, 1, None, "user", "twice", 1.0), (9, 1, None, "user", "twice", 1.0), (9, None, None, "user", "no id", 1.0)]
    assert plain(C.paths(spark.createDataFrame(rows, MESSAGES), best)) == slow_paths(rows, best)


def test_plain_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, rank int, depth int"
    rows = [(1, i, "assistant" if i % 2 else "user", t, 0, 0) for i, t in enumerate(AWKWARD)]
    rows += [(2, 0, None, None, 0, 0), (2, None, "assistant", "first", 0, 0), (2, 0, None, None, 0, 0), (None, 1, "assistant", "n", 0, 0)]
    formatted = C.format_conversations(C.chain(spark.createDataFrame(rows, schema)))
    texts = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    assert C.read_turns(texts[1]) == [(r[2], r[3]) for r in rows[: len(AWKWARD)]]
    assert C.read_turns(texts[2]) == [("assistant", "first"), ("", ""), ("", "")]
    digests = {r["conv_id"]: r for r in C.read_back(formatted).collect()}
    assert digests[1]["loss_chars"] == sum(len(t) for t in AWKWARD[1::2]) and digests[None]["n_turns"] == 1
    empty = spark.createDataFrame([], schema)
    assert C.read_back(C.format_conversations(C.chain(empty))).count() == 0
