from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import prefix_trie as P
from sluice.llm import queries
from tests.llm.cases import plain

SCHEMA = "conv_id long, turn long, role string, text string"


def slow_turns(rows: list[tuple]) -> dict[int, list[tuple]]:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}


def slow_rebuilt(turns: dict[int, list[tuple]]) -> dict[int, list[tuple]]:
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        made[c] = turns.get(base, [])[:h] + own[h:]
    return made


def slow_nodes(seqs: dict[int, list[tuple]]) -> list[tuple]:
    members, kids = defaultdict(list), defaultdict(set)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                kids[tuple(seq[: d - 1])].add(tuple(seq[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for e in range(len(path) + 1):
            leaves[path[:e]] += not kids[path]
            saved[path[:e]] += (len(convs) - 1) * (len(path[-1][1].encode()) if path else 0)
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(seqs[c]) == len(path))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(kids[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def awkward_rows() -> list[tuple]:
    r = random.Random(5)
    rows = [(None, 0, "user", "lost"), (None, None, None, None)]
    for c in range(-7, 40):
        rows += [(c, t, r.choice(["user", "assistant", None]), r.choice(["a", "b", "", None, "é🙂", "x\x00y"])) for t in range(r.choice([1, 2, 3, 8, 9, 16, 17]))]
    shared = [(t, "user", f"s{t % 3}") for t in range(75)]
    for c, n in ((50, 75), (51, 75), (52, 64), (53, 70), (56, 74), (57, 72), (61, 8)):
        rows += [(c, *t) for t in shared[:n]]
    rows += [(70, None, "user", "tie"), (70, None, "user", "tie"), (70, 1, "b", "y"), (70, 1, "a", "z"), (70, 1, None, None), (71, 3, "user", "long " * 30_000)]
    return rows


def run(spark, rows, tmp_path, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        df = df.withColumns({c: F.lit("clash") for c in ("place", "block", "prior", "next", "t1", "node", "gid", "count", "base", "__run")})
    df.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    return queries.QUERIES["op13_prefix_trie"](spark, str(tmp_path))


def test_the_query_equals_brute_force(spark, tmp_path):
    rows = awkward_rows()
    out = run(spark, rows, tmp_path, clash=True)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert plain(out) == slow_nodes(slow_rebuilt(slow_turns(rows)))


def test_an_empty_table_has_no_nodes(spark, tmp_path):
    assert plain(run(spark, [], tmp_path)) == []


@pytest.mark.parametrize("n", [7, 8, 9, 40])
def test_plain_conversations_keep_their_texts(spark, n):
    r = random.Random(n)
    rows = [(c, t, "user", r.choice("ab")) for c in range(25) for t in range(n - c % 3)]
    turns = P.placed_turns(spark.createDataFrame(rows, SCHEMA))
    ids = P.turn_ids(turns)
    members = ids.select("conv_id").distinct().union(spark.createDataFrame([(99,)], "conv_id long"))  # 99 has no turns
    trie = P.prefix_trie(ids, members)
    seqs = slow_turns(rows) | {99: []}
    got = plain(trie.nodes.join(P.ended_digests(trie.ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))))
    assert got == slow_nodes(seqs)
    texts = {(x["conv_id"], x["depth"]): x["text"] for x in P.node_turns(trie, turns).collect()}
    assert all(t == (seqs[c][d - 1][1] if d else None) for (c, d), t in texts.items())


def test_hot_keys_take_a_broadcast_and_answer_alike(spark):
    rows = spark.createDataFrame([(1, i) for i in range(3000)] + [(k, k) for k in range(2, 900)], "k long, v long")
    table = spark.createDataFrame([(k, f"n{k}") for k in range(1, 800)], "k long, name string")
    got = P.look_up(rows, "k", table)
    assert plain(got.select("k", "v", "name")) == sorted([(1, i, "n1") for i in range(3000)] + [(k, k, f"n{k}") for k in range(2, 800)], key=repr)


def test_a_node_with_many_ends_is_digested_in_order(spark):
    ends = spark.range(-700, 2000).selectExpr("if(id % 3 = 0, 'a', 'b') as node", "id as conv_id").repartition(7)
    want = {n: hashlib.sha256(",".join(str(i) for i in range(-700, 2000) if (i % 3 == 0) == (n == "a")).encode()).hexdigest() for n in "ab"}
    assert dict(tuple(r) for r in P.ended_digests(ends).collect()) == want
