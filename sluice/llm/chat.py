"""Chat formatting of reply trees.

Messages name the message they reply to.  Iterative self-joins enumerate the
root-to-leaf paths: each round doubles the distance that is known, so a tree of
depth d takes log2(d) rounds, each a join on the message ids (not on the
conversation, so a large conversation spreads over all tasks).  The leaves of a
conversation are ranked by the summed score of their path, the best ones'
paths are collected by the same jumps, and each becomes one conversation text.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  In roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|`` (a line feed in a role
``\\n``), so no text can hold a control string, and reading back is exact.  The
loss mask has the spans of the assistant's texts, in code points.

Null roles and texts count as empty.  A message without parent, or whose parent
is missing, starts a tree; messages that lead into a cycle belong to no path.
Of rows that repeat a message id the smallest counts.  Ties of score go to the
deeper leaf, then to the smaller id.  Null conversation ids are one
conversation.  Empty tables give empty results.  A conversation's text is one
value, so its chosen turns meet in one task; nothing else does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import map_rows, stored, with_rank

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def format_turns(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text, and the spans (start, end) that are trained on."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = START + escape(role or "").replace("\n", "\\n") + "\n"
        body = escape(text or "")
        parts += [head, body, END]
        if role == TRAINED:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no formatted conversation: character {at}")
    return turns


def chain(conversations: DataFrame) -> DataFrame:
    """Plain conversations (conv_id, turn, role, text) as messages: each turn replies to the one before it.

    Turns are ordered by turn, then role and text; nulls come first.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    ranked = with_rank(rows, ["conv_id"], ["turn", "role", "text"], "message_id")
    parent = F.when(F.col("message_id") > 0, F.col("message_id") - 1)
    return ranked.select("conv_id", "message_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def _tree(messages: DataFrame) -> DataFrame:
    """Messages by id: conv_id, message_id, m (parent_id, score, role, text of the smallest row), leaf (nothing replies to it)."""
    own = messages.where("message_id is not null").select(
        "conv_id", "message_id", F.struct("parent_id", F.coalesce("score", F.lit(0.0)).alias("score"), "role", "text").alias("m"), F.lit(False).alias("replied"))
    replied = messages.where("message_id is not null and parent_id is not null").select(
        "conv_id", F.col("parent_id").alias("message_id"), F.lit(None).cast(own.schema["m"].dataType).alias("m"), F.lit(True).alias("replied"))
    both = own.unionByName(replied).groupBy("conv_id", "message_id").agg(F.min("m").alias("m"), (~F.max("replied")).alias("leaf"))
    return stored(both.where("m is not null"), "chat")


def _same(a: str, ka: str, b: str, kb: str) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.{ka}") == F.col(f"{b}.{kb}"))


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(conv_id, rank, leaf_id, depth, message_id): the ``best`` root-to-leaf paths of each conversation, turn by turn.

    ``messages`` has conv_id, message_id, parent_id, score, role and text; depth counts from 0 at the root.
    """
    return _paths(_tree(messages), best)


def _paths(tree: DataFrame, best: int) -> DataFrame:
    # Of each message: jump, its ancestor 2 ** round steps up; nodes and total: how many there are from the message
    # to before jump, and their scores.  Messages whose jump lies beyond the root are finished and only looked up.
    start = tree.select("conv_id", "message_id", F.col("m.parent_id").alias("jump"), F.lit(1).cast("long").alias("nodes"), F.col("m.score").alias("total"), "leaf")
    finished, going = start.where("jump is null"), start.where("jump is not null")
    jumps, rounds = [], max(1, tree.count()).bit_length() + 1
    while len(jumps) < rounds:
        a, b = going.alias("a"), finished.unionByName(going).alias("b")
        step = stored(a.join(b, _same("a", "jump", "b", "message_id"), "left").select(
            "a.conv_id", "a.message_id", F.when(F.col("b.nodes").isNotNull(), F.col("a.jump")).alias("passed"), F.col("b.jump").alias("jump"),
            (F.col("a.nodes") + F.coalesce("b.nodes", F.lit(0))).alias("nodes"), (F.col("a.total") + F.coalesce("b.total", F.lit(0.0))).alias("total"), "a.leaf"), "chat")
        jumps.append(step.where("passed is not null").select("conv_id", "message_id", F.col("passed").alias("up")))
        step = step.drop("passed")
        finished, going = finished.unionByName(step.where("jump is null")), step.where("jump is not null")
        if going.isEmpty():
            break
    order = Window.partitionBy("conv_id").orderBy(F.desc("total"), F.desc("nodes"), F.asc("message_id"))
    chosen = finished.where("leaf").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    taken = chosen.select("conv_id", "rank", F.col("message_id").alias("leaf_id"), (F.col("nodes") - 1).alias("depth"), "message_id")
    # every distance is one sum of falling powers of two, so each ancestor is reached once
    for r in range(len(jumps) - 1, -1, -1):
        pair = F.array(F.struct("p.depth", "p.message_id"), F.struct((F.col("p.depth") - (1 << r)).alias("depth"), F.col("j.up").alias("message_id")))
        both = F.when(F.col("j.up").isNull(), F.slice(pair, 1, 1)).otherwise(pair)
        taken = taken.alias("p").join(jumps[r].alias("j"), _same("p", "message_id", "j", "message_id"), "left").select(
            "p.conv_id", "p.rank", "p.leaf_id", F.explode(both).alias("e")).select("conv_id", "rank", "leaf_id", "e.depth", "e.message_id")
    return stored(taken, "chat")


def format_conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """(conv_id, rank, formatted, loss_spans) of the ``best`` paths of each conversation."""
    tree = _tree(messages)
    p, t = _paths(tree, best).alias("p"), tree.alias("t")
    rows = p.join(t, _same("p", "message_id", "t", "message_id")).select("p.conv_id", "p.rank", "p.depth", "t.m.role", "t.m.text")
    whole = rows.groupBy("conv_id", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))

    def make(ids: list, ranks: list, lists: list) -> Iterator[tuple]:
        for conv, rank, turns in zip(ids, ranks, lists, strict=True):
            text, spans = format_turns([(t["role"], t["text"]) for t in turns])
            yield conv, rank, text, [{"start": a, "end": b} for a, b in spans]

    kind = dict(messages.dtypes)["conv_id"]
    return map_rows(whole, ["conv_id", "rank", "turns"], make, f"conv_id {kind}, rank int, formatted string, loss_spans array<struct<start:bigint,end:bigint>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from their text and mask alone."""

    def make(ids: list, texts: list, masks: list) -> Iterator[tuple]:
        for conv, text, mask in zip(ids, texts, masks, strict=True):
            turns = read_turns(text)
            trained = "".join(unescape(text[s["start"] : s["end"]]) for s in mask)
            digest = hashlib.sha256("".join(f"{role}\n{body}\n" for role, body in turns).encode()).hexdigest()
            yield conv, len(turns), digest, len(trained), hashlib.sha256(trained.encode()).hexdigest(), len(text)

    kind = dict(formatted.dtypes)["conv_id"]
    return map_rows(formatted, ["conv_id", "formatted", "loss_spans"], make, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
