"""Prefix trie of conversations by ROLLUP over positional turn columns.

A turn gets an id: its text's size in bytes and a digest of role and text.  A
conversation is cut into blocks of eight turns, each a row with the ids in
columns t1 to t8 and, in ``prior``, the node at which the block before it ends.
One ``GROUP BY block, prior, ROLLUP (t1, ..., t8)`` then counts all prefixes of
all blocks together; ``grouping_id`` tells a prefix's length.  A second one over
the nodes themselves sums their subtrees.

A block's ``prior`` names all turns before it.  It is found by doubling: a
block's name first stands for itself, then for two blocks, four, eight, ..., so
that a conversation of n blocks takes log2(n) joins on (conversation, block), in
which no key is hot.  Sums below a block's last node climb the same way.

The most common prefixes collapse in the partial aggregates.  Where many nodes
need a value of the one node above them, the few nodes with over a thousandth
of all rows go out as a broadcast (fewer than a thousand rows at any size), the
others by a join.

Null roles and texts count as empty, null turns come first, equal turns in the
order of role and text, repeated rows are turns of their own.  Rows without
conv_id belong to no conversation.  A conversation without turns ends at the
root.  Of an empty table there are no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ship, stored, with_rank

#: Positional turn columns of a block.
WIDTH = 8
_TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]
#: Ids in one row of text on the way to a digest.
_RUN = 256


@dataclass
class Trie:
    """``nodes``: one row a node; ``ends``: (node, conv_id), the node at which each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the turns of each conversation, numbered from 0."""
    empty = F.lit("")
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    return with_rank(rows, ["conv_id"], ["turn", "role", "text"], "place").select("conv_id", F.col("place").cast("long").alias("place"), "role", "text")


def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn) of (conv_id, place, role, text); equal turns have equal ids, which begin with the text's size."""
    body = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return turns.select("conv_id", "place", F.concat(F.octet_length("text").cast("string"), F.lit(":"), F.substring(F.sha2(body, 256), 1, 32)).alias("turn"))


def with_shared_heads(turns: DataFrame, every: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with a shared beginning: (turns, members) as ``prefix_trie`` takes them.

    Conversation c begins with the first h turns of c - c % ``every`` (all, if it has fewer; none, if it is absent) and
    goes on with its own turns from its h-th on; h is crc32 of the decimal c, modulo ``most`` + 1.
    """
    turns = stored(turns, "trie-turns")
    sizes = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    members = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), head.alias("head"))
    known = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    members = stored(members.join(known, "base", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0)))).drop("there"), "trie-members")
    heads = turns.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    given = members.where("taken > 0").join(heads, "base").where("place < taken").select("conv_id", "place", "turn")
    rest = turns.where(F.col("place") >= head)
    own = look_up(rest, "conv_id", members.select("conv_id", (F.col("head") - F.col("taken")).alias("less"))).select("conv_id", (F.col("place") - F.col("less")).alias("place"), "turn")
    return given.unionByName(own), members.select("conv_id")


def look_up(rows: DataFrame, key: str, table: DataFrame, most: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row a key; keys are not null.

    Keys with more than 1/``most`` of the rows (there are fewer than ``most`` of them, however many rows) are answered
    from a broadcast, so that none of them meets in one task.
    """
    rows = stored(rows, "trie-rows")
    least = rows.count() / most
    hot = rows.groupBy(key).count().where(F.col("count") > least).select(key)
    hot = stored(hot.join(table, key), "trie-hot")
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table, key))


def _name(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("/", *parts), 256)


def _at_block(names: DataFrame, ahead: int, alias: str) -> DataFrame:
    """``names`` keyed by the block ``ahead`` of its own."""
    return names.select("conv_id", (F.col("block") + ahead).alias("block"), F.col("name").alias(alias))


def _block_names(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(conv_id, block, name) of each full block, the name standing for all turns up to its end; and the last one's number (-1: none)."""
    names = stored(blocks.where("t8 is not null").select("conv_id", "block", _name(*_TURNS).alias("name")), "trie-names")
    last = names.agg(F.coalesce(F.max("block"), F.lit(-1))).first()[0]
    step = 1
    while step <= last:
        joined = names.where(F.col("block") >= step).join(_at_block(names, step, "before"), ["conv_id", "block"])
        longer = joined.select("conv_id", "block", _name(F.lit("blocks"), "before", "name").alias("name"))
        names = stored(names.where(F.col("block") < step).unionByName(longer), "trie-names")
        step *= 2
    return names, int(last)


def _rolled_up(rows: DataFrame, sums: str) -> DataFrame:
    """``sums`` for each prefix of the block rows, with its length in the block as ``level``."""
    columns = ", ".join(_TURNS[:-1])
    found = rows.sparkSession.sql(
        f"""select block, prior, {columns}, t8, next, grouping_id() as gid, {sums} from {{rows}}
            group by block, prior, rollup ({columns}, (t8, next))""", rows=rows)
    # the lowest bit of grouping_id is of next, which goes with t8
    found = found.withColumn("level", F.lit(WIDTH) - F.bit_count(F.shiftright("gid", 1))).drop("gid")
    # a level beyond a row's last turn repeats a shorter prefix; a later block's level 0 is the end of the block before
    own = F.get(F.array(*_TURNS), F.col("level") - 1).isNotNull()
    return found.where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(own))


def prefix_trie(turns: DataFrame, members: DataFrame) -> Trie:
    """The trie of all conversations of ``members`` (conv_id, once each), whose turns are in ``turns`` (conv_id, place, turn).

    Per node: node (its name), parent, turn (id of its last turn), conv_id (smallest member), parent_conv_id, depth,
    n_convs, n_children, n_leaves and saved (summed over its subtree: bytes of a node's last text for all members but one).
    """
    started = members.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("string").alias("turn"))
    slots = [F.max(F.when(F.col("place") % WIDTH == i, F.col("turn"))).alias(t) for i, t in enumerate(_TURNS)]
    rows = turns.unionByName(started).withColumn("block", F.floor(F.col("place") / WIDTH))
    blocks = stored(rows.groupBy("conv_id", "block").agg(*slots), "trie-blocks")
    names, last = _block_names(blocks)
    key = ["conv_id", "block"]
    rows = blocks.join(_at_block(names, 0, "next"), key, "left").join(_at_block(names, 1, "prior"), key, "left")
    rows = stored(rows.withColumn("prior", F.coalesce("prior", F.lit(""))), "trie-rows")

    node = F.coalesce("next", _name("prior", *_TURNS)).alias("node")
    later = blocks.select("conv_id", (F.col("block") - 1).alias("block")).where("block >= 0")
    ends = rows.join(later, key, "left_anti").select(node, "conv_id")

    above = F.slice(F.array(*_TURNS), 1, F.greatest(F.col("level") - 1, F.lit(0)))
    parent = F.when(F.col("level") > F.when(F.col("block") == 0, 0).otherwise(1), _name("prior", above)).when(F.col("block") > 0, F.col("prior"))
    turn = F.get(F.array(*_TURNS), F.col("level") - 1)
    nodes = _rolled_up(rows, "min(conv_id) as conv_id, count(*) as n_convs")
    nodes = stored(nodes.select("*", node, parent.alias("parent"), turn.alias("turn"), (F.col("block") * WIDTH + F.col("level")).cast("long").alias("depth")), "trie-nodes")

    below = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    size = F.coalesce(F.split_part("turn", F.lit(":"), F.lit(1)).cast("long"), F.lit(0))
    nodes = nodes.join(below, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * size), "trie-nodes")

    sums = _rolled_up(_with_later_blocks(nodes, names, last), "sum(leaves) as n_leaves, sum(saved) as saved_below").select(node, "n_leaves", "saved_below")
    out = nodes.join(sums, "node").select("node", "parent", "turn", "conv_id", "depth", "n_convs", "n_children", "n_leaves", F.col("saved_below").alias("saved"))
    out = stored(out, "trie-out")
    tops = out.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    root = out.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return Trie(root.unionByName(look_up(out.where("parent is not null"), "parent", tops)), ends)


def _with_later_blocks(nodes: DataFrame, names: DataFrame, last: int) -> DataFrame:
    """``nodes``, those at the end of a block with the leaves and savings of all blocks below them added to their own."""
    if last < 0:
        return nodes
    beneath = nodes.where("block > 0").groupBy(F.col("prior").alias("node")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    zero = F.lit(0).cast("long")
    full = nodes.where("next is not null").select("node", "conv_id", "block").join(beneath, "node", "left")
    full = stored(full.withColumns({"l": F.coalesce("l", zero), "s": F.coalesce("s", zero)}), "trie-sums")
    step = 1
    while step <= last:
        # what is known of each node goes to the one ``step`` blocks above it, found by a member conversation
        up = full.where(F.col("block") >= step).join(_at_block(names, step, "up"), ["conv_id", "block"])
        got = up.groupBy(F.col("up").alias("node")).agg(F.sum("l").alias("more_l"), F.sum("s").alias("more_s"))
        full = full.join(got, "node", "left").select("node", "conv_id", "block", (F.col("l") + F.coalesce("more_l", zero)).alias("l"), (F.col("s") + F.coalesce("more_s", zero)).alias("s"))
        full = stored(full, "trie-sums")
        step *= 2
    more = nodes.join(full.select("node", "l", "s"), "node", "left")
    return more.withColumns({"leaves": F.col("leaves") + F.coalesce("l", zero), "saved": F.col("saved") + F.coalesce("s", zero)}).drop("l", "s")


def node_turns(trie: Trie, turns: DataFrame) -> DataFrame:
    """The nodes with role and text of their last turn, from ``turns`` (conv_id, place, role, text) of the same conversations."""
    texts = turns.select("conv_id", (F.col("place") + 1).alias("depth"), "role", "text")
    return trie.nodes.join(texts, ["conv_id", "depth"], "left")


def ended_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ascending, comma-joined conv_ids of each node of ``ends``.

    Ids are joined to runs of text where range partitions hold them, so that a hot node's ids are written by many
    tasks.  A digest has to read its bytes in order, so one task reads a node's runs, a few hundred ids a row, as a stream.
    """
    ship(ends.sparkSession)

    def to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        last = None
        for batch in batches:
            rows: list[tuple] = []
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (node != last or len(held) == _RUN):
                    rows.append((last, held[0], ",".join(map(str, held))))
                    held = []
                last = node
                held.append(conv)
            if rows:
                yield _run_batch(rows)
        if held:
            yield _run_batch([(last, held[0], ",".join(map(str, held)))])

    def to_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple] = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node == last:
                    digest.update(b",")
                else:
                    if last is not None:
                        done.append((last, digest.hexdigest()))
                    last, digest = node, hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)], names=["node", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.string()), pa.array([digest.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    ends = stored(ends, "trie-ends")
    runs = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(to_runs, "node string, first bigint, ids string")
    runs = runs.repartition("node").sortWithinPartitions("node", "first")
    return runs.select("node", "ids").mapInArrow(to_digests, "node string, ends_sha256 string")


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    nodes, firsts, ids = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(firsts, pa.int64()), pa.array(ids, pa.string())], names=["node", "first", "ids"])
