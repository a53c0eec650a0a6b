"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits, and embedded as the
vector of the segments' bit counts.  The Manhattan distance of two vectors
never exceeds the Hamming distance of the fingerprints, so a range join on the
vectors misses no link.  The join works on a grid: the segments are parted into
radius // 2 + 1 groups, in one of which two vectors within distance ``radius``
are at most 1 apart.  For each group a fingerprint lives in the cell of its
counts there and visits the cells in which one count is greater by one; cells
compare those who live there with each other and with their guests.  With
radius 3 a cell has 16 counts, and no cell more than one in 65536 of random
fingerprints.  Candidates pass the Manhattan bound, then the exact distance.

Counts are kept in unary (0: 00, 1: 01, 2: 11), for which the Manhattan
distance of two vectors is the bit count of their exclusive or.

Equal fingerprints are merged first, so a group of copies is one row.  A cell
is compared in blocks of bounded size, spread over tasks by salting, and gives
a spanning forest of its links instead of all pairs.

Null, empty and wordless texts have fingerprint zero and link like any other.
Repeated rows keep their rows; the smallest doc_id names a component; null
doc_ids name one only if it has no other.  Empty tables give
empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import components, map_rows, ship, stored

SEED = 42
#: Rows of a cell that one task compares with as many others; larger cells are dealt out as pairs of blocks.
BLOCK = 8192
_ODD = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash over all ``width``-word shingles of the lower-cased text, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    elif width == 3:
        shingles = map(b"%b %b %b".__mod__, zip(words, words[1:], words[2:], strict=False))
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        block = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def unary_counts(bits: np.ndarray) -> np.ndarray:
    """The vector of bit counts of the 32 two-bit segments, each count in unary."""
    low, high = bits & _ODD, (bits >> np.uint64(1)) & _ODD
    return (low | high) | ((low & high) << np.uint64(1))


def document_fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) for each row of ``docs``; fp is the fingerprint as a signed long."""

    def make(keys: list, texts: list) -> Iterator[tuple]:
        for k, t in zip(keys, texts, strict=True):
            yield k, signed(fingerprint(t, width))

    return map_rows(docs, ["doc_id", "text"], make, "doc_id bigint, fp bigint")


def linked_within(fps: np.ndarray, starts: np.ndarray, side: np.ndarray, guest: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside cells: places of pairs that make a spanning forest of each cell.

    ``fps`` is sorted by cell, ``starts`` has each row's first row of the cell.  Rows with ``side`` 1 and 2 are
    the two blocks of a large cell and are compared across only; with 0, all rows of the cell are compared.  Guests
    aren't compared with each other.
    """
    unary = unary_counts(fps)
    tree = np.arange(len(fps))
    found: list[tuple[int, int]] = []
    gap, rows = 1, np.arange(len(fps))
    while len(rows := rows[rows + gap < len(fps)]) and len(rows := rows[starts[rows + gap] == starts[rows]]):
        other = rows + gap
        near = np.bitwise_count(unary[rows] ^ unary[other]) <= radius  # the Manhattan distance bounds from below
        near &= (side[rows] == 0) | (side[rows] != side[other])
        near &= ~(guest[rows] & guest[other])
        near &= tree[rows] != tree[other]
        a, b = rows[near], other[near]
        exact = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        joined = False
        for x, y in zip(a[exact].tolist(), b[exact].tolist(), strict=True):
            p, q = x, y
            while tree[p] != p:
                p = tree[p]
            while tree[q] != q:
                q = tree[q]
            if p != q:
                tree[max(p, q)] = min(p, q)
                found.append((x, y))
                joined = True
        while joined and (flat := tree[tree]).tobytes() != tree.tobytes():
            tree = flat
        gap += 1
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _cell_batch(group: int, cell: np.ndarray, fp: np.ndarray, guest: bool) -> pa.RecordBatch:
    n = len(fp)
    data = [pa.array(np.full(n, group, np.int32)), pa.array(cell.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(np.full(n, guest))]
    return pa.RecordBatch.from_arrays(data, names=["g", "cell", "fp", "guest"])


def links(fps: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of different fingerprints that join all within ``radius`` bits, directly or over others.

    ``fps`` has the distinct fingerprints in column fp.
    """
    ship(fps.sparkSession)
    groups = radius // 2 + 1
    reach = radius // groups  # within a group: 1, or 0 with radius 0
    segments = [np.array_split(np.arange(32), groups)[g] for g in range(groups)]

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            unary = unary_counts(fp)
            for g, own in enumerate(segments):
                home = unary & np.uint64(sum(3 << (2 * int(i)) for i in own))
                yield _cell_batch(g, home, fp, False)
                for i in own.tolist() if reach else ():
                    # in unary one more is the next bit set: 00, 01, 11
                    low, high = np.uint64(1 << (2 * i)), np.uint64(2 << (2 * i))
                    may = (home & high) == 0
                    there = home[may]
                    yield _cell_batch(g, np.where(there & low, there | high, there | low), fp[may], True)

    cells = fps.select("fp").mapInArrow(to_cells, "g int, cell bigint, fp bigint, guest boolean")
    # Large cells go out as pairs of blocks: (i, i) within a block, (i, j) across.
    large = cells.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    large = stored(large.select("g", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "simhash-large")
    dealt = cells.join(large, ["g", "cell"], "left").withColumn("own", F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    turn = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))
    turns = F.when(F.col("blocks").isNull(), F.array(turn)).otherwise(F.transform(others, lambda k: F.struct(
        F.least("own", k).alias("i"), F.greatest("own", k).alias("j"), F.when(k == F.col("own"), 0).when(F.col("own") < k, 1).otherwise(2).alias("side"),
    )))
    dealt = dealt.select("g", "cell", "fp", "guest", F.explode(turns).alias("t")).select("g", "cell", "t.i", "t.j", "t.side", "fp", "guest")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell's rows are held until it ends, others go on at once."""
        rest: pa.Table | None = None

        def pairs(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("g", "cell", "i", "j")])
            fresh = np.ones(table.num_rows, bool)
            fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
            starts = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
            fp = table.column("fp").to_numpy().astype(np.int64)
            a, b = linked_within(fp.view(np.uint64), starts, table.column("side").to_numpy(), table.column("guest").to_numpy(), radius)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            last = [table.column(c)[-1] for c in ("g", "cell", "i", "j")]
            open_row = np.ones(table.num_rows, bool)
            for c, value in zip(("g", "cell", "i", "j"), last, strict=True):
                open_row &= table.column(c).to_numpy() == value.as_py()
            cut = int(np.argmax(open_row))
            if cut:
                yield pairs(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None:
            yield pairs(rest)

    keys = ["g", "cell", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a bigint, b bigint")


def _owners(first: DataFrame, radius: int) -> DataFrame:
    """``first`` (one row a fingerprint, in column fp) with the component of each fingerprint, named by one of them."""
    in_component = components(links(first, radius))
    return first.join(in_component, F.col("fp") == F.col("node"), "left").withColumn("component", F.coalesce("component", "fp")).drop("node")


def near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    rows = stored(document_fingerprints(docs, width), "simhash")
    first = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    # A component's smallest doc_id: a minimum over its fingerprints, of which there is one row each.
    owner = _owners(first, radius)
    smallest = owner.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = owner.join(smallest, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _row_key() -> Column:
    """Id and text of a row as one digest, null-safe and injective before hashing."""
    text = F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("-"))
    return F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), text), 256)


def drop_near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of the smallest doc_id (null ids last, ties by digest).

    A row is known by its id and text, not by its id alone: rows that share an id but not a text are judged apart, so
    each component keeps exactly one row, with or without ids.  All is decided on digests; texts meet one join against
    the keys that go, and only rows that repeat id and text of a row that stays are grouped.  Columns are those of ``docs``.
    """
    keyed = stored(_keyed_fingerprints(docs, width), "simhash-keys")
    rows = keyed.groupBy("key").agg(F.first("fp").alias("fp"), F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    rows = stored(rows, "simhash-rows")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("best")
    first = stored(rows.groupBy("fp").agg(best), "simhash-distinct")
    stays = _owners(first, radius).groupBy("component").agg(F.min("best").alias("best")).select("best.key")
    judged = stored(rows.join(stays.withColumn("stays", F.lit(True)), "key", "left").select("key", "n", F.coalesce("stays", F.lit(False)).alias("stays")), "simhash-judged")
    apart = judged.where("not stays or n > 1").select(F.col("key").alias("__key"))
    repeated = judged.where("stays and n > 1").select(F.col("key").alias("__key"))
    marked = docs.select("*", _row_key().alias("__key"))
    bulk = marked.join(apart, "__key", "left_anti").select(docs.columns)
    once = marked.join(repeated, "__key", "left_semi").dropDuplicates(["__key"]).select(docs.columns)
    return bulk.unionByName(once)


def _keyed_fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(key, doc_id, fp) for each row of ``docs``."""

    def make(keys: list, ids: list, texts: list) -> Iterator[tuple]:
        for k, i, t in zip(keys, ids, texts, strict=True):
            yield k, i, signed(fingerprint(t, width))

    return map_rows(docs.select(_row_key().alias("key"), "doc_id", "text"), ["key", "doc_id", "text"], make, "key string, doc_id bigint, fp bigint")
