"""Removal of repeated passages: every byte covered by a string of WIDTH bytes that starts anywhere else too.

Texts are grouped so that equal strings meet, and within a group the transforms
of two shards are merged.  Only the merge tells different runs apart; what is
equal as a whole is settled by counting before.  Bytes are compared as 64-bit
hashes throughout.

1. Each window of WIDTH bytes has an anchor: its smallest gram of GRAM bytes by
   hash, the leftmost of equals.  Neighbouring windows with one anchor make a
   run.  Equal windows have equal anchors at equal places, so only runs of one
   anchor need comparing.  Runs go out as hashes, not as text.
2. Runs that are equal as a whole are repeated as a whole: decided by counting,
   first within each batch, so that a passage in a third of all documents
   gives one row a batch.
3. Different runs that share an anchor are put together and make two shards.
   Each shard's Burrows-Wheeler transform is built over symbols of SYMBOL
   bytes, numbered by hash; the two are merged by refining their interleave
   (``merged_transforms``), which gives common prefixes, and with these the
   intervals of places that share WIDTH bytes.
4. An anchor with more than HOT different runs would make a large group.  Its
   windows are dealt out one by one by hash and counted as in 2.

Null texts count as empty; texts below WIDTH bytes have nothing removed.
Repeated rows are copies of each other.  Documents are told apart by doc_id and
a 64-bit hash of the text, those without doc_id by two such hashes, so a doc_id
that comes twice does no harm, nor does a null one.  Empty tables give empty
results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_rows, ship, stored

WIDTH = 200
GRAM = 32
SYMBOL = 40
#: Different runs of an anchor that are merged in one group.
HOT = 2000
#: Bytes of runs that are merged at a time.
BATCH = 2 << 20
#: Bytes of a text in which anchors are looked for at a time.
BLOCK = 1 << 22
_MASK = (1 << 64) - 1
_PLACE = np.uint64(0xFFFFFF)


def _multipliers(n: int) -> list[np.uint64]:
    """Odd numbers from a fixed sequence."""
    return [np.uint64(xxhash.xxh64_intdigest(b"m%d" % i) | 1) for i in range(n)]


_BYTES = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_MULTIPLIERS = _multipliers(8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each gram of ``size`` bytes; hashes of powers of two are put together."""
    level, power, done, out = _BYTES[raw], 1, 0, None
    i = 0
    while power <= size:
        if size & power:
            part = level[done:]
            out = part if out is None else out[: len(part)] * _MULTIPLIERS[i] + part[: len(out)]
            done += power
        if power * 2 <= size:
            level = level[:-power] * _MULTIPLIERS[i] + level[power:]
        power *= 2
        i += 1
    return _mixed(out)


def runs(raw: bytes, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor of each run of ``raw``."""
    starts, counts, anchors = [], [], []
    step = BLOCK
    for base in range(0, max(0, len(raw) - width + 1), step):
        block = np.frombuffer(raw, np.uint8, min(len(raw) - base, step + width - 1), base)
        hashes = gram_hashes(block, gram)
        # the place in the low bits makes the leftmost of equals the smallest
        least, size, want = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), 1, width - gram + 1
        while size * 2 <= want:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < want:
            least = np.minimum(least[: len(least) - (want - size)], least[want - size :])
        place = (least & _PLACE).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        starts.append(first + base)
        counts.append(np.diff(np.append(first, len(place))))
        anchors.append(hashes[place[first]])
    if not starts:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64)
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(anchors)


def _stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of 32-bit keys, by halves: numpy sorts 16-bit keys by counting."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    return order[np.argsort((keys >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]


class Transform:
    """The transform of a shard of texts, over symbols of ``symbol`` bytes that start at every byte.

    A place's suffix is the symbols at it, at ``symbol`` bytes on, and so forth to the end of its text, where the
    empty suffix (symbol 0) comes first in order.  ``places`` are all places by the first ``depth`` symbols of their
    suffixes, and ``before`` the symbol that precedes each, or 0 at the start of a text.
    """

    def __init__(self, numbers: np.ndarray, room: np.ndarray, since: np.ndarray, symbol: int, depth: int) -> None:
        ends = room < symbol
        symbols = np.where(ends, np.uint32(0), numbers)
        order = np.arange(len(symbols))
        for step in range(depth - 1, -1, -1):
            at = order + step * symbol
            inside = room[order] >= (step + 1) * symbol
            order = order[_stable_order(np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], np.uint32(0)))]
        self.places = order
        self.before = np.where(since[order] >= symbol, symbols[np.maximum(order - symbol, 0)], np.uint32(0))
        self.empty = int(ends.sum())


def merged_transforms(one: Transform, two: Transform, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The merge of two transforms: the places' shards in merged order (bits), and each one's common prefix with the last.

    Holt and McMillan (2014): starting from all of the first shard before all of the second, a round reads both
    transforms in the order of the bits and deals the bits out by the symbols read, which orders them by one more
    symbol.  No suffix is compared or sorted again.  The round in which two neighbours come apart gives their common
    prefix, in symbols.  It ends at the fixed point or after ``depth`` rounds; prefixes of ``depth`` are that or more.
    """
    bits = np.concatenate([np.zeros(len(one.places), bool), np.ones(len(two.places), bool)])
    block = np.zeros(len(bits), np.uint32)
    common = np.full(len(bits), depth, np.int8)
    common[:1] = 0
    empty = np.concatenate([np.zeros(one.empty, bool), np.ones(two.empty, bool)])
    blocks = 1
    for done in range(depth):
        read = np.empty(len(bits), np.uint32)
        read[~bits], read[bits] = one.before, two.before
        kept = np.flatnonzero(read)  # what starts a text precedes nothing
        order = kept[_stable_order(read[kept])]
        symbols, old = read[order], block[order]
        bits = np.concatenate([empty, bits[order]])
        apart = np.ones(len(bits), bool)
        apart[1 : len(empty)] = False
        apart[len(empty) + 1 :] = (symbols[1:] != symbols[:-1]) | (old[1:] != old[:-1])
        common[apart & (common == depth)] = done
        block = np.cumsum(apart, dtype=np.uint32)
        if block[-1:].sum() == blocks:
            break
        blocks = block[-1:].sum()
    return bits, common


def repeated_starts(texts: list[bytes], width: int = WIDTH, symbol: int = SYMBOL) -> list[np.ndarray]:
    """Of each text, which windows of ``width`` bytes start anywhere else in ``texts`` too.

    The first and the second half of the texts are two shards, whose transforms are merged; intervals of the merged
    order with common prefixes of ``width`` bytes are repeated.  ``symbol`` divides ``width``.
    """
    sizes = np.array([len(t) + 1 for t in texts], np.int64)  # the empty suffix at the end of a text is a place, too
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)
    flags = np.zeros(len(raw), bool)
    if len(raw) > width:
        room = np.repeat(ends, sizes) - np.arange(len(raw)) - 1  # bytes up to the end of the own text
        since = np.arange(len(raw)) - np.repeat(ends - sizes, sizes)
        numbers = np.zeros(len(raw), np.uint32)
        found = np.unique(gram_hashes(raw, symbol), return_inverse=True)[1]
        numbers[: len(found)] = found + 1
        half = int(ends[np.searchsorted(ends, len(raw) // 2)])  # after a text
        depth = width // symbol
        shards = [Transform(numbers[part], room[part], since[part], symbol, depth) for part in (slice(0, half), slice(half, None))]
        bits, common = merged_transforms(*shards, depth)
        places = np.empty(len(bits), np.int64)
        places[~bits], places[bits] = shards[0].places, shards[1].places + half
        long = room[places] >= width
        same = (common >= depth) & long  # with the one before
        repeated = same.copy()
        repeated[:-1] |= same[1:] & long[:-1]
        flags[places[repeated]] = True
    return [flags[e - n : max(e - n, e - width)] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of set flags as (first, after the last)."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist(), strict=True))


ROWS = pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("doc", pa.int64()), ("h", pa.int64()), ("first", pa.int32()), ("n", pa.int32()), ("copies", pa.int32())])
ROWS_SQL = "anchor bigint, run bigint, doc bigint, h bigint, first int, n int, copies int"


def _batch_rows(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each (anchor, run) of a batch: its occurrence, or with copies = 2 any of several.

    Those several are known to be repeated: each gives a row with copies = 0, which is a span.
    """
    key = np.lexsort((columns["run"], columns["anchor"]))
    a, r = columns["anchor"][key], columns["run"][key]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    group = np.cumsum(fresh) - 1
    many = (np.bincount(group) > 1)[group] if len(key) else fresh
    copies = columns["copies"][key]
    sent = key[fresh]
    spans = key[many & (copies == 1)]
    sent_copies = np.where(many[fresh], 2, copies[fresh])
    rows = np.concatenate([sent, spans])
    out = {c: columns[c][rows] for c in ("anchor", "run", "doc", "h", "first", "n")}
    out["copies"] = np.concatenate([sent_copies, np.zeros(len(spans), np.int32)])
    return pa.RecordBatch.from_arrays([pa.array(out[f.name].astype(f.type.to_pandas_dtype())) for f in ROWS], schema=ROWS)


def _keyed(docs: DataFrame) -> DataFrame:
    """Key columns doc and h, beside the text."""
    doc, h = _key()
    return docs.select(doc.alias("doc"), h.alias("h"), F.col("text"))


def _key() -> tuple[Column, Column]:
    """What tells documents apart: doc_id and a 64-bit hash of the text; without doc_id, two such hashes."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no id"), "text")), F.xxhash64("text")


def _run_rows(docs: DataFrame, width: int) -> DataFrame:
    """ROWS of all runs of ``docs`` (doc, h, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {f.name: [] for f in ROWS}
            for doc, h, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = (text or "").encode()
                if len(raw) < width:
                    continue
                first, n, anchor = runs(raw, width)
                digest = xxhash.xxh3_64_intdigest
                found["run"].append(np.fromiter((digest(raw[s : s + k + width - 1]) for s, k in zip(first.tolist(), n.tolist(), strict=True)), np.uint64, len(first)).view(np.int64))
                found["anchor"].append(anchor.view(np.int64))
                found["first"].append(first)
                found["n"].append(n)
                for name, value in (("doc", doc), ("h", h), ("copies", 1)):
                    found[name].append(np.full(len(first), value, np.int64))
            if found["n"]:
                yield _batch_rows({k: np.concatenate(v) for k, v in found.items()})

    return docs.mapInArrow(make, ROWS_SQL)


KINDS = pa.schema([*ROWS, ("place", pa.int64()), ("contested", pa.bool_())])
KINDS_SQL = ROWS_SQL + ", place bigint, contested boolean"


def _classified(rows: DataFrame) -> DataFrame:
    """Decide runs by counting: rows that are spans (copies = 0), and one row of each run whose anchor has others.

    The latter have contested = true, copies 1 if the run occurs once, and place, their number within the anchor.
    Rows arrive sorted; besides a batch only the rows of one run are held, at most one for each batch that made them.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, place = None, None, 0
        for batch in _with_end(batches):
            if batch is None:
                table, final = held, True
            else:
                table, final = pa.Table.from_batches([batch]), False
                table = table if held is None else pa.concat_tables([held, table])
            if table is None or not table.num_rows:
                continue
            c = {name: table.column(name).to_numpy() for name in ROWS.names}
            fresh = np.ones(len(c["run"]), bool)
            fresh[1:] = (c["anchor"][1:] != c["anchor"][:-1]) | (c["run"][1:] != c["run"][:-1])
            starts = np.flatnonzero(fresh)
            upto = len(fresh) if final else int(starts[-1])
            held = None if final else table.slice(upto)
            if not upto:
                continue
            group = np.cumsum(fresh[:upto]) - 1
            total = np.bincount(group, c["copies"][:upto])
            anchors = c["anchor"][starts[: len(total)]]
            after = np.append(anchors[1:], 0) if final else np.append(anchors[1:], c["anchor"][upto])
            with_next = anchors == after
            if final:
                with_next[-1] = False
            with_last = np.concatenate([[last is not None and anchors[0] == last], anchors[1:] == anchors[:-1]])
            number = np.arange(len(anchors))
            number -= np.maximum.accumulate(np.where(with_last, 0, number))
            if with_last[0]:
                number[: int(np.argmin(with_last)) if not with_last.all() else len(number)] += place + 1
            last, place = anchors[-1], int(number[-1])
            span = (total[group] >= 2) & (c["copies"][:upto] == 1)
            contested = (with_next | with_last)[group] & fresh[:upto]
            for mask, is_contested in ((span, False), (contested, True)):
                pick = np.flatnonzero(mask)
                copies = np.where(total[group[pick]] >= 2, 2, 1) if is_contested else np.zeros(len(pick))
                data = [*(c[name][pick] for name in ROWS.names[:-1]), copies.astype(np.int32), number[group[pick]], np.full(len(pick), is_contested)]
                yield pa.RecordBatch.from_arrays([pa.array(d.astype(f.type.to_pandas_dtype())) for d, f in zip(data, KINDS, strict=True)], schema=KINDS)

    keys = ["anchor", "run"]
    return rows.repartition("anchor").sortWithinPartitions(*keys).mapInArrow(make, KINDS_SQL)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _merged(texts: DataFrame, width: int) -> DataFrame:
    """Spans (doc, h, first, n) of the contested runs ``texts`` (anchor, doc, h, first, copies, raw) that occur once."""
    schema = pa.schema([("doc", pa.int64()), ("h", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])

    def spans(table: pa.Table) -> pa.RecordBatch:
        raws = table.column("raw").to_pylist()
        docs, hs, firsts, copies = (table.column(c).to_pylist() for c in ("doc", "h", "first", "copies"))
        rows = [(docs[i], hs[i], firsts[i] + a, b - a) for i, flags in enumerate(repeated_starts(raws, width)) if copies[i] == 1 for a, b in _spans(flags)]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [()] * 4, schema, strict=True)], schema=schema)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.column(batch.schema.get_field_index("raw")).nbytes
            if size >= BATCH:  # all whole anchors so far; the last one may go on
                table = pa.concat_tables(held)
                anchors = table.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))
                if cut:
                    for part in _parts(table.slice(0, cut)):
                        yield spans(part)
                held, size = [table.slice(cut)], 0
        if held and (table := pa.concat_tables(held)).num_rows:
            for part in _parts(table):
                yield spans(part)

    return texts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(make, "doc bigint, h bigint, first int, n int")


def _parts(table: pa.Table) -> Iterator[pa.Table]:
    """Slices of about BATCH bytes that end between anchors."""
    anchors, start = table.column("anchor").to_numpy(), 0
    rows = max(1, table.num_rows * BATCH // max(1, table.nbytes))
    while start < len(anchors):
        end = int(np.searchsorted(anchors, anchors[min(start + rows, len(anchors)) - 1], side="right"))
        yield table.slice(start, end - start)
        start = end


def repeated_spans(docs: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """(doc, h, spans): of each document with repeated bytes, the windows found, as (first byte, number of starts)."""
    spark = docs.sparkSession
    ship(spark)
    keyed = _keyed(docs)
    rows = stored(_run_rows(keyed, width), "runs")
    kinds = stored(_classified(rows.where("copies > 0")), "runs-decided")
    contested = kinds.where("contested")
    large = contested.groupBy("anchor").agg((F.max("place") >= hot).alias("large")).where("large")
    wanted = contested.join(large, "anchor", "left").groupBy("doc", "h").agg(F.collect_list(F.struct("anchor", "first", "n", "copies", F.coalesce("large", F.lit(False)).alias("large"))).alias("wanted"))

    def cut(docs: list, hs: list, texts: list, lists: list) -> Iterator[tuple]:
        for doc, h, text, wanted in zip(docs, hs, texts, lists, strict=True):
            raw = text.encode()
            for w in wanted:
                yield w["anchor"], doc, h, w["first"], w["copies"], w["large"], raw[w["first"] : w["first"] + w["n"] + width - 1]

    joined = keyed.join(wanted, ["doc", "h"])
    pieces = stored(map_rows(joined, ["doc", "h", "text", "wanted"], cut, "anchor bigint, doc bigint, h bigint, first int, copies int, large boolean, raw binary"), "runs-texts")
    merged = _merged(pieces.where("not large").drop("large"), width)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {f.name: [] for f in ROWS}
            for doc, h, first, copies, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                two = np.frombuffer(raw, np.uint8)
                a = gram_hashes(two, width)
                n = len(a)
                found["anchor"].append(a.view(np.int64))
                found["run"].append(np.fromiter((xxhash.xxh3_64_intdigest(raw[i : i + width]) for i in range(n)), np.uint64, n).view(np.int64))
                found["first"].append(np.arange(first, first + n))
                for name, value in (("doc", doc), ("h", h), ("n", 1), ("copies", copies)):
                    found[name].append(np.full(n, value, np.int64))
            if found["n"]:
                yield _batch_rows({k: np.concatenate(v) for k, v in found.items()})

    single = stored(pieces.where("large").select("doc", "h", "first", "copies", "raw").mapInArrow(windows, ROWS_SQL), "runs-windows")
    counted = _classified(single.where("copies > 0")).where("not contested")
    columns = ["doc", "h", "first", "n"]
    found = [rows.where("copies = 0"), kinds.where("not contested"), merged, single.where("copies = 0"), counted]
    every = found[0].select(columns)
    for part in found[1:]:
        every = every.unionByName(part.select(columns))
    return every.groupBy("doc", "h").agg(F.collect_set(F.struct("first", "n")).alias("spans"))


def covered(size: int, spans: list, width: int = WIDTH) -> np.ndarray:
    """Which of ``size`` bytes the windows of ``spans`` cover."""
    edge = np.zeros(size + 1, np.int32)
    if spans:
        first, n = np.array([s["first"] for s in spans]), np.array([s["n"] for s in spans])
        np.add.at(edge, first, 1)
        np.add.at(edge, first + n + width - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _with_spans(docs: DataFrame, width: int, hot: int) -> DataFrame:
    """``docs`` with the column __spans; its own columns keep their names."""
    found = repeated_spans(docs, width, hot).select(F.col("doc").alias("__doc"), F.col("h").alias("__h"), F.col("spans").alias("__spans"))
    doc, h = _key()
    return docs.join(found, (doc == F.col("__doc")) & (h == F.col("__h")), "left").drop("__doc", "__h")


def removal_digests(docs: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def make(ids: list, texts: list, lists: list) -> Iterator[tuple]:
        for key, text, spans in zip(ids, texts, lists, strict=True):
            raw = (text or "").encode()
            gone = covered(len(raw), spans or [], width)
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if spans else raw
            yield key, len(raw), int(gone.sum()), len(_spans(gone)), hashlib.sha256(kept).hexdigest()

    return map_rows(_with_spans(docs.select("doc_id", "text"), width, hot), ["doc_id", "text", "__spans"], make, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(text: str, gone: np.ndarray) -> str:
    """``text`` without the characters all of whose bytes are gone: a character cut in part stays."""
    raw = text.encode()
    return b"".join(raw[a:b] for a, b in _kept_characters(raw, gone)).decode()


def _kept_characters(raw: bytes, gone: np.ndarray) -> list[tuple[int, int]]:
    data = np.frombuffer(raw, np.uint8)
    lead = (data & 0xC0) != 0x80
    character = np.cumsum(lead) - 1
    stays = np.bincount(character, ~gone) > 0
    return _spans(stays[character])


def remove_repeats(docs: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """``docs`` with its columns and rows, the repeated passages cut from the texts."""
    with_spans = _with_spans(docs, width, hot)
    at, last = with_spans.columns.index("text"), len(with_spans.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, spans in enumerate(batch.column(last).to_pylist()):
                if spans:
                    texts[i] = without_repeats(texts[i], covered(len(texts[i].encode()), spans, width))
            columns = [pa.array(texts, batch.schema.field(i).type) if i == at else batch.column(i) for i in range(last)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:last])

    return with_spans.mapInArrow(run, docs.schema)
