"""Benchmark decontamination by word windows.

The benchmark's normalised windows of ten words go out as a broadcast hash set
of whole windows; every document's windows are looked up in it, hits are
verified word by word, and hit words can be cut or whole documents dropped.

The broadcast is bounded: the benchmark's size is measured first, and one
beyond ``SET_BYTES`` goes out in slices of that size, one pass over the
documents each, after which the slice is destroyed and the small per-document
findings are merged.  So no executor ever holds more than one slice.  A slice
is a set of sorted arrays; README has its measured size.

Null texts and texts without words have no windows and are never hit; items
without words hit nothing; repeated items count as one id each, repeated rows
keep their rows; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_rows, ship, stored

#: Most bytes of benchmark text in one broadcast.
SET_BYTES = 16 << 20
_SEPARATORS = [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
#: Lower-cases A-Z and turns each separating byte into a blank.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in _SEPARATORS else c for c in range(256))


def item_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return (text or "").encode().translate(_TABLE).split()


#: Factors of a window's hash, one for each of its words.
_FACTORS = np.random.default_rng(20).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` word numbers from each start on."""
    out = np.zeros(len(starts), np.uint64)
    for j in range(size):
        out += ids[starts + j].astype(np.uint64) * _FACTORS[j % len(_FACTORS)] ^ np.uint64(j // len(_FACTORS))
    return out ^ (out >> np.uint64(31))


@dataclass
class Windows:
    """All windows of one length: hashes (ascending), where each begins in the text of all items, and whose it is."""

    hashes: np.ndarray
    starts: np.ndarray
    owners: np.ndarray
    firsts: np.ndarray  #: owners[firsts[i] : firsts[i + 1]] are the items of window i

    @classmethod
    def of(cls, text: np.ndarray, starts: np.ndarray, owners: np.ndarray, size: int) -> Windows:
        hashes = _hashes(text, starts, size)
        order = np.lexsort((owners, hashes))
        hashes, starts, owners = hashes[order], starts[order], owners[order]
        # neighbours with one hash are one window if all their words are the same
        same = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
        for j in range(size):
            same = same[text[starts[same] + j] == text[starts[same - 1] + j]]
        fresh = np.ones(len(hashes), bool)
        fresh[same] = False
        fresh_owner = fresh.copy()
        fresh_owner[1:] |= owners[1:] != owners[:-1]
        firsts = np.append(np.cumsum(fresh_owner)[fresh] - 1, fresh_owner.sum())
        return cls(hashes[fresh], starts[fresh], owners[fresh_owner], firsts.astype(np.int32))


@dataclass
class WindowSet:
    """Windows of the items by length, in sorted arrays: about 20 bytes a window, beside one entry a different word."""

    width: int
    items: list = field(default_factory=list)
    words: dict[bytes, int] = field(default_factory=dict)
    text: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    windows: dict[int, Windows] = field(default_factory=dict)

    @classmethod
    def of(cls, items: list[tuple], width: int) -> WindowSet:
        made = cls(width, sorted({i for i, _ in items}, key=str))
        number = {i: n for n, i in enumerate(made.items)}
        texts, starts, upto = [], defaultdict(list), 0
        for item, text in items:
            words = item_words(text)
            if not words:
                continue
            texts.append(np.fromiter((made.words.setdefault(w, len(made.words) + 1) for w in words), np.int32, len(words)))
            size = min(width, len(words))
            here = np.arange(upto, upto + len(words) - size + 1, dtype=np.int32)
            starts[size].append((here, np.full(len(here), number[item], np.int32)))
            upto += len(words)
        if texts:
            made.text = np.concatenate(texts)
        for size, parts in starts.items():
            made.windows[size] = Windows.of(made.text, np.concatenate([s for s, _ in parts]), np.concatenate([o for _, o in parts]), size)
        return made

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words lie in an occurring window, and the items whose windows occur."""
        n, items = len(words), set()
        get = self.words.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, n)
        edge = np.zeros(n + 1, np.int64)
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for size, windows in self.windows.items():
            if n < size:
                continue
            # only windows whose words all occur in the benchmark are looked up
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            hashes = _hashes(ids, starts, size)
            at = np.searchsorted(windows.hashes, hashes)
            while len(starts):
                there = at < len(windows.hashes)
                there[there] = windows.hashes[at[there]] == hashes[there]
                starts, hashes, at = starts[there], hashes[there], at[there]
                # a hash may be shared: each word is compared, and so is the next window of the same hash
                equal = np.arange(len(starts))
                for j in range(size):
                    equal = equal[self.text[windows.starts[at[equal]] + j] == ids[starts[equal] + j]]
                np.add.at(edge, starts[equal], 1)
                np.add.at(edge, starts[equal] + size, -1)
                for w in np.unique(at[equal]).tolist():
                    items.update(self.items[o] for o in windows.owners[windows.firsts[w] : windows.firsts[w + 1]].tolist())
                at = at + 1
        return np.cumsum(edge[:-1]) > 0, items


def _parts(benchmark: DataFrame, limit: int) -> int:
    """Into how many slices of about ``limit`` bytes of text the benchmark goes."""
    return max(1, -(-(benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // limit))


def _slice(benchmark: DataFrame, part: int, parts: int) -> list[tuple]:
    """The items of one slice; at most about 1/parts of the benchmark reaches the driver at a time."""
    own = benchmark.select("item_id", "text").where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
    return [(r["item_id"], r["text"]) for r in own.collect()]


def spans_of(mask: np.ndarray) -> list[dict[str, int]]:
    """The maximal runs of set words, as first word and word after the last."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return [{"first": a, "last": b} for a, b in zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist(), strict=True)]


def findings(docs: DataFrame, benchmark: DataFrame, width: int = 10, limit: int = SET_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, h (hash of the text), n_words, spans (runs of hit words), items (their ids as strings)."""
    context = docs.sparkSession.sparkContext
    schema = "doc_id bigint, h bigint, n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>"
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    slices = list(range(parts := _parts(benchmark, limit)))

    def one(held) -> DataFrame:
        def make(keys: list, texts: list, hashes: list) -> Iterator[tuple]:
            for key, text, h in zip(keys, texts, hashes, strict=True):
                words = item_words(text)
                mask, items = held.value.hits(words)
                yield key, h, len(words), spans_of(mask), sorted(str(i) for i in items)

        return map_rows(keyed, ["doc_id", "text", "h"], make, schema)

    if parts == 1:
        return one(context.broadcast(WindowSet.of(_slice(benchmark, 0, 1), width)))
    passes = []
    for p in slices:
        held = context.broadcast(WindowSet.of(_slice(benchmark, p, parts), width))
        passes.append(stored(one(held), "decontaminate"))
        held.destroy()
    rest = reduce(DataFrame.unionByName, passes).select("doc_id", "h", "spans", "items").distinct()
    merged = rest.groupBy("doc_id", "h").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
    on = [F.col("r.doc_id").eqNullSafe(F.col("m.doc_id")), F.col("r.h") == F.col("m.h")]
    return passes[0].alias("r").join(merged.alias("m"), on).select("r.doc_id", "r.h", "r.n_words", "m.spans", "m.items")


def scan(docs: DataFrame, benchmark: DataFrame, width: int = 10, limit: int = SET_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    items_sha256 digests the ids of the items with occurring windows, sorted as strings and comma-joined.
    """
    found = findings(docs, benchmark, width, limit)
    ids = F.array_sort(F.array_distinct("items"))
    # spans of several passes may overlap: each adds what reaches beyond the words counted so far
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))
    grow = lambda a, x: F.struct(F.greatest(a["upto"], x["last"]).alias("upto"), (a["n"] + F.greatest(F.lit(0).cast("long"), x["last"] - F.greatest(a["upto"], x["first"]))).alias("n"))
    n_hit = F.aggregate(F.array_sort("spans"), start, grow)["n"]
    counted = found.withColumns({"n_hit": n_hit, "n_items": F.size(ids).cast("long"), "items_sha256": F.sha2(F.array_join(ids, ",").cast("binary"), 256)})
    return counted.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def without_spans(text: str, mask: np.ndarray) -> str:
    """``text`` without its hit words and what lies between two of them; the rest stays as it is."""
    raw = text.encode()
    places = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", raw.translate(_TABLE))]
    kept, upto = [], 0
    for span in spans_of(mask):
        kept.append(raw[upto : places[span["first"]][0]])
        upto = places[span["last"] - 1][1]
    return (b"".join(kept) + raw[upto:]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, drop_share: float = 0.5, limit: int = SET_BYTES) -> DataFrame:
    """``docs`` with its columns, hit spans cut from the texts; a document of which more than ``drop_share`` is hit goes.

    Rows without hits are returned as they are.
    """
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    at, last = docs.columns.index("text"), len(docs.columns)
    schema = docs.schema
    held = spans = None
    if _parts(benchmark, limit) == 1:
        held = context.broadcast(WindowSet.of(_slice(benchmark, 0, 1), width))
    else:
        # all slices are looked up in the texts as they came; texts are cut once
        found = findings(docs, benchmark, width, limit).where(F.size("spans") > 0).select("doc_id", "h", "spans").dropDuplicates(["doc_id", "h"])
        hit = found.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.col("spans").alias("__spans"))
        on = [F.xxhash64("text") == F.col("__h"), F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))]
        docs = docs.join(hit, on, "left").select(*(F.col(f"`{c}`") for c in docs.columns), "__spans")
        spans = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column(at).to_pylist(), []
            for i, text in enumerate(texts):
                if spans:
                    mask = np.zeros(len(item_words(text)), bool)
                    for span in batch.column(last)[i].as_py() or ():
                        mask[span["first"] : span["last"]] = True
                else:
                    mask, _ = held.value.hits(item_words(text))
                keep.append(not mask.any() or mask.mean() <= drop_share)
                if mask.any():
                    texts[i] = without_spans(text, mask)
            columns = [pa.array(texts, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(last)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:last]).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
