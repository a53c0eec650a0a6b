"""Token ids as length-delimited binary records with an offset index.

A shard is a file of framed records.  A frame is: payload length (8 bytes,
little-endian), masked checksum of these 8 bytes, payload, masked checksum of
the payload.  Checksums are CRC-32, rotated and offset by a constant so that
the checksum of data that hold checksums stays useful.  A payload is: flags
(bit 0: the key is null; bit 1: 4-byte ids), key (8 bytes), token ids (2 or 4
bytes each).  The index is a Parquet table beside the shards: shard number,
file, key, offset, bytes, tokens.  With it, records can be read in any order;
without it, a shard can be read from its start.

Documents are range-partitioned by key, so shard after shard the file order is
the key order, nulls last and repeated keys in any order.  Each task attempt
writes a file of its own name, and only files that the index lists count: a
task that is run again after the loss of an executor leaves no half shard.
Files are written and read through Arrow's file systems, by the URI of the
shared folder.

Null texts count as empty: the record holds the end id only.  Repeated rows
give a record each; empty tables give an index without rows.
"""

from __future__ import annotations

import hashlib
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import map_rows, ship, stored
from sluice.session import scratch_dir

_HEAD = struct.Struct("<QI")
_KEY = struct.Struct("<Bq")
_MASK = 0xA282EAD8
INDEX = "shard int, file string, doc_id bigint, position bigint, offset bigint, bytes bigint, tokens bigint"
#: Chunks that a worker keeps: this many recent ones at most, and as many before them.
CACHE = 500_000
BUFFER = 4 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(key: int | None, ids: np.ndarray) -> bytes:
    """One record."""
    wide = ids.dtype.itemsize == 4
    payload = _KEY.pack((key is None) | wide << 1, key or 0) + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(head: bytes, rest: bytes) -> tuple[int | None, np.ndarray]:
    """Key and ids of a record, checked; ``head`` is its first 12 bytes, ``rest`` the others."""
    length, check = _HEAD.unpack(head)
    if masked(head[:8]) != check or len(rest) != length + 4:
        raise ValueError("record length is damaged")
    payload = rest[:-4]
    if masked(payload) != int.from_bytes(rest[-4:], "little"):
        raise ValueError("record payload is damaged")
    flags, key = _KEY.unpack_from(payload)
    return None if flags & 1 else key, np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=_KEY.size)


def read_frame(source, size: int | None = None) -> tuple[int | None, np.ndarray]:
    """The record that begins where ``source`` stands; of ``size`` bytes, if that is known."""
    head = source.read(_HEAD.size)
    length = int.from_bytes(head[:8], "little")
    if size is not None and _HEAD.size + length + 4 != size:
        raise ValueError("record and index differ")
    return unframe(head, source.read(length + 4))


def _bytes_to_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_LETTERS = _bytes_to_letters()
_TRAIL = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")


@dataclass
class ChunkEncoder:
    """Token ids by the tokenizers library, with a cache of chunks between ASCII blanks.

    Chunks are encoded one by one where that gives what the whole text gives: the tokenizer must drop white space
    and never match across it.  Texts with ``<|`` may hold special tokens and go to the library whole.  A chunk of
    Latin letters is one pre-token and goes to the library's model at once, without normalising it again.
    """

    tokenizer: object
    chunks: bool  # whether the tokenizer's settings allow the cache
    cache: _Chunks = None

    def __post_init__(self) -> None:
        self.cache = _Chunks(self, {})
        self.model = self.tokenizer.model

    @classmethod
    def of(cls, definition: str) -> ChunkEncoder:
        import json

        from tokenizers import Tokenizer

        parts = json.loads(definition)
        normal = [n.get("type") for n in (parts.get("normalizer") or {}).get("normalizers", [])]
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        allowed = (
            normal == ["NFC", "Replace", "Lowercase"]
            and parts["normalizer"]["normalizers"][1].get("pattern") == {"Regex": "\\s+"}
            and [s.get("type") for s in split] == ["Split", "ByteLevel"]
            and split[0].get("pattern") == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
            and split[0].get("behavior") == "Removed" and split[0].get("invert") is True
            and split[1].get("add_prefix_space") is False and split[1].get("use_regex") is False
            and parts["model"].get("type") == "BPE" and not parts["model"].get("dropout")
            and all(a["content"].startswith("<|") and not a["normalized"] for a in parts.get("added_tokens", []))
        )
        return cls(Tokenizer.from_str(definition), allowed)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def word(self, word: str) -> bytes | None:
        """Ids of a chunk (A-Z lower-cased) that is one run of Latin letters, as packed integers; None for other chunks."""
        if not word.isalpha() or max(word) >= "ɐ" or "İ" in word:
            return None
        if not word.isascii():
            word = word.lower()
            word = "".join(_LETTERS[b] for b in unicodedata.normalize("NFC", word).encode())
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def chunk(self, chunk: bytes) -> bytes:
        """Ids of a chunk, as packed integers."""
        text = chunk.decode()
        core = text.rstrip(_TRAIL)
        ids = self.word(core) if core else None
        if ids is None:
            return array("I", self.whole([text])[0]).tobytes()
        # letters, then a run of signs: two pre-tokens
        return ids if len(core) == len(text) else ids + self.cache[text[len(core) :].encode()]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Token ids of each text as unsigned 32-bit integers."""
        for text in texts:
            if self.chunks and "<|" not in text:
                if len(self.cache) >= CACHE:
                    self.cache = _Chunks(self, dict(self.cache))
                yield np.frombuffer(b"".join(map(self.cache.__getitem__, text.encode().lower().split())), "<u4")
            else:
                yield np.array(self.whole([text])[0], "<u4")


class _Chunks(dict):
    """Ids by chunk; a new chunk is looked up in the cache before, else encoded."""

    def __init__(self, encoder: ChunkEncoder, old: dict[bytes, bytes]) -> None:
        super().__init__()
        self.encoder, self.old = encoder, old

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.encoder.chunk(chunk)
        self[chunk] = ids
        return ids


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(definition: str) -> ChunkEncoder:
    name = hashlib.sha256(definition.encode()).hexdigest()
    if name not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[name] = ChunkEncoder.of(definition)
    return _ENCODERS[name]


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_records(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode ``docs`` and write them as shards in ``folder``; the index (columns INDEX), which is stored beside them.

    ``tokenizer`` is the path of a definition file on the driver.  ``position`` numbers a shard's records from 0.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = (folder or scratch_dir(spark, "records")).rstrip("/")
    with open(tokenizer, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, offset, position, encoder = None, 0, 0, None
        context = TaskContext.get()
        shard = context.partitionId() if context else 0
        file = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.rec"
        for batch in batches:
            if not batch.num_rows:
                continue
            encoder = encoder or _encoder(definition.value)
            if out is None:
                system, path = _open(file)
                system.create_dir(path.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(path, buffer_size=BUFFER)
            keys, rows = batch.column(0).to_pylist(), []
            for key, ids in zip(keys, encoder.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                record = frame(key, ids.astype("<u2") if ids.max() < 1 << 16 else ids.astype("<u4"))
                out.write(record)
                rows.append((shard, file, key, position, offset, len(record), len(ids)))
                offset += len(record)
                position += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), index_types, strict=True)], names=index_names)
        if out is not None:
            out.close()

    index_names = [c.split()[0] for c in INDEX.split(", ")]
    index_types = [{"int": pa.int32(), "string": pa.string(), "bigint": pa.int64()}[c.split()[1]] for c in INDEX.split(", ")]
    # The tie number spreads a key with very many rows over several shards.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("__tie", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_last(), F.col("__tie").asc()]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return stored(dealt.mapInArrow(write, INDEX), "record-index")


def read_shards(spark: SparkSession, index: DataFrame) -> DataFrame:
    """All records in file order: doc_id, start (tokens before it), n_tokens, ids_crc32, read from the shards.

    Only each shard's sums come to the driver: one row a file.
    """
    sums = index.groupBy("shard", "file").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("records")).collect()
    rows, start = [], 0
    for r in sorted(sums, key=lambda r: r["shard"]):
        rows.append((r["file"], start, r["records"]))
        start += r["tokens"]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    shards = spark.createDataFrame(rows, "file string, start bigint, records bigint").repartition(max(1, len(rows)))

    def make(files: list, starts: list, records: list) -> Iterator[tuple]:
        for file, at, n in zip(files, starts, records, strict=True):
            system, path = _open(file)
            with system.open_input_stream(path, buffer_size=BUFFER) as source:
                for _ in range(n):
                    key, ids = read_frame(source)
                    yield key, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())
                    at += len(ids)
                if source.read(1):
                    raise ValueError(f"{file} has more records than its index")

    return map_rows(shards, ["file", "start", "records"], make, schema)


def read_indexed(index: DataFrame) -> DataFrame:
    """The records that ``index`` lists, in any order and any subset: doc_id and ids."""

    def make(files: list, offsets: list, sizes: list) -> Iterator[tuple]:
        opened: tuple[str | None, object] = (None, None)
        for file, offset, size in zip(files, offsets, sizes, strict=True):
            if opened[0] != file:
                system, path = _open(file)
                opened = (file, system.open_input_file(path))
            opened[1].seek(offset)
            key, ids = read_frame(opened[1], size)
            yield key, ids.tolist()

    return map_rows(index, ["file", "offset", "bytes"], make, "doc_id bigint, ids array<bigint>")
