"""SentencePiece encoding and decoding without the library: exact merge-type encoding by backtracking.

Merging repeatedly the adjacent pair of best score gives one token sequence.
The same sequence is found from left to right: take the longest vocabulary
entry (Aho-Corasick), accept it if it may stand beside the token before it,
else try its next shorter prefix, else go back one token and mark the position
as failed in a bit field, so that no position is tried twice.  Two tokens may
stand side by side if undoing their merges, latest first, never shows a pair
across the boundary that would have merged earlier.

Texts are cut where no entry of the vocabulary can reach across: before blanks
and around characters outside the vocabulary (which become bytes).  Runs of
blanks merge after everything else, from the left.  Encoded words are kept in
a bounded cache for each worker process.

Null texts count as empty: begin and end id only.  Repeated rows get equal
results; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame

from sluice.llm.common import map_rows

BLANK = "▁"
#: Encoded words that a worker keeps: this many recent ones at most, and as many before them.
CACHE = 250_000
#: Longer words are encoded each time.
LONG = 48
_CHUNK = re.compile(f"({BLANK}*)([^{BLANK}]*)")


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model; small (one entry a piece) and sent to the workers whole."""

    pieces: list[str]
    rank: list[int]  # order of merging; -1: never the result of a merge
    left: list[int]  # the pair that a piece is merged from; itself where it is a single character
    right: list[int]
    prefix: list[int]  # its longest proper prefix among the pieces, or -1
    byte_ids: list[int]
    byte_of: dict[int, int]
    silent: frozenset
    unknown: int
    begin: int
    end: int
    runs: dict[int, int]  # ids of the runs of blanks in the vocabulary, by length

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a merge-type model with byte fallback; others are refused."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        byte_of = {i: int(pieces[i][3:5], 16) for i in range(n) if model.is_byte(i)}
        silent = frozenset(i for i in range(n) if model.is_control(i))
        plain = [i for i in range(n) if i not in byte_of and i not in silent and not model.is_unknown(i) and not model.is_unused(i)]
        runs = {len(pieces[i]): i for i in plain if set(pieces[i]) == {BLANK}}
        words = [i for i in plain if len(pieces[i]) == 1 or pieces[i][0] != BLANK or pieces[i][1] != BLANK]
        if len(byte_of) != 256 or 1 not in runs or any(BLANK in pieces[i][1:] or "\n" in pieces[i] for i in words):
            raise ValueError(f"{path}: no merge-type model with byte fallback and blanks at the start of words")
        rank = [-1] * n
        for r, i in enumerate(sorted((i for i in words if len(pieces[i]) > 1), key=lambda i: -model.get_score(i))):
            rank[i] = r
        id_of = {pieces[i]: i for i in words}
        left, right, prefix = list(range(n)), list(range(n)), [-1] * n
        for i in words:
            p = pieces[i]
            prefix[i] = next((id_of[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in id_of), -1)
            if len(p) > 1:
                left[i], right[i] = _last_merge(p, id_of, rank)
        by_byte = [0] * 256
        for i, b in byte_of.items():
            by_byte[b] = i
        return cls(pieces, rank, left, right, prefix, by_byte, byte_of, silent, model.unk_id(), model.bos_id(), model.eos_id(), runs)


def _last_merge(piece: str, id_of: dict[str, int], rank: list[int]) -> tuple[int, int]:
    """The two parts that ``piece``'s own merging joins last."""
    parts = list(piece)
    while len(parts) > 2:
        ranked = [(rank[id_of[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in id_of]
        if not ranked:
            raise ValueError(f"piece {piece!r} can't be merged")
        i = min(ranked)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return id_of[parts[0]], id_of[parts[1]]


@dataclass
class Coder:
    """Encodes and decodes with a vocabulary; holds the automaton and the caches of one process."""

    vocabulary: Vocabulary
    pairs: dict[int, bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        self.automaton = ahocorasick.Automaton()
        self.id_of = {}
        for i, p in enumerate(v.pieces):
            if v.rank[i] >= 0 or (len(p) == 1 and i not in v.byte_of and i not in v.silent and i != v.unknown):
                self.automaton.add_word(p, (len(p), i))
                self.id_of[p] = i
        self.automaton.make_automaton()
        self.size = [len(p) for p in v.pieces]
        self.cache = _Words(self, {})
        spelled = [bytes([v.byte_of[i]]) if i in v.byte_of else b"" if i in v.silent else " ⁇ ".encode() if i == v.unknown else p.replace(BLANK, " ").encode() for i, p in enumerate(v.pieces)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.lengths = np.array([len(x) for x in spelled])
        self.offsets = np.cumsum(self.lengths) - self.lengths

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging can leave ``a`` and ``b`` side by side."""
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 4 * CACHE:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        v, id_of = self.vocabulary, self.id_of
        pieces, rank = v.pieces, v.rank
        limit = 1 << 30  # merges across the boundary below this rank would have come first
        while True:
            joined = id_of.get(pieces[a] + pieces[b])
            if joined is not None and rank[joined] < limit:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:  # a was merged last: on a tie, what lies left has been merged first
                limit, a = rank[a], v.right[a]
            else:
                limit, b = rank[b] + 1, v.left[b]

    def _encode_known(self, longest: list[int], start: int, end: int) -> list[int]:
        """Tokens of the characters from start to end, all in the vocabulary."""
        size, prefix, compatible = self.size, self.vocabulary.prefix, self.compatible
        failed = bytearray(end - start + 1)  # the bit field of positions from which no way leads on
        tokens: list[int] = []
        at, token = start, longest[start]
        while True:
            before = tokens[-1] if tokens else -1
            while token >= 0:
                to = at + size[token]
                if not failed[to - start] and (before < 0 or compatible(before, token)):
                    break
                token = prefix[token]
            if token >= 0:
                tokens.append(token)
                at = to
                if at == end:
                    return tokens
                token = longest[at]
            else:
                failed[at - start] = 1
                token = tokens.pop()
                at -= size[token]

    def encode_parts(self, parts: list[str]) -> list[list[int]]:
        """Tokens of each part; a part has a blank at most at its start."""
        joined = "\n".join(parts)
        longest = [-1] * len(joined)
        for last, (n, i) in self.automaton.iter(joined):
            longest[last - n + 1] = i
        out, start = [], 0
        for part in parts:
            end, tokens, at = start + len(part), [], start
            while at < end:
                if longest[at] < 0:
                    tokens += [self.vocabulary.byte_ids[b] for b in joined[at].encode()]
                    at += 1
                    continue
                stop = at
                while stop < end and longest[stop] >= 0:
                    stop += 1
                tokens += self._encode_known(longest, at, stop)
                at = stop
            out.append(tokens)
            start = end + 1
        return out

    def blanks(self, n: int) -> list[int]:
        """Tokens of ``n`` blanks that nothing else has merged with; all their merges tie, so the leftmost goes first."""
        lengths, made = self.vocabulary.runs, []
        for _ in range(n):
            made.append(1)
            while len(made) > 1 and made[-2] + made[-1] in lengths:
                made[-2:] = [made[-2] + made[-1]]
        return [lengths[k] for k in made]

    def encode(self, text: str, ends: bool = False) -> list[int]:
        """Token ids of ``text``, with begin and end id if ``ends``."""
        v, tokens = self.vocabulary, []
        chunks = [m.groups() for m in _CHUNK.finditer(BLANK + text.replace(" ", BLANK)) if m[0]] if text else []
        coded = self.encode_parts([BLANK + word for _, word in chunks])
        for (run, _), own in zip(chunks, coded, strict=True):
            alone = own[0] == v.runs[1]
            tokens += self.blanks(len(run) if alone else len(run) - 1)
            tokens += own[1:] if alone else own
        return [v.begin, *tokens, v.end] if ends else tokens

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``: bytes of invalid UTF-8 become U+FFFD each, one blank at the start goes."""
        v = self.vocabulary
        out, pending, first = [], bytearray(), True
        for i in [*ids, v.begin]:
            if i in v.byte_of:
                pending.append(v.byte_of[i])
                continue
            if pending:
                out.append(_from_bytes(bytes(pending)))
                pending.clear()
                first = False
            if i in v.silent:
                continue
            piece = " ⁇ " if i == v.unknown else v.pieces[i]
            if first and i != v.unknown and piece.startswith(BLANK):
                piece = piece[1:]
            first = False
            out.append(piece if i == v.unknown else piece.replace(BLANK, " "))
        return "".join(out)

    def decode_fast(self, ids: np.ndarray) -> str:
        """As decode, for the ids of a text that starts with a blank, as every encoded one does."""
        lengths = self.lengths[ids]
        shift = self.offsets[ids] - (np.cumsum(lengths) - lengths)
        raw = self.spelled[np.repeat(shift, lengths) + np.arange(lengths.sum())]
        try:
            return raw[1:].tobytes().decode()
        except UnicodeDecodeError:
            return self.decode(ids.tolist())

    def word(self, word: str) -> bytes:
        """Ids of a word after one blank, or right after the word before it if it starts with a line feed; packed."""
        return array("I", self.encode_parts([word if word[0] == "\n" else BLANK + word])[0]).tobytes()

    def code_all(self, texts: Iterable[str]) -> Iterator[tuple[bytes, str]]:
        """(ids with begin and end as little-endian unsigned 32-bit integers, decoded text) of each text."""
        v = self.vocabulary
        begin, end = np.array([v.begin], "<u4").tobytes(), np.array([v.end], "<u4").tobytes()
        for text in texts:
            words = text.replace(BLANK, " ").replace("\n", " \n").split(" ")
            if "" in words or max(map(len, words)) > LONG:  # runs of blanks and long words go another way
                tokens = self.encode(text, ends=True)
                yield np.array(tokens, "<u4").tobytes(), self.decode(tokens)
                continue
            if len(self.cache) >= CACHE:
                self.cache = _Words(self, dict(self.cache))
            raw = begin + b"".join(map(self.cache.__getitem__, words)) + end
            yield raw, self.decode_fast(np.frombuffer(raw, "<u4"))


class _Words(dict):
    """Ids by word; a new word is looked up in the cache before, else encoded."""

    def __init__(self, coder: Coder, old: dict[str, bytes]) -> None:
        super().__init__()
        self.coder, self.old = coder, old

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.coder.word(word)
        self[word] = ids
        return ids


def _from_bytes(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "".join("�" if "\udc80" <= c <= "\udcff" else c for c in raw.decode(errors="surrogateescape"))


_CODERS: dict[str, Coder] = {}


def coder_for(name: str, held: Broadcast) -> Coder:
    """This process's coder of the vocabulary ``name``, which is broadcast."""
    if name not in _CODERS:
        _CODERS[name] = Coder(held.value)
    return _CODERS[name]


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (begin and end id included) and the text decoded from them."""
    return _coded(docs, model, "ids array<int>, decoded string", lambda raw, text: (np.frombuffer(raw, "<u4").tolist(), text))


def encode_digests(docs: DataFrame, model: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256."""
    def digest(raw: bytes, text: str) -> tuple:
        return len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    return _coded(docs, model, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", digest)


def _coded(docs: DataFrame, model: str, schema: str, result) -> DataFrame:
    vocabulary = Vocabulary.load(model)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    name = hashlib.sha256("\n".join(vocabulary.pieces).encode()).hexdigest()

    def make(keys: list, texts: list) -> Iterator[tuple]:
        coder = coder_for(name, held)
        for key, (raw, text) in zip(keys, coder.code_all([t or "" for t in texts]), strict=True):
            yield key, *result(raw, text)

    return map_rows(docs, ["doc_id", "text"], make, f"doc_id bigint, {schema}")
