"""License scans: Aho-Corasick finds tags and notices, a shunting-yard parser evaluates licence expressions.

Two automata read every text.  One runs over its normalised words and finds
notice phrases, at all places where a phrase's words stand consecutively.  The
other runs over the lower-cased text and finds identifier tags; what follows a
tag on its line is parsed as an expression of licence ids with AND, OR, WITH
and parentheses (WITH binds first, then AND, then OR).  It ends where no more
of an expression follows; an operator without an operand is left out, and open
parentheses are closed.

An expression is evaluated to what it grants: AND needs all parts, and is as
restrictive as the most restrictive one; OR takes the least restrictive part;
WITH adds an exception, which moves a licence one class down.  A document's
``obligation`` is that of all its tags and notices together.

The score is the weight of the evidence: 1 for a tag with known ids, 0.9 for a
notice phrase, 0.5 for a tag with ids that aren't known, 0 without either.

A null text counts as empty: no words, no labels, score 0.  Repeated rows keep
their rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
from pyspark.sql import DataFrame

from sluice.llm.common import map_rows

# Classes of obligation, from the least to the most restrictive.
CLASSES = ["public-domain", "permissive", "weak-copyleft", "copyleft", "network-copyleft", "restricted"]

# Phrases that the base count is of, with their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Further notice phrases, in normalised words.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "under the mit licence": "mit",
    "apache license 2 0": "apache-2", "www apache org licenses license 2 0": "apache-2",
    "redistribution and use in source and binary forms": "bsd", "bsd 2 clause license": "bsd-2", "bsd 3 clause license": "bsd-3",
    "permission to use copy modify and or distribute this software for any purpose": "isc", "under the isc license": "isc",
    "gnu general public license version 2": "gpl-2", "gnu general public license version 3": "gpl-3",
    "gnu general public license v2": "gpl-2", "gnu general public license v3": "gpl-3",
    "gnu lesser general public license version 2 1": "lgpl-2.1", "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license version 3": "agpl-3", "gnu affero general public license": "agpl",
    "gnu lesser general public license": "lgpl", "gnu general public license": "gpl",
    "mozilla public license version 2": "mpl-2", "mozilla public license v 2 0": "mpl-2",
    "eclipse public license v2 0": "epl-2", "eclipse public license 2 0": "epl-2",
    "boost software license version 1 0": "bsl-1", "under the zlib license": "zlib", "sil open font license": "ofl",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution sharealike": "cc-by-sa", "creative commons attribution 4 0": "cc-by",
    "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by 4 0": "cc-by", "cc by 3 0": "cc-by",
    "cc0 1 0": "cc0", "released into the public domain": "public-domain", "dedicated to the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
}

# Licence ids of expressions (lower case) with their labels.
IDS = {
    "mit": "mit", "mit-0": "mit-0", "x11": "x11", "isc": "isc", "zlib": "zlib", "0bsd": "0bsd", "bsd-2-clause": "bsd-2", "bsd-3-clause": "bsd-3",
    "apache-1.1": "apache-1", "apache-2.0": "apache-2", "bsl-1.0": "bsl-1", "psf-2.0": "psf-2", "postgresql": "postgresql", "ncsa": "ncsa",
    "artistic-2.0": "artistic-2", "wtfpl": "wtfpl", "ofl-1.1": "ofl", "unlicense": "unlicense", "cc0-1.0": "cc0",
    "cc-by-3.0": "cc-by", "cc-by-4.0": "cc-by", "cc-by-sa-3.0": "cc-by-sa", "cc-by-sa-4.0": "cc-by-sa", "cc-by-nd-4.0": "cc-by-nd",
    "cc-by-nc-3.0": "cc-by-nc", "cc-by-nc-4.0": "cc-by-nc", "cc-by-nc-sa-4.0": "cc-by-nc-sa", "cc-by-nc-nd-4.0": "cc-by-nc-nd",
    "mpl-1.1": "mpl-1", "mpl-2.0": "mpl-2", "epl-1.0": "epl-1", "epl-2.0": "epl-2", "cddl-1.0": "cddl-1", "eupl-1.2": "eupl-1.2",
    "lgpl-2.0": "lgpl-2", "lgpl-2.0-only": "lgpl-2", "lgpl-2.0-or-later": "lgpl-2", "lgpl-2.1": "lgpl-2.1", "lgpl-2.1-only": "lgpl-2.1",
    "lgpl-2.1-or-later": "lgpl-2.1", "lgpl-3.0": "lgpl-3", "lgpl-3.0-only": "lgpl-3", "lgpl-3.0-or-later": "lgpl-3",
    "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2", "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3",
    "agpl-3.0": "agpl-3", "agpl-3.0-only": "agpl-3", "agpl-3.0-or-later": "agpl-3", "sspl-1.0": "sspl-1", "busl-1.1": "busl-1.1",
}

# Classes of labels that aren't permissive.
LABEL_CLASSES = {
    "cc0": "public-domain", "unlicense": "public-domain", "public-domain": "public-domain", "wtfpl": "public-domain", "0bsd": "public-domain", "mit-0": "public-domain",
    "mpl-1": "weak-copyleft", "mpl-2": "weak-copyleft", "epl-1": "weak-copyleft", "epl-2": "weak-copyleft", "cddl-1": "weak-copyleft",
    "lgpl": "weak-copyleft", "lgpl-2": "weak-copyleft", "lgpl-2.1": "weak-copyleft", "lgpl-3": "weak-copyleft",
    "gpl": "copyleft", "gpl-2": "copyleft", "gpl-3": "copyleft", "cc-by-sa": "copyleft", "eupl-1.2": "copyleft",
    "agpl": "network-copyleft", "agpl-3": "network-copyleft", "sspl-1": "network-copyleft",
    "cc-by-nc": "restricted", "cc-by-nd": "restricted", "cc-by-nc-sa": "restricted", "cc-by-nc-nd": "restricted", "busl-1.1": "restricted",
}

# Exceptions that may follow WITH.
EXCEPTIONS = ["autoconf-exception-2.0", "autoconf-exception-3.0", "bison-exception-2.2", "classpath-exception-2.0", "font-exception-2.0", "gcc-exception-2.0", "gcc-exception-3.1", "linux-syscall-note", "llvm-exception", "openssl-exception", "qt-gpl-exception-1.0", "wxwindows-exception-3.1"]

# Identifier tags, lower case; an expression follows.
TAGS = ["spdx-license-identifier:", "license-expression:", "x-license:"]

#: Label of ids that aren't known.
OTHER = "other"
_SEPARATORS = [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
#: Lower-cases A-Z and turns each separating byte into a blank.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in _SEPARATORS else c for c in range(256))
_TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+:-]*)")
_BINDS = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Grant:
    """What an expression grants: its class of obligation (a place in CLASSES) and the labels that go with it."""

    rank: int
    labels: frozenset[str]


def _either(a: Grant, b: Grant) -> Grant:
    """The less restrictive one; of two alike, the one with fewer licences, then the first by name."""
    return min(a, b, key=lambda g: (g.rank, len(g.labels), sorted(g.labels)))


def _both(a: Grant, b: Grant) -> Grant:
    return Grant(max(a.rank, b.rank), a.labels | b.labels)


def _except(a: Grant, exception: str) -> Grant:
    return Grant(max(a.rank - 1, 1) if a.rank > 1 else a.rank, frozenset(f"{x}-with-{exception}" for x in a.labels))


def label_class(label: str) -> int:
    return CLASSES.index("restricted" if label == OTHER else LABEL_CLASSES.get(label, "permissive"))


def licence(token: str) -> str | None:
    """The label of a licence id; ``+`` means a version or later; ids of a document's own are ``other``."""
    label = IDS.get(token.rstrip("+"))
    return label if label or not token.startswith(("licenseref-", "documentref-")) else OTHER


def expression_tokens(text: str, start: int = 0) -> list[str]:
    """The tokens of the expression at ``start`` of the lower-cased ``text``, well formed; empty if it has no id.

    Only the first id may be unknown: after an operator, a word that is no id ends the expression.
    """
    tokens: list[str] = []
    depth, named, at = 0, False, start
    while (m := _TOKEN.match(text, at)) is not None:
        token, at = m.group(1), m.end()
        if not tokens or tokens[-1] in ("(", "and", "or"):  # an operand has to come
            if token == "(":
                depth += 1
            elif token in (")", *_BINDS) or (named and licence(token) is None):
                break
            else:
                named = True
            tokens.append(token)
        elif token in ("and", "or"):
            tokens.append(token)
        elif token == ")" and depth:
            depth -= 1
            tokens.append(token)
        elif token == "with" and tokens[-1] != ")" and tokens[-2:-1] != ["with"]:
            after = _TOKEN.match(text, at)
            if after is None or after.group(1) not in EXCEPTIONS:
                break
            tokens += [token, after.group(1)]
            at = after.end()
        else:
            break
    while tokens and tokens[-1] in ("(", "and", "or"):
        depth -= tokens.pop() == "("
    return tokens + [")"] * depth


def evaluate(tokens: list[str]) -> Grant:
    """What a well-formed expression grants; shunting-yard: an operator waits until none that binds closer is open."""
    operands: list[Grant | str] = []
    waiting: list[str] = []

    def apply() -> None:
        op, right, left = waiting.pop(), operands.pop(), operands.pop()
        operands.append(_except(left, right) if op == "with" else _both(left, right) if op == "and" else _either(left, right))

    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                apply()
            waiting.pop()
        elif token in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[token]:
                apply()
            waiting.append(token)
        elif waiting and waiting[-1] == "with":
            operands.append(token)
        else:
            label = licence(token) or OTHER
            operands.append(Grant(label_class(label), frozenset([label])))
    while waiting:
        apply()
    return operands[0]


def mentioned(tokens: list[str]) -> list[str]:
    """All licences of an expression, chosen or not, with their exceptions."""
    labels: list[str] = []
    for i, token in enumerate(tokens):
        if i and tokens[i - 1] == "with":
            labels[-1] = f"{labels[-1]}-with-{token}"
        elif token not in ("(", ")") and token not in _BINDS:
            labels.append(licence(token) or OTHER)
    return labels


@cache
def _automaton(kind: str) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    if kind == "tags":
        for tag in TAGS:
            found.add_word(tag, len(tag))
    else:
        for base, phrases in ((True, BASE_PHRASES), (False, NOTICE_PHRASES)):
            for phrase, label in phrases.items():
                found.add_word(f" {phrase} ", (len(phrase) + 2, label, base))
    found.make_automaton()
    return found


def notices(words: list[bytes]) -> list[tuple[int, str, bool]]:
    """(word, label, base) of each place where a phrase's words stand; of other than base phrases the longest of a place."""
    text = f" {b' '.join(words).decode('latin-1')} "
    hits = [(end + 1 - size, size, label, base) for end, (size, label, base) in _automaton("phrases").iter(text)]
    longest = {}
    for start, size, _, base in hits:
        if not base:
            longest[start] = max(longest.get(start, 0), size)
    found, word, upto = [], 0, 0
    for start, size, label, base in sorted(hits):
        word += text.count(" ", upto, start)
        upto = start
        if base or size == longest[start]:
            found.append((word, label, base))
    return found


def tags(text: bytes) -> list[tuple[int, list[str]]]:
    """(byte, tokens) of each tag's expression; ``byte`` is where the tag begins."""
    line = text.lower().decode("latin-1")
    found = ((end + 1 - size, expression_tokens(line, end + 1)) for end, size in _automaton("tags").iter(line))
    return [(at, tokens) for at, tokens in found if tokens]


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, notices, tags, obligation (null: none found), score.

    ``notices`` has the phrases' places in words from 0, ``tags`` the expressions' places in bytes, all licences that an
    expression names, and those of the choice that it grants.
    """

    def make(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts, strict=True):
            raw = (text or "").encode()
            words = raw.translate(_TABLE).split()
            phrases, granted = notices(words), []
            for at, tokens in tags(raw):
                grant = evaluate(tokens)
                granted.append({"at": at, "labels": mentioned(tokens), "granted": sorted(grant.labels), "obligation": CLASSES[grant.rank], "known": OTHER not in mentioned(tokens)})
            ranks = [label_class(label) for _, label, _ in phrases] + [CLASSES.index(g["obligation"]) for g in granted]
            score = max([0.9 if phrases else 0.0] + [1.0 if g["known"] else 0.5 for g in granted])
            yield key, len(words), [{"word": w, "label": x, "base": b} for w, x, b in phrases], granted, CLASSES[max(ranks)] if ranks else None, score

    kind = dict(docs.dtypes)["doc_id"]
    return map_rows(docs, ["doc_id", "text"], make, f"doc_id {kind}, n_words bigint, notices array<struct<word:bigint,label:string,base:boolean>>, "
                    "tags array<struct<at:bigint,labels:array<string>,granted:array<string>,obligation:string,known:boolean>>, obligation string, score double")
