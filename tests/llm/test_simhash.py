from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash

from sluice.llm import simhash as S
from sluice.llm.common import components
from tests.llm.cases import awkward, frame, plain, prose


def slow_fingerprint(text: str | None) -> int:
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes: list, linked) -> dict:
    owner = {n: n for n in nodes}

    def root(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                p, q = sorted((root(a), root(b)))
                owner[q] = p
    return {n: root(n) for n in nodes}


def test_fingerprints_match_the_definition():
    for _, text, *_ in awkward():
        assert S.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("block", [S.BLOCK, 5])
def test_links_give_the_components_of_all_pairs(spark, block):
    r = random.Random(4)
    fps = {r.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for fp in list(fps):
        for _ in range(r.randint(0, 4)):
            for _ in range(r.randint(1, 5)):
                fp ^= 1 << r.randrange(64)
            fps.add(fp)
    signed = sorted(S.signed(f) for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {n: c for n, c in components(S.links(df, block=block)).collect()}
    want = slow_components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert {f: got.get(f, f) for f in signed} == want


def test_the_embedding_bounds_the_distance():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 64, (2, 500), dtype=np.uint64)
    counts = lambda x: np.stack([np.bitwise_count(x >> np.uint64(2 * i) & np.uint64(3)) for i in range(32)]).astype(int)
    manhattan = np.abs(counts(a) - counts(b)).sum(0)
    assert (np.bitwise_count(S.unary_counts(a) ^ S.unary_counts(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("radius", [0, 1, 2, 4, 6])
def test_links_of_other_radii(spark, radius):
    r = random.Random(radius)
    fps = {r.getrandbits(64) for _ in range(25)}
    for fp in list(fps):
        for _ in range(4):
            for _ in range(r.randint(1, radius + 2)):
                fp ^= 1 << r.randrange(64)
            fps.add(fp)
    signed = sorted(S.signed(f) for f in fps)
    got = dict(tuple(x) for x in components(S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius)).collect())
    assert {f: got.get(f, f) for f in signed} == slow_components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= radius)


def test_comparisons_of_a_random_fingerprint_stay_few():
    # pairs that share a cell of the grid, from 10 ** 5 to 10 ** 6 random fingerprints
    rng = np.random.default_rng(6)
    for n in (100_000, 1_000_000):
        unary = S.unary_counts(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        sizes = np.unique(unary & np.uint64(0xFFFFFFFF), return_counts=True)[1].astype(float)
        assert (sizes * (sizes - 1)).sum() / n < 1 and sizes.max() < 60


def test_near_duplicates_of_awkward_rows(spark):
    rows = plain(S.near_duplicates(frame(spark)))
    assert rows == plain(S.near_duplicates(frame(spark, clash=True)))
    texts = sorted(((i, f"{slow_fingerprint(t):016x}") for i, t, *_ in awkward()), key=repr)
    assert [r[:2] for r in rows] == texts
    fps = [int(f, 16) for _, f in texts]
    keys = list(range(len(fps)))
    roots = slow_components(keys, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    for k, (_, _, component) in enumerate(rows):
        ids = [texts[j][0] for j in keys if roots[j] == roots[k] and texts[j][0] is not None]
        assert component == (min(ids) if ids else None)
    assert plain(S.near_duplicates(frame(spark, []))) == []


def slow_kept(rows: list[tuple]) -> list[tuple]:
    """(doc_id, text) of the rows that stay: by pairs of all rows, one row of each component."""
    fps = [slow_fingerprint(r[1]) for r in rows]
    roots = slow_components(list(range(len(rows))), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    groups: dict[int, list] = {}
    for i, r in enumerate(rows):
        groups.setdefault(roots[i], []).append(r)
    key = lambda r: (r[0] is None, r[0] or 0, row_key(r))
    return [min(g, key=key)[:2] for g in groups.values()]


def row_key(r: tuple) -> str:
    return hashlib.sha256(f"{'-' if r[0] is None else r[0]}:{'-' if r[1] is None else 't' + r[1]}".encode()).hexdigest()


def test_one_row_of_each_group_stays(spark):
    extra = [(None, "same words here and there", "en", "a", 1)] * 3 + [(20, "same words here and there", "en", "a", 1)] + [(21, None, "en", "a", None)] * 2
    for rows in (awkward(), awkward() + extra, awkward()[::-1]):
        df = frame(spark, rows, clash=True)
        kept = S.drop_near_duplicates(df)
        assert kept.columns == df.columns and kept.dtypes == df.dtypes
        got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
        assert got == sorted(slow_kept(rows), key=repr)
    assert S.drop_near_duplicates(frame(spark, [])).count() == 0


def test_a_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100)], "a long, b long")
    got = dict(components(edges).collect())
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == 100


def test_a_large_group_of_near_copies(spark):
    words = prose(7, 400).split()
    rows = [(i, " ".join([*words[:-1], f"end{i}"]), "en", "a", 0) for i in range(300)]
    out = S.near_duplicates(frame(spark, rows)).collect()
    fps = {r["doc_id"]: int(r["fingerprint"], 16) for r in out}
    roots = slow_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert {r["doc_id"]: r["component_id"] for r in out} == roots
