from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import queries
from sluice.llm import whitening as W
from tests.conftest import SF_SMALL
from tests.llm.cases import plain

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(vectors: list, most: int = 32):
    """n, sums, deviations, covariance, eigenvalues falling and vectors in rows, by numpy's own solver on exact integers."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    z = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in x], dtype=object)
    cov = np.array([[float(v) for v in row] for row in (z.T @ z)]) / float(n) ** 3
    values, turned = np.linalg.eigh(cov)
    return n, sums, [int(sum(c * c for c in row)) for row in z], cov, values[::-1][:most], turned.T[::-1][:most], z.astype(float) / n


def frame(spark, vectors, clash=True):
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in ("whitened", "component", "n", "d", "count", "i")}) if clash else df


def compare(rows, vectors, ids):
    n, _, deviation, cov, values, turned, z = slow(vectors)
    keep = values > 8 * len(cov) * np.finfo(float).eps * np.abs(cov).sum(1).max()
    values, turned = values[keep], turned[keep]
    want = z @ (turned / np.sqrt(values)[:, None]).T
    got = np.full(want.shape, np.nan)
    at = {v: i for i, v in enumerate(ids)}
    assert len(rows) == want.size
    for r in rows:
        i, c = at[r["vec_id"]], r["component"] - 1
        got[i, c] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[i]
        assert r["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
        assert 0 <= r["identity_error"] <= 1e-9
    return got, want


def test_the_query_equals_a_dense_solver(spark):
    rows = queries.QUERIES["op11_whitening"](spark, SF_SMALL).collect()
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    got, want = compare(rows, [r["embedding"] for r in table], [r["vec_id"] for r in table])
    got *= np.sign((got * want).sum(0))
    assert np.abs(got - want).max() < 1e-9


def test_bad_vectors_go_and_extra_columns_may_clash(spark):
    r = np.random.default_rng(1)
    good = [[float(c) for c in np.float32(v)] for v in r.normal(0, 3, (40, 7)) * np.arange(1, 8)]
    bad = [None, [], [1.0] * 6 + [None], [1.0] * 6 + [math.nan], [math.inf] + [0.0] * 6, [1e30] + [0.0] * 6, [1.0] * 5]
    df = frame(spark, good + bad + good[:3])
    rows = W.whiten(df, "vec_id").collect()
    ids = [*range(40), *range(47, 50)]
    got, want = compare(rows, good + good[:3], ids)
    got *= np.sign((got * want).sum(0))
    assert np.abs(got - want).max() < 1e-9


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[0.0]] * 3])
def test_without_variance_there_is_nothing_to_whiten(spark, vectors):
    out = W.whiten(frame(spark, vectors), "vec_id")
    assert plain(out) == []
    assert [c for c, _ in out.dtypes] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_vectors_than_dimensions(spark):
    vectors = [[float(c) for c in v] for v in np.random.default_rng(2).normal(0, 9, (5, 12))]
    rows = W.whiten(frame(spark, vectors), "vec_id").collect()
    assert {r["component"] for r in rows} == {1, 2, 3, 4}
    compare(rows, vectors, range(5))


def test_a_null_key_and_a_large_entry_stay_exact(spark):
    vectors = [[10_000_000.0, 1.0], [-30_000_000.0, 2.0], [5.0, 0.5], [7.0, -3.0]]
    df = frame(spark, vectors).withColumn("vec_id", F.when(F.col("vec_id") > 0, F.col("vec_id")))
    rows = W.whiten(df, "vec_id").collect()
    want = [v if v < 1 << 63 else None for v in slow(vectors)[2]]
    assert None in want and max(v or 0 for v in want) > 1 << 60
    assert {r["vec_id"]: r["deviation"] for r in rows} == dict(zip([None, 1, 2, 3], want, strict=True))


def spectrum(kind: str, d: int = 40) -> np.ndarray:
    r = np.random.default_rng(7)
    values = {
        "spread": np.geomspace(1e-3, 1e3, d), "clusters": np.repeat([1.0, 5.0, 5.0 + 1e-9, 80.0], d // 4), "equal": np.full(d, 3.0),
        "close": 10 + 1e-7 * np.arange(d), "low rank": np.r_[np.zeros(d - 6), np.arange(1.0, 7.0)],
    }[kind]
    q = np.linalg.qr(r.standard_normal((d, d)))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("kind", ["spread", "clusters", "equal", "close", "low rank"])
def test_components_of_hard_spectra(spark, kind):
    a = spectrum(kind)
    values, vectors = W.components(spark, a, 32)
    want = np.linalg.eigvalsh(a)[::-1][: 6 if kind == "low rank" else 32]
    norm = np.abs(a).sum(1).max()
    assert len(values) == len(want) and np.abs(values - want).max() < 1e-13 * norm
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(a @ vectors.T - vectors.T * values, axis=0).max() < 1e-12 * norm


def test_inertia_counts_and_intervals():
    for kind in ("spread", "clusters", "equal", "close"):
        a = spectrum(kind)
        form, want = W.tridiagonal(a), np.linalg.eigvalsh(a)
        shifts = np.concatenate([(want[1:] + want[:-1]) / 2, [want[0] - 1, want[-1] + 1]])
        clear = np.abs(shifts[:, None] - want).min(1) > 1e-12 * np.abs(want).max()
        assert (W.inertia(form, shifts) == (want[None] < shifts[:, None]).sum(1))[clear].all()
        found = W.intervals(form, -1.0, float(want[-1]) + 1)
        assert sum(n for _, _, n in found) == len(want)
        assert all(((want >= lo - 1e-12) & (want < hi + 1e-12)).sum() >= n for lo, hi, n in found)
    assert W.inertia(W.tridiagonal(np.array([[2.0]])), np.array([1.0, 3.0])).tolist() == [0, 1]
