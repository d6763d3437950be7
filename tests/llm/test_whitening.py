"""Whitening against a dense eigenvalue solver, and the bidiagonal solver against hard matrices."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellflux.llm import whitening
from cellflux.llm.queries import op11_whitening
from cellflux.llm.whitening import bidiagonal, dqds, principal, whitened

RND = np.random.default_rng(7)


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _turned(values: np.ndarray) -> np.ndarray:
    q, _ = np.linalg.qr(RND.standard_normal((len(values), len(values))))
    return _triangle((q * values) @ q.T)


def _matrices() -> dict[str, np.ndarray]:
    n = 40
    wilkinson = np.diag(np.abs(np.arange(-10, 11)).astype(float)) + np.diag(np.ones(20), 1)
    pairs = np.repeat(np.arange(n // 2, 0, -1.0), 2)
    return {
        "random": _triangle(RND.standard_normal((200, n))),
        "identity": np.eye(n),
        "orthogonal": _triangle(np.linalg.qr(RND.standard_normal((n, n)))[0]),
        "rank one": np.outer(RND.standard_normal(n), RND.standard_normal(n)),
        "rank five": _triangle(RND.standard_normal((n, 5)) @ RND.standard_normal((5, n))),
        "zero": np.zeros((6, 6)),
        "one": np.array([[-3.0]]),
        "falling": _triangle(RND.standard_normal((200, n)) * 10.0 ** -np.arange(n)),
        "rising": _triangle(RND.standard_normal((200, n)) * 10.0 ** np.arange(n)),
        "wilkinson": wilkinson,
        "pairs": _turned(pairs),
        "close pairs": _turned(pairs * (1 + 1e-9 * RND.random(n))),
        "empty columns": _triangle(RND.standard_normal((200, n)) * (np.arange(n) % 3 == 0)),
        "huge": 1e150 * _triangle(RND.standard_normal((200, n))),
        "tiny": 1e-150 * _triangle(RND.standard_normal((200, n))),
    }


@pytest.mark.parametrize("name", _matrices())
def test_solver(name):
    r = _matrices()[name]
    expected = np.linalg.svd(r, compute_uv=False)
    top = expected[0] if expected[0] else 1.0
    diagonal, above, _ = bidiagonal(r)
    assert np.abs(dqds(diagonal, above) - expected).max() <= 1e-13 * top
    values, vectors = principal(r, 16)
    assert len(values) == min(16, int((expected > len(r) * 8 * np.finfo(float).eps * top).sum()))
    scaled, sigma = r / top, values / top
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max(initial=0) < 1e-11
    assert np.abs(vectors @ scaled.T @ scaled - sigma[:, None] ** 2 * vectors).max(initial=0) < 1e-13


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12).flatmap(lambda n: st.lists(st.integers(-2, 2), min_size=n * n, max_size=n * n)))
def test_solver_on_small_whole_numbers(flat):
    r = np.triu(np.array(flat, float).reshape(math.isqrt(len(flat)), -1))
    values, vectors = principal(r, 16)
    expected = np.linalg.svd(r, compute_uv=False)
    assert np.abs(dqds(*bidiagonal(r)[:2]) - expected).max() < 1e-13 * max(expected[0], 1)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max(initial=0) < 1e-11
    assert np.abs(vectors @ r.T @ r - values[:, None] ** 2 * vectors).max(initial=0) < 1e-11


def test_small_values_keep_their_digits():
    """Relative accuracy far below the rounding of the largest value."""
    diagonal, above = np.array([1.0, 1e-8, 1e-16, 1e-24]), np.array([1e-4, 1e-12, 1e-20])
    from fractions import Fraction

    values = dqds(diagonal, above)
    product = math.prod(Fraction(x) for x in diagonal.tolist())
    assert abs(math.prod(Fraction(v) for v in values.tolist()) / product - 1) < 1e-13


def _expected(vectors: list) -> dict:
    """Per distinct vector: n, deviation, whitened by a dense solver, explained."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1], found[:, ::-1]
    keep = values[:16] > 1e-9 * max(values[0], 1e-300)
    kept = np.flatnonzero(keep)
    white = (x - sums / n) @ found[:, kept] / np.sqrt(values[kept])
    return {
        "n": n,
        "deviation": ((n * x - sums) ** 2).sum(axis=1).tolist(),
        "whitened": white,
        "explained": values[kept] / values.sum(),
    }


def _check(result, keys: list, vectors: list) -> None:
    expected = _expected(vectors)
    rows = result.toPandas()
    k = len(expected["explained"])
    assert len(rows) == len(keys) * k
    place = {key: i for i, key in enumerate(keys)}
    at = rows["vec_id"].map(place).to_numpy()
    component = rows["component"].to_numpy() - 1
    assert (rows["n"] == expected["n"]).all()
    assert rows["deviation"].tolist() == [expected["deviation"][i] for i in at]
    assert np.allclose(rows["explained"], expected["explained"][component], rtol=1e-9)
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].max() < 1e-9
    dense = np.zeros((len(keys), k))
    dense[at, component] = rows["whitened"]
    signs = np.sign((dense * expected["whitened"]).sum(axis=0))
    assert np.abs(dense * signs - expected["whitened"]).max() < 1e-8


def test_whitening_of_embeddings(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    _check(op11_whitening(spark, sf_dir), [r.vec_id for r in given], [r.embedding for r in given])


def test_many_tasks_and_small_steps(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(whitening, "_FAN", 2)
    monkeypatch.setattr(whitening, "_BLOCK", 3)
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = given.collect()
    _check(whitened(given.repartition(13)), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    base = RND.standard_normal((30, 3)).tolist()
    rows = [(i, v, "x", 1) for i, v in enumerate(base)]
    rows += [(100, base[0], None, 1), (101, base[0], "x", 1), (101, base[0], "x", 1), (None, base[1], "x", 1)]
    rows += [(200 + i, v, "x", 1) for i, v in enumerate([None, [], [1.0, None, 2.0], [nan, 0.0, 0.0], [inf, 0.0, 0.0]])]
    rows += [(300 + i, v, "x", 1) for i, v in enumerate([[1e300, 0.0, 0.0], [1.0, 2.0], [3.0, 5.0], [7.0, 7.0, 7.0, 7.0]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, length int")
    result = whitened(df)
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = result.toPandas()
    per_key = found.groupby("vec_id", dropna=False).size().to_dict()
    missing = [k for k in per_key if k != k]
    assert per_key.pop(missing[0]) == 3
    # Two vectors of length 2 have one direction, one of length 4 has none.
    assert per_key == {**{i: 3 for i in range(30)}, 100: 3, 101: 6, 301: 1, 302: 1}
    assert set(found.loc[found["vec_id"] < 102, "n"]) == {30}
    assert found.loc[found["vec_id"] > 300, "whitened"].abs().round(9).tolist() == [1.0, 1.0]


def test_large_entries_are_exact(spark):
    values = [[float(2**40), -1.0], [float(2**50), 5.0], [0.0, 0.25], [-float(2**55), 1e9]]
    df = spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<double>")
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in values]
    sums = [sum(column) for column in zip(*x, strict=True)]
    exact = [sum((4 * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    rows = whitened(df).select("vec_id", "deviation").distinct().collect()
    assert {r.vec_id: r.deviation for r in rows} == {i: v if v < 2**63 else None for i, v in enumerate(exact)}


def test_no_vectors_and_one(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
