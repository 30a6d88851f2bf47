"""The bidiagonal solver against numpy's, and whitened rows against plain linear algebra."""

import math

import numpy as np
import pytest
from feedloom.llm import bidiagonal, whitening
from feedloom.llm.queries import QUERIES
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import odd
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<double>, label int"


def flaws(matrix, count=8):
    """Errors of values, all values, orthogonality and residuals, against the greatest value."""
    values, directions = bidiagonal.leading_directions(matrix, count)
    diagonal, upper, _ = bidiagonal.bidiagonalise(matrix)
    want = np.linalg.svd(matrix)[1] ** 2
    top = max(want[0], 1e-300)
    return max(np.abs(values - want[:count]).max() / top,
               np.abs(bidiagonal.squared_singular_values(diagonal, upper) - want).max() / top,
               np.abs(directions.T @ directions - np.eye(len(values))).max(),
               np.abs(matrix.T @ (matrix @ directions) - directions * values).max() / top)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 24), st.integers(0, 10 ** 6), st.booleans(), st.booleans())
def test_solver_on_any_matrix(size, seed, graded, whole):
    pick = np.random.default_rng(seed)
    matrix = pick.standard_normal((size, size))
    if graded:
        matrix *= 10.0 ** pick.integers(-5, 5, size)
    assert flaws(np.round(matrix) if whole else matrix) < 1e-11


@pytest.mark.parametrize("values", [
    np.ones(40), np.r_[np.full(5, 3.0), np.ones(35)], np.r_[1.0, np.zeros(39)], np.zeros(40),
    1 + 1e-10 * np.arange(40), 10.0 ** -np.arange(40.0), np.repeat([4.0, 2.0, 1.0, 0.5], 10)])
def test_solver_on_clusters_and_missing_ranks(values):
    turned, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((40, 40)))
    assert flaws(np.diag(values) @ turned) < 1e-12


def test_small_values_keep_their_digits():
    diagonal, upper = np.array([1.0, 1e-9, 1e-18]), np.array([1.0, 1e-9])
    found = np.sqrt(bidiagonal.squared_singular_values(diagonal, upper))
    assert math.isclose(found.prod(), 1e-27, rel_tol=1e-13)


def plain(rows, components=8):
    """By id: exact deviation and whitened entries; shares; from the covariance itself."""
    kept = [(i, e) for i, e, *_ in rows
            if e and all(v is not None and math.isfinite(v) for v in e)]
    common = max({len(e) for _, e in kept},
                 key=lambda size: (sum(len(e) == size for _, e in kept), size))
    kept = [(i, [math.floor(1024 * v) + 100000 for v in e]) for i, e in kept if len(e) == common]
    n, totals = len(kept), [sum(column) for column in zip(*(x for _, x in kept))]
    off = [[n * v - s for v, s in zip(x, totals)] for _, x in kept]
    centred = np.array(off, dtype=np.float64) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return ([i for i, _ in kept], [sum(v * v for v in row) for row in off], centred @ vectors,
            values, values / np.trace(covariance))


def compared(spark, df, rows):
    ids, deviations, projected, values, shares = plain(rows)
    found = df.toPandas().sort_values(["component", "vec_id"], na_position="first")
    k = len(values)
    assert len(found) == len(ids) * k and set(found["n"]) == {len(ids)}
    order = np.argsort([-1 if i is None else i for i in ids], kind="stable")
    got = found["whitened"].to_numpy().reshape(k, -1).T * np.sqrt(values)
    want = projected[order]
    got *= np.sign((got * want).sum(axis=0))
    assert np.abs(got - want).max() < 1e-6 * np.abs(want).max()
    assert found["deviation"].tolist() == [deviations[n] for n in order] * k
    assert np.allclose(found["explained"].to_numpy()[::len(ids)], shares, rtol=1e-9)
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-9


def test_query_on_whole_tables(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    compared(spark, QUERIES["op11_whitened_embeddings"](spark, path), rows)


def test_vectors_of_every_awkward_kind(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 7)
    pick = np.random.default_rng(3)
    rows = [(n, [float(v) for v in pick.standard_normal(10) * 10.0 ** -np.arange(10)], 1)
            for n in range(300)]
    rows += [(1000, None, 1), (1001, [], 1), (1002, [1.0] * 9 + [None], 1), (None, [0.5] * 10, 1),
             (1003, [1.0] * 9 + [float("nan")], 1), (1004, [float("inf")] + [0.0] * 9, None),
             (1005, [1.0, 2.0], 2), (1006, [3.0] * 10, None), (1006, [3.0] * 10, 7)]
    df = spark.createDataFrame(rows, VECTORS).repartition(9)
    for name in odd.CLASHING + ["n", "r", "size", "pos", "whitened", "deviation"]:
        df = df.withColumn(name, F.lit("x"))
    compared(spark, whitening.whitened_rows(df), rows)


def test_components_without_variance_are_null(spark):
    rows = [(n, [float(n % 7), 2.0, float(n % 7)], 1) for n in range(50)]
    found = whitening.whitened_rows(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(found) == 150
    assert all((r.whitened is None) == (r.component > 1) for r in found)
    assert {round(r.explained, 9) for r in found} == {1.0, 0.0} and found[0].identity_error < 1e-9
    (one,) = whitening.whitened_rows(spark.createDataFrame([(1, [2.5], 1)], VECTORS)).collect()
    assert tuple(one) == (1, 1, 1, 0, None, None, None)


def test_great_entries_and_sums_stay_exact(spark):
    rows = [(1, [1e13, 0.0], 1), (2, [-1e13, 1.0], 1), (3, [1e300, 0.0], 1)]
    found = {r.vec_id: r for r in whitening.whitened_rows(
        spark.createDataFrame(rows, VECTORS)).where("component = 1").collect()}
    assert found[1].deviation is None and len(found) == 3
    rows = [(n, [float(n * 2 ** 16), 0.25], 1) for n in range(5)]
    off = [(5 * (n * 2 ** 26 + 100000) - 10 * 2 ** 26 - 500000) ** 2 for n in range(5)]
    found = whitening.whitened_rows(spark.createDataFrame(rows, VECTORS)).where("component = 1")
    assert [r.deviation for r in found.orderBy("vec_id").collect()] == off


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [], 1), (3, [None], 1)]):
        assert whitening.whitened_rows(spark.createDataFrame(rows, VECTORS)).collect() == []
