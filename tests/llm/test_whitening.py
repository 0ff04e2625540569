"""Whitening of embeddings: against a plain computation with numpy's eigenvalues, and awkward rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"
FOLDER = "/root/testdata/sf0.001"


def by_hand(rows):
    """Fit list, sums and covariance of rows of whole numbers, in exact fractions."""
    fit = sorted({tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in rows})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(dims)]
    centred = [[Fraction(n * x[k] - sums[k], n) for k in range(dims)] for x in fit]
    cov = [[float(sum(c[i] * c[j] for c in centred) / n) for j in range(dims)] for i in range(dims)]
    return fit, n, sums, np.array(cov)


def vectors(seed, n, dims, spread=3.0):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dims, dims)) * np.linspace(spread, 0.05, dims)
    return (rng.normal(size=(n, dims)) @ mix).astype(np.float32).tolist()


def test_fit_and_rows_equal_a_plain_computation(spark):
    rows = vectors(1, 60, 7)
    rows += rows[:20]  # copies count once
    df = spark.createDataFrame(list(enumerate(rows)), SCHEMA).repartition(5)
    _, n, sums, cov = by_hand(rows)
    model = whitening.fit(df, components=5)
    assert (model.n, model.sums) == (n, sums)
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:5], vecs[:, ::-1][:, :5]
    assert np.allclose(model.values, values, rtol=1e-12)
    assert np.allclose(np.abs(np.sum(model.components * vecs, axis=0)), 1, atol=1e-12)
    assert model.trace == pytest.approx(np.trace(cov), rel=1e-14) and model.identity_error < 1e-12
    found = {r.vec_id: r for r in whitening.whiten(df, model).collect()}
    assert len(found) == len(rows)
    for k, row in enumerate(rows):
        x = [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in row]
        assert found[k].deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        exact = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)])
        assert np.allclose(found[k].whitened, exact @ model.components / np.sqrt(model.values), atol=1e-10)


def test_cholesky_and_jacobi_give_eigenvectors_of_graded_matrices():
    rng = np.random.default_rng(5)
    for dims in (1, 2, 5, 33):
        q, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
        c = (q * np.logspace(0, -6, dims)) @ q.T
        c = (c + c.T) / 2
        values, vecs = whitening.principal(c, dims)
        assert np.all(np.diff(values) <= 0) and np.allclose(vecs.T @ vecs, np.eye(dims), atol=1e-10)
        assert np.allclose(values, np.linalg.eigvalsh(c)[::-1], rtol=1e-8)
        assert np.allclose((vecs * values) @ vecs.T, c, atol=1e-14)


def test_components_of_no_variance_are_left_out(spark):
    rows = [[a, 2 * a, 5.0, b] for a in range(6) for b in range(3)]
    model = whitening.fit(spark.createDataFrame([(k, [float(x) for x in r]) for k, r in enumerate(rows)], SCHEMA))
    assert len(model.values) == 2 and sum(model.explained) == pytest.approx(1) and model.identity_error < 1e-12


def test_sums_stay_exact_for_entries_of_any_size(spark):
    rng = random.Random(4)
    rows = [[rng.uniform(-1, 1) * 10.0 ** rng.randrange(0, 11) for _ in range(3)] for _ in range(40)] + [[1e11, -1e11, 3.0]]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(3)
    fit = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in rows})
    n, sums = len(fit), [sum(x[k] for x in fit) for k in range(3)]
    model = whitening.fit(df)
    assert (model.n, model.sums) == (n, sums)
    cov = [[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit) / n**3 for j in range(3)] for i in range(3)]
    assert model.trace == pytest.approx(sum(cov[k][k] for k in range(3)), rel=1e-15)
    deviations = {tuple(r.embedding): r.deviation for r in whitening.whiten(df, model).join(df, "vec_id").collect()}
    for row in rows:
        exact = sum((n * (math.floor(64 * c) + 1_000_000) - s) ** 2 for c, s in zip(row, sums, strict=True))
        assert deviations[tuple(row)] == (exact if exact < 1 << 63 else None)


def test_awkward_vectors(spark):
    good = [(k, [float(k), float(k % 3), 1.0 / (k + 1)]) for k in range(12)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0])]
    rows = [*good, *good[:3], *bad, (None, [0.5, 0.5, 0.5])]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("n", "dims", "packed", "id", "deviation", "whitened", "component")})
    model = whitening.fit(df.repartition(4))
    found = whitening.whiten(df, model).collect()
    assert model.n == 13
    assert sorted((r.vec_id is None, r.vec_id) for r in found if r.vec_id is not None) == sorted((False, k) for k, _ in [*good, *good[:3]])
    assert sum(r.vec_id is None for r in found) == 1


def test_empty_and_constant_tables(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = spark.createDataFrame(rows, SCHEMA)
        model = whitening.fit(df)
        assert len(model.values) == 0 and all(len(r.whitened) == 0 for r in whitening.whiten(df, model).collect())
    assert whitening.whiten(spark.createDataFrame([], SCHEMA), whitening.fit(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_keeps_its_contract(spark):
    df = queries.QUERIES["op11_whitening"](spark, FOLDER)
    rows = df.collect()
    raw = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    _, n, sums, cov = by_hand([r.embedding for r in raw])
    assert len(rows) == 16 * len(raw) and {r.component for r in rows} == set(range(1, 17)) and {r.n for r in rows} == {n}
    values = np.linalg.eigvalsh(cov)[::-1]
    assert all(r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-10) and r.identity_error < 1e-10 for r in rows)
    kinds = dict(df.dtypes)
    assert (kinds["vec_id"], kinds["component"], kinds["n"], kinds["deviation"]) == ("bigint", "int", "bigint", "bigint")
