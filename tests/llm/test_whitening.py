"""Whitening against dense linear algebra on the same whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import whitening

FOLDER = "/root/testdata/sf0.001"


def plain(vectors, components):
    """(n, sums, eigenvalues, eigenvectors, trace) of the different whole-number vectors."""
    x = {tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors}
    fit = np.array(sorted(x), np.int64)
    centred = fit - fit.mean(0)
    cov = centred.T @ centred / len(fit)
    values, turned = np.linalg.eigh(cov)
    return len(fit), fit.sum(0), values[::-1][:components], turned[:, ::-1][:, :components], np.trace(cov)


def check(rows, vectors, components=16):
    """Rows of the query against the plain version; vectors: id -> list of numbers."""
    n, sums, values, turned, trace = plain(vectors.values(), components)
    found = {}
    for r in rows:
        found.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(found) == list(range(1, components + 1))
    for k, by_id in found.items():
        assert set(by_id) == set(vectors)
        expected, got = [], []
        for i, v in vectors.items():
            r, x = by_id[i], [math.floor(64 * float(c)) + 1_000_000 for c in v]
            assert r.n == n and r.identity_error < 1e-9
            assert r.deviation == sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
            assert abs(r.explained - values[k - 1] / trace) < 1e-9
            expected.append((np.array(x) - sums / n) @ turned[:, k - 1] / math.sqrt(values[k - 1]))
            got.append(r.whitened)
        expected, got = np.array(expected), np.array(got)
        sign = 1 if expected @ got > 0 else -1
        assert np.abs(got - sign * expected).max() < 1e-6


def test_query_equals_dense_algebra(spark):
    rows = whitening.op11_jacobi_davidson(spark, FOLDER).collect()
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    vectors = {
        r.vec_id: r.embedding
        for r in table.collect()
        if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)
    }
    check(rows, vectors)


def query_on(spark, tmp_path, rows, kind="array<double>", extra=()):
    table = spark.createDataFrame(rows, f"vec_id long, embedding {kind}").repartition(3)
    for name in extra:
        table = table.withColumn(name, F.lit("x"))
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    return whitening.op11_jacobi_davidson(spark, str(tmp_path)).collect()


def test_odd_rows(spark, tmp_path):
    random = np.random.default_rng(3)
    good = {i: list(map(float, random.normal(size=6) * (1 + np.arange(6)))) for i in range(60)}
    good[60] = good[59]
    rows = [*good.items(), (100, None), (101, [None] * 6), (102, [float("nan")] * 6), (103, []),
            (104, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0])]
    found = query_on(spark, tmp_path, rows, extra=("x", "n", "whitened", "id", "block", "p"))
    check(found, good, 6)


def test_repeated_rows(spark, tmp_path):
    random = np.random.default_rng(4)
    good = {i: list(map(float, random.normal(size=4))) for i in range(30)}
    once = query_on(spark, tmp_path / "a", list(good.items()))
    thrice = query_on(spark, tmp_path / "b", list(good.items()) * 3)
    assert len(thrice) == 3 * len(once)
    check(once, good, 4)
    check(thrice, good, 4)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    assert query_on(spark, tmp_path, rows) == []


def test_components_end_with_the_rank(spark, tmp_path):
    rows = [(i, [float(i), 2.0 * i, -3.0 * i, float(i * i)]) for i in range(20)]
    found = query_on(spark, tmp_path, rows)
    assert {r.component for r in found} == {1, 2} and abs(sum({r.explained for r in found}) - 1) < 1e-12


def test_large_entries(spark, tmp_path):
    rows = [(i, [1e30 if i % 2 else -1e30, float(i)]) for i in range(10)]
    found = query_on(spark, tmp_path, rows)
    assert len(found) >= 10 and {r.deviation for r in found} == {None}


def spectrum(values, seed):
    """A symmetric map with the given eigenvalues."""
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return q * np.array(values) @ q.T


@pytest.mark.parametrize("values", [
    [1 / (i + 1) for i in range(300)],
    [100.0] * 5 + [99.0] * 5 + [1.0 + i / 500 for i in range(190)],
    [1.0 + 1e-6 * i for i in range(120)],
    [1e6, 1e3, 1.0, 1e-3] + [1e-5] * 60,
])
def test_solver_with_restarts(values):
    passes = []
    matrix = spectrum(values, len(values))

    def product(block):
        passes.append(block.shape[1])
        return matrix @ block

    found, vectors = whitening.jacobi_davidson(product, len(values), 8, max_subspace=24)
    best = np.sort(values)[::-1][:8]
    assert np.abs(found - best).max() < 1e-12 * best[0]
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * best[0]
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12
    assert max(passes) <= 12


def test_solver_finds_a_skipped_pair():
    """A start without any part of the first eigenvector."""
    matrix = np.diag([9.0, 8.0, 7.0, 6.0] + [0.1] * 40)
    hidden = np.eye(44)[:, 1:4]
    found = whitening._above(lambda b: matrix @ b, hidden, 6.0, 9.0, np.random.default_rng(0))
    assert found is not None and abs(found[0, 0]) > 0.99
