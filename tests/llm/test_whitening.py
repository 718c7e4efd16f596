"""Whitening against a dense eigendecomposition in numpy, and odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows):
    """(whole-number vectors, eigenvalues falling, eigenvectors, sums) of lists of floats."""
    x = np.floor(64 * np.array(rows)) + 1_000_000
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    return x, values[::-1], vectors[:, ::-1]


def check(found, rows, components=32):
    x, values, vectors = plain(list(rows.values()))
    n, sums = len(x), x.sum(axis=0)
    width = min(components, int((values > 1e-12 * values[0]).sum()))
    got = {}
    for r in found:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(rows) and all(sorted(v) == list(range(1, width + 1)) for v in got.values())
    w = np.array([[got[i][k + 1].whitened for k in range(width)] for i in rows])
    expected = (x - x.mean(axis=0)) @ vectors[:, :width] / np.sqrt(values[:width])
    assert np.abs(np.abs(w) - np.abs(expected)).max() < 1e-8
    assert np.abs(w.T @ w / n - np.eye(width)).max() < 1e-10
    for i, row in zip(rows, x, strict=True):
        assert got[i][1].n == n and got[i][1].identity_error < 1e-10
        assert got[i][1].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True))
        assert got[i][width].explained == pytest.approx(values[width - 1] / values.sum(), rel=1e-10)


@pytest.mark.parametrize(("size", "count"), [(3, 40), (48, 300), (90, 200)])
def test_whitening_equals_a_dense_decomposition(spark, size, count):
    rng = np.random.default_rng(size)
    rows = {k: v for k, v in enumerate((rng.standard_normal((count, size)) * 0.9 ** np.arange(size) * 30).tolist())}
    check(whitening.whiten(spark.createDataFrame(list(rows.items()), SCHEMA)).collect(), rows)


def test_whitening_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(whitening.whiten(table).collect(), {r.vec_id: r.embedding for r in table.collect()})


@pytest.mark.parametrize("values", [0.95 ** np.arange(150), np.repeat(np.arange(30.0, 0, -1), 5), np.ones(60), np.r_[np.ones(5), np.zeros(80)]])
def test_pairs_lock_at_double_precision(values):
    basis = np.linalg.qr(np.random.default_rng(2).standard_normal((len(values), len(values))))[0]
    held = (basis * values) @ basis.T
    found, pairs, worst = whitening.largest_pairs(lambda block: held @ block, len(values), 32)
    assert np.abs(pairs - np.sort(values)[::-1][:32]).max() < 1e-13 * values.max()
    assert worst <= 64 * np.finfo(float).eps * pairs[0]
    assert np.abs(found.T @ found - np.eye(32)).max() < 1e-13
    assert np.linalg.norm(held @ found - found * pairs, axis=0).max() < 1e-13 * pairs[0]


def test_inner_solver():
    rng = np.random.default_rng(3)
    held = rng.standard_normal((30, 30))
    held = held + held.T
    right = rng.standard_normal((30, 4))
    right[:, 2] = 0
    assert np.abs(held @ whitening.minres(lambda b: held @ b, right, 200, 1e-12) - right).max() < 1e-6


def test_odd_rows_and_tables(spark):
    good = {k: [float(k % 3), float(k * k % 7), 1.5] for k in range(9)}
    bad = [(20, None), (21, [1.0, None, 2.0]), (22, [1.0, float("nan"), 2.0]), (23, [float("inf"), 1.0, 2.0]), (24, []), (25, [1.0, 2.0])]
    table = spark.createDataFrame([*good.items(), *bad], SCHEMA).withColumns({c: F.lit("own") for c in ("x", "n", "c", "component", "d")})
    check(whitening.whiten(table).collect(), good)
    twice = table.where("vec_id < 9").union(table.where("vec_id = 3").withColumn("vec_id", F.lit(None).cast("long")))
    found = whitening.whiten(twice).collect()
    three = {r.component: r for r in found if r.vec_id == 3}
    assert {r.component: r.whitened for r in found if r.vec_id is None} == pytest.approx({k: r.whitened for k, r in three.items()})
    for none in (table.limit(0), table.where("vec_id = 1"), spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)):
        found = whitening.whiten(none)
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and found.isEmpty()


def test_deviations_are_exact_or_an_error():
    big = np.array([[2**31, 2**31], [1, 2]], np.int64)
    assert whitening.deviations(big // 2).tolist() == [2**61, 1]
    with pytest.raises(OverflowError):
        whitening.deviations(big * 2)
