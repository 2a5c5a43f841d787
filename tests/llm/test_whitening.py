"""Whitening against float64 eigenvectors and exact integer sums."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import whitening, workload

KIND = "vec_id long, embedding array<double>"


def brute(vectors):
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum((n * int(e) - int(s)) ** 2 for e, s in zip(row, total, strict=True)) for row in x]
    return n, deviation, centred @ axes / np.sqrt(values), values / values.sum()


def test_query_matches_brute_force(spark, sf_dir):
    t = pq.read_table(f"{sf_dir}/embeddings.parquet")
    rows = [(i, v) for i, v in zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True)]
    n, deviation, whitened, explained = brute([v for _, v in rows])
    at = {i: k for k, (i, _) in enumerate(rows)}
    got = workload.op11_whitening(spark, sf_dir).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    signs = {}
    for r in got:
        k, c = at[r.vec_id], r.component - 1
        assert r.deviation == deviation[k]
        assert r.explained == pytest.approx(explained[c], rel=1e-9)
        want = whitened[k, c]
        sign = signs.setdefault(c, np.sign(r.whitened * want))
        assert r.whitened * sign == pytest.approx(want, rel=1e-7, abs=1e-8)


def residual(m, values, x):
    a = np.array([[whitening.WIDE(str(int(v))) for v in row] for row in m])
    return float(np.abs(a @ x.astype(whitening.WIDE) - x * values[None, :]).max() / values[0])


@pytest.mark.parametrize("spread", [0, 1e-13, 1e-9, 1e-6, 1e-3])
def test_clustered_eigenvalues(spread):
    r = np.random.default_rng(3)
    turn, _ = np.linalg.qr(r.normal(size=(40, 40)))
    wanted = np.repeat([1000, 500, 499.999, 1], 10) * (1 + spread * r.normal(size=40))
    m = (turn * wanted) @ turn.T
    exact = np.array([[round(float(v) * 10**14) for v in row] for row in (m + m.T) / 2], object)
    values, x = whitening.eigen(exact)
    assert residual(exact, values, x) < 1e-15 and np.abs(x.T @ x - np.eye(40)).max() < 1e-14
    assert (np.diff(values) <= 0).all()


def test_refinement_beats_its_float32_start():
    r = np.random.default_rng(4)
    y = r.integers(-300, 300, (500, 16))
    m = whitening.exact_products(y)
    assert (m == y.astype(object).T @ y.astype(object)).all()
    a = m.astype(np.float64) / float(m.max())
    _, start = np.linalg.eigh(a.astype(np.float32))
    values, x = whitening.refined(a.astype(whitening.WIDE), start.astype(whitening.WIDE))
    before = np.abs(a @ start - start * np.diag(start.T @ a @ start)).max()
    assert before > 1e-8 and float(np.abs(a.astype(whitening.WIDE) @ x - x * values).max()) < 1e-17


def test_products_of_large_integers_are_exact():
    y = np.array([[1 << 41, -(1 << 41)], [3, (1 << 20) - 1], [-(1 << 19), 1 << 39]])
    assert (whitening.exact_products(y) == y.astype(object).T @ y.astype(object)).all()


def test_odd_rows(spark):
    rows = [(1, [0.5, 1.0, 2.0]), (2, [0.25, -1.0, 0.0]), (2, [0.25, -1.0, 0.0]), (None, [1.0, 1.0, 1.0]), (3, None), (4, [1.0, None, 2.0]),
            (5, [1.0, float("nan"), 2.0]), (6, [float("inf"), 0.0, 0.0]), (7, []), (8, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, KIND).withColumn("n", F.lit("x")).withColumn("whitened", F.lit(1)).repartition(3)
    got = whitening.whitened_vectors(frame).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got if r.component == 1) == [(False, 1), (False, 2), (False, 2), (True, 0)]
    assert len(got) == 12 and {r.n for r in got} == {4}
    x = [[512 + 100_000, 1024 + 100_000, 2048 + 100_000], [256 + 100_000, -1024 + 100_000, 100_000]]
    x = [x[0], x[1], x[1], [101_024] * 3]
    for r in got:
        if r.vec_id == 1:
            assert r.deviation == sum((4 * x[0][d] - sum(row[d] for row in x)) ** 2 for d in range(3))
    assert got[0].identity_error < 1e-9
    spread = [r.whitened for r in got if r.component == 1]
    assert np.mean(spread) == pytest.approx(0, abs=1e-9) and np.var(spread) == pytest.approx(1)


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_spread(spark, rows):
    got = whitening.whitened_vectors(spark.createDataFrame(rows, KIND)).collect()
    assert len(got) == 2 * len(rows)
    assert all(r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error is None for r in got)


def test_flat_direction_and_empty_table(spark):
    got = whitening.whitened_vectors(spark.createDataFrame([(1, [0.0, 1.0]), (2, [4.0, 1.0])], KIND)).collect()
    assert [r.whitened is None for r in sorted(got, key=lambda r: (r.vec_id, r.component))] == [False, True] * 2
    assert {r.explained for r in got if r.component == 1} == {1.0}
    empty = whitening.whitened_vectors(spark.createDataFrame([], KIND))
    assert empty.count() == 0 and empty.columns[-1] == "identity_error"


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 1e7])]
    got = whitening.whitened_vectors(spark.createDataFrame(rows, KIND)).collect()
    edge = 1 << 40
    x = [(edge, 0), (-edge, 0), (0, 10_240_000_000)]
    total = [sum(v[d] for v in x) for d in range(2)]
    for r in got:
        exact = sum((3 * x[r.vec_id - 1][d] - total[d]) ** 2 for d in range(2))
        assert r.deviation == (exact if exact < 1 << 63 else None)
    assert sum(r.explained for r in got) == pytest.approx(3)
