import math

import numpy as np
import pytest

from fragstat.llm import whitening
from fragstat.llm.whitening import bidiagonal, principal_directions, singular_values_squared, whiten

RNG = np.random.default_rng(7)


def triangles():
    graded = RNG.normal(size=(60, 24)) * 10.0 ** -np.linspace(0, 14, 24)
    copied = RNG.normal(size=(40, 6))
    copied[:, 3], copied[:, 5] = copied[:, 1], 0
    return {"plain": RNG.normal(size=(200, 33)), "single": RNG.normal(size=(5, 1)), "graded": graded, "copied": copied,
            "wide": RNG.normal(size=(4, 12)), "ones": np.eye(9), "equal": np.vstack([np.eye(6) * 3] * 4 + [np.ones((1, 6))]),
            "blocks": np.kron(np.eye(5), RNG.normal(size=(7, 3))), "zero": np.zeros((3, 3))}


def _triangle(x):
    return np.linalg.qr(np.vstack([x, np.zeros((x.shape[1],) * 2)]), mode="r")


@pytest.mark.parametrize("name", triangles())
def test_bidiagonal_and_dqds(name):
    r = _triangle(triangles()[name])
    diagonal, above, p = bidiagonal(r)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(p @ b.T @ b @ p.T, r.T @ r, atol=1e-12 * max(np.abs(r).max(), 1) ** 2 * len(r))
    assert np.allclose(p @ p.T, np.eye(len(p)), atol=1e-13)
    want = np.linalg.svd(r, compute_uv=False)
    got = np.sqrt(singular_values_squared(diagonal, above))
    assert np.allclose(got, want, rtol=1e-12, atol=4e-15 * max(want[0], 1e-300))


def test_dqds_is_accurate_relative_to_small_values():
    """Of a bidiagonal, even tiny singular values come out to full accuracy."""
    diagonal, above = 10.0 ** -np.arange(0.0, 30, 3), 10.0 ** -np.arange(1.0, 28, 3)
    got = np.sqrt(singular_values_squared(diagonal, above))
    assert math.isclose(float(np.prod(got / 10.0 ** -np.arange(0.0, 30, 3))), 1.0, rel_tol=1e-12)  # the determinant


@pytest.mark.parametrize("apart", [1e-2, 1e-4, 1e-6, 1e-9, 1e-12])
def test_values_that_nearly_agree(apart):
    """Triangles of very many rows without a preferred direction."""
    draw = np.random.default_rng(11)
    for size in (8, 64, 64, 64, 64):
        r = np.eye(size) + apart * np.triu(draw.normal(size=(size, size)))
        values, vectors = principal_directions(r, 4)
        want = np.linalg.svd(r, compute_uv=False)[:4] ** 2
        assert np.allclose(values, want, rtol=1e-12)
        assert np.allclose(vectors @ vectors.T, np.eye(4), atol=1e-9)
        assert np.abs(vectors @ r.T @ r - values[:, None] * vectors).max() < 1e-9


@pytest.mark.parametrize("name", triangles())
def test_directions_are_eigenvectors(name):
    x = triangles()[name]
    values, vectors = principal_directions(_triangle(x), 4)
    want = np.linalg.eigvalsh(x.T @ x)[::-1]
    rank = np.linalg.matrix_rank(x) if x.any() else 0
    assert len(values) == min(4, rank)
    assert np.allclose(values, want[:len(values)], rtol=1e-12)
    for value, vector in zip(values, vectors):
        assert np.linalg.norm(x.T @ (x @ vector) - value * vector) <= 1e-13 * values[0] * len(vector)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-11)


def rows_of(vectors):
    return [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)]


def frame(spark, vectors, partitions=3):
    return spark.createDataFrame(rows_of(vectors), "vec_id long, embedding array<float>").repartition(partitions)


def brute(vectors, components=4):
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in enumerate(vectors)}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    return {i: (n, sum((n * c - int(s)) ** 2 for c, s in zip(v, sums)),
                np.abs((np.array(v) - sums / n) @ axes[:, ::-1][:, :components] / np.sqrt(values[::-1][:components])),
                values[::-1][:components] / np.trace(cov)) for i, v in x.items()}


def check(spark, vectors, partitions=3):
    got = whiten(frame(spark, vectors, partitions)).collect()
    want = brute(vectors)
    assert len(got) == 4 * len(vectors)
    for r in got:
        n, deviation, whitened, explained = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert math.isclose(abs(r.whitened), whitened[r.component - 1], rel_tol=1e-9, abs_tol=1e-10)
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-10)
        assert r.identity_error < 1e-10


def test_against_a_dense_solver(spark):
    vectors = (RNG.normal(size=(300, 12)) * np.linspace(1, 3, 12)).tolist()
    check(spark, vectors + vectors[:40] + [vectors[5]] * 200)


def test_many_blocks_and_triangles(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "FAN", 2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        check(spark, (RNG.normal(size=(400, 7)) * np.linspace(1, 2, 7)).tolist(), partitions=7)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_unsound_rows(spark):
    good = (RNG.normal(size=(50, 5)) * np.linspace(1, 2, 5)).tolist()
    bad = [None, [], [1, 2, 3, 4, None], [1, 2, 3, 4, float("nan")], [float("inf")] * 5, [1e30] * 5, [1, 2, 3]]
    got = whiten(frame(spark, good + bad)).collect()
    assert {r.vec_id for r in got} == set(range(50)) and {r.n for r in got} == {50}


def test_few_directions(spark):
    assert whiten(frame(spark, [])).collect() == []
    assert whiten(frame(spark, [None, [float("nan")]])).collect() == []
    assert whiten(frame(spark, [[1, 2, 3]] * 9)).collect() == []
    line = whiten(frame(spark, [[1, 2], [2, 4], [3, 6]])).collect()
    assert {r.component for r in line} == {1} and all(math.isclose(r.explained, 1, rel_tol=1e-12) for r in line)


def test_deviation_beyond_a_long(spark):
    got = {r.vec_id: r.deviation for r in whiten(frame(spark, [[3e15, 0], [0, 1], [-3e15, 2]])).collect()}
    assert got[0] is None and got[1] is not None
    assert got[1] == sum((3 * c - s) ** 2 for c, s in zip((0, 256), (0, 768)))


def test_extra_columns_with_clashing_names(spark):
    rows = frame(spark, RNG.normal(size=(30, 4)).tolist())
    clashing = rows.selectExpr("*", *(f"1 AS `{c}`" for c in "x _id entry n part r component whitened place size count".split()))
    assert np.allclose(*(sorted(map(tuple, whiten(r).collect())) for r in (clashing, rows)))
    nulls = rows.selectExpr("CAST(NULL AS STRING) AS vec_id", "embedding")
    assert {r.vec_id for r in whiten(nulls).collect()} == {None}
