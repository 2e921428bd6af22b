import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import whitening
from quire.llm.whitening import Centre, jacobi_davidson, minres

SCHEMA = "vec_id long, embedding array<float>, label int"


def fixed(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def brute(vectors):
    """(n, sums, mean, values, eigenvectors, trace) of the distinct fixed-point vectors."""
    x = np.array(sorted({tuple(fixed(v)) for v in vectors}), dtype=np.int64)
    z = x - x.sum(0) / len(x)
    e, u = np.linalg.eigh(z.T @ z / len(x))
    return len(x), x.sum(0), x.sum(0) / len(x), e[::-1], u[:, ::-1], np.trace(z.T @ z) / len(x)


def test_minres_solves_side_by_side():
    rng = np.random.default_rng(1)
    mats = [(m + m.T) / 2 for m in rng.standard_normal((4, 12, 12))]      # indefinite
    rhs = rng.standard_normal((12, 4))
    rhs[:, 2] = 0
    x = minres(lambda y, k: np.stack([mats[j] @ y[:, i] for i, j in enumerate(k)], 1), rhs, 40, 1e-13)
    for j, m in enumerate(mats):
        assert np.allclose(m @ x[:, j], rhs[:, j], atol=1e-8)
    assert not x[:, 2].any()


@pytest.mark.parametrize("dims,n,kind", [(64, 3000, "even"), (64, 20, "even"), (200, 900, "even"), (200, 900, "falling"),
                                         (96, 700, "twice"), (1, 9, "even"), (5, 40, "even")])
def test_jacobi_davidson(dims, n, kind):
    rng = np.random.default_rng(dims + n)
    x = np.floor(rng.standard_normal((n, dims)) * (100 / (1 + np.arange(dims)) if kind == "falling" else 8))
    if kind == "twice":                              # double eigenvalues
        half = dims // 2
        x = np.vstack([np.hstack([x[:, :half], 0 * x[:, :half]]), np.hstack([0 * x[:, :half], x[:, :half]])])
    z = x - x.mean(0)
    v = z.T @ z / len(z)
    widths = []

    def product(block):
        widths.append(block.shape[1])
        return z.T @ (z @ block) / len(z)
    e, u = jacobi_davidson(product, dims, 16)
    true = np.linalg.eigvalsh(v)[::-1][:16]
    assert len(e) == min(16, dims) and np.abs(e - true).max() <= 1e-13 * true[0]
    assert np.linalg.norm(v @ u - u * e, axis=0).max() <= 3e-14 * true[0]
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13
    # matrix-free: blocks of a few vectors, never one of all dimensions
    assert dims <= 32 or max(widths) <= 32


def test_no_convergence_is_an_error(monkeypatch):
    monkeypatch.setattr(whitening, "ROUNDS", 1)
    d = np.arange(1.0, 301)
    with pytest.raises(ArithmeticError):
        jacobi_davidson(lambda b: b * d[:, None], 300, 16)


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)


def result(docs, **params):
    model = whitening.fit(docs, **params)
    return model, whitening.components(whitening.whiten(docs, model), model).select("_row.vec_id", "*").collect()


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    good = [rng.standard_normal(24).astype(np.float32).tolist() for _ in range(400)]
    nan, inf = [float("nan")] + [0.0] * 23, [0.0] * 23 + [float("-inf")]
    vectors = good + [good[0]] * 200 + [None, nan, inf, [None] * 24, [], [1.0], [0.0] * 23 + [2e30]]
    model, rows = result(table(spark, vectors).repartition(5))
    n, sums, mean, e, u, trace = brute(good)
    assert model.centre == Centre(n, tuple(sums.tolist())) and len(rows) == 600 * 16
    assert model.residual < 3e-14 and model.identity_error < 1e-9
    for r in rows:
        k, x = r["component"] - 1, np.array(fixed(vectors[r["vec_id"]]))
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        sign = np.sign(u[np.abs(model.vectors[:, k]).argmax(), k])
        assert r["whitened"] == pytest.approx(sign * float((x - mean) @ u[:, k]) / math.sqrt(e[k]), abs=1e-9)
        assert r["explained"] == pytest.approx(e[k] / trace, rel=1e-10)
        assert r["identity_error"] == model.identity_error


def test_many_tasks_are_combined(spark, monkeypatch):
    rng = np.random.default_rng(6)
    docs = table(spark, [rng.standard_normal(8).tolist() for _ in range(300)])
    one = whitening.fit(docs)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows, dims = whitening.fit_list(docs, "embedding")
    spread = rows.repartition(9)
    got = whitening.summed(spread, dims, lambda x: x.sum(0).astype(float), 9)
    assert got.tolist() == [float(s) for s in one.centre.sums]


def test_exact_deviations():
    c = Centre(3, (10, -4))
    x = np.array([[3, 5], [1 << 40, -7]])
    assert c.deviations(x) == [(9 - 10) ** 2 + (15 + 4) ** 2, None]
    assert np.allclose(c.centred(x[:1]), [[3 - 10 / 3, 5 + 4 / 3]])
    assert c.deviations(x[:1]) == [362]


def test_odd(spark):
    none = table(spark, [None, []])
    assert whitening.fit(none) is None and whitening.fit(table(spark, [[1.0, 2.0]] * 4)) is None
    assert whitening.fit(spark.createDataFrame([], SCHEMA)) is None
    # rank 1 of 3 dimensions: one component
    model, rows = result(table(spark, [[0.0, 1.0, 5.0], [0.0, 3.0, 5.0], [0.0, 3.0, 5.0]]))
    assert len(model.values) == 1 and sorted(round(r["whitened"], 9) for r in rows) == [-1.0, 1.0, 1.0]
    same = table(spark, [[0.0, 1.0], [2.0, 3.0], [1.0, 9.0]]).select("*", *[F.lit(7).alias(c) for c in ("x", "n", "component", "whitened", "_row")])
    model = whitening.fit(same)
    assert {r["_row"]["n"] for r in whitening.whiten(same, model).collect()} == {7}
    assert len(whitening.fit(same, components=1).values) == 1
