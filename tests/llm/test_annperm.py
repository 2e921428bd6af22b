import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import annperm


def table(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), None if v is None else [None if c is None else float(c) for c in v]) for i, v in zip(ids, x)],
                                 "vec_id long, embedding array<float>")


def brute(x, ids, k, step):
    x, out = x.astype(np.float32).astype(np.float64), {}
    for i, q in zip(ids, x):
        if i % step == 0:
            s = x @ q
            keep = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), s[j]) for j in keep]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_footrule():
    rng = np.random.default_rng(1)
    a, b = (np.array([rng.permutation(12)[:5] for _ in range(40)]) for _ in range(2))
    files = annperm.files(a, 12)
    for q in b:
        for j, v in enumerate(a):
            common = sum(min(int(files[p, j]), 5 - r) for r, p in enumerate(q))
            place = lambda o, p: list(o).index(p) if p in o else 5
            slow = sum(abs(place(q, p) - place(v, p)) for p in set(q) | set(v))
            assert slow == 5 * 6 - 2 * common


def test_recall_and_order(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24))
    x *= rng.uniform(0.5, 2, size=(3000, 1))
    x[:900] = x[0] + 0.01 * rng.normal(size=(900, 24))      # a large cluster of near copies
    want = brute(x, np.arange(3000), 10, 50)
    got = found(annperm.search(table(spark, x), F.col("vec_id") % 50 == 0, k=10, pivots=64, prefix=32, block_rows=1500, block_queries=25))
    assert got.keys() == want.keys()
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    truth = x.astype(np.float32).astype(np.float64)
    for q, rows in got.items():
        assert [s for _, s in rows] == sorted((s for _, s in rows), reverse=True)
        assert all(s == pytest.approx(float(truth[q] @ truth[v]), rel=1e-12) for v, s in rows)


def test_ties_repeats_and_odd_vectors(spark):
    x = [[1, 0], [1, 0], [1, 0], [0, 1], None, [0, 0], [float("nan"), 1], [float("inf"), 0], [None, 1], [2, 0, 0], [1, 0], [-1, 0]]
    rows = table(spark, x, [20, 3, 2, 40, 60, 80, 100, 120, 140, 160, 1, 0]).unionByName(table(spark, [[1, 0]], [2])) \
        .unionByName(table(spark, [[1, 1]], [5]).withColumn("vec_id", F.lit(None).cast("long")))
    got = found(annperm.search(rows.withColumn("rank", F.lit(1)).withColumn("score", F.lit(2)), F.col("vec_id") % 20 == 0, k=3))
    assert got == {20: [(1, 1.0), (2, 1.0), (3, 1.0)], 40: [(0, 0.0), (1, 0.0), (2, 0.0)], 0: [(40, 0.0), (1, -1.0), (2, -1.0)]}


def test_empty(spark):
    rows = table(spark, [[1, 0]], [20])
    assert annperm.search(rows, F.col("vec_id") % 20 == 0).count() == 0
    assert annperm.search(rows.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert annperm.search(table(spark, [[0, 0], None], [20, 40]), F.col("vec_id") % 20 == 0).count() == 0
