import math
import random

import pytest

from quire.operators.significance import (checked_pairs, paired_runs, t_test, unpaired_counts,
                                          wilcoxon_statistic, wilcoxon_test)


def _runs(spark, xs, ys):
    rows = [("a", "P", i, float(x)) for i, x in enumerate(xs)] + \
           [("b", "P", i, float(y)) for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "run_id string, metric string, query_id long, value double")


def test_wilcoxon_fixtures(spark):
    w = wilcoxon_test(paired_runs(_runs(spark, [0, 0, 0], [1, 2, -3]))).first()
    assert w["p_exact"] == pytest.approx(1.25)          # may exceed 1
    w = wilcoxon_test(paired_runs(_runs(spark, [0.1, 0.2, 0.3], [0.1, 0.2, 0.3]))).first()
    assert w["p_exact"] == pytest.approx(0.25)          # zero differences are ranked
    assert not w["reject"]


def test_identical_runs_t_is_nan(spark):
    t = t_test(paired_runs(_runs(spark, [0.1, 0.2, 0.3], [0.1, 0.2, 0.3]))).first()
    assert math.isnan(t["t"]) and math.isnan(t["p_value"])
    assert t["reject"] is False


def test_exact_refused_above_30(spark):
    xs = [i / 31 for i in range(31)]
    ys = [x + (0.01 if i % 2 else -0.02) for i, x in enumerate(xs)]
    w = wilcoxon_test(paired_runs(_runs(spark, xs, ys))).first()
    assert w["n"] == 31 and w["p_exact"] is None and 0 <= w["p_normal"] <= 1
    assert w["reject_exact"] is None and w["reject"] is None
    n = wilcoxon_test(paired_runs(_runs(spark, xs, ys)), method="normal").first()
    assert n["reject"] == n["reject_normal"] == (n["p_normal"] < 0.05)
    with pytest.raises(ValueError):
        wilcoxon_test(paired_runs(_runs(spark, xs, ys)), method="auto")


@pytest.mark.parametrize("n", [500, 5_000, 50_000, 200_000])
def test_rank_sums_at_any_size(spark, n):
    """Against ranks computed in one piece; the same on every run."""
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(n)
    x, y = rng.integers(0, 1000, n) / 8, rng.integers(0, 1000, n) / 8 + rng.random(n).round(3)
    d = pd.Series(y - x)
    want = d.abs().rank()[d > 0].sum()
    pairs = spark.createDataFrame(pd.DataFrame({"run_a": "a", "run_b": "b", "metric": "m", "query_id": range(n), "x": x, "y": y})).repartition(8)
    for _ in range(2):
        w = wilcoxon_statistic(pairs).first()
        assert (w["n"], w["w_plus"], w["w_minus"]) == (n, want, n * (n + 1) / 2 - want)


def test_unpaired_queries_are_not_dropped(spark):
    rows = [("a", "P", q, 0.5) for q in (1, 2, 3)] + [("b", "P", q, 0.4) for q in (1, 2)] + [("c", "P", 9, 0.1)]
    runs = spark.createDataFrame(rows, "run_id string, metric string, query_id long, value double")
    odd = {(r.run_a, r.run_b): r.n_unpaired for r in unpaired_counts(runs).collect()}
    assert odd == {("a", "b"): 1, ("a", "c"): 4, ("b", "c"): 3}
    with pytest.raises(ValueError, match="a / b"):
        checked_pairs(runs, "a", "b")
    same = runs.filter("run_id != 'c' and query_id < 3")
    assert checked_pairs(same, "a", "b").count() == 2


def _jarray(spark, vals):
    gw = spark.sparkContext._gateway
    arr = gw.new_array(gw.jvm.double, len(vals))
    for i, v in enumerate(vals):
        arr[i] = float(v)
    return arr


@pytest.mark.parametrize("n,seed", [(10, 1), (20, 2), (25, 3)])
def test_against_commons_math(spark, n, seed):
    """The statistics library in Spark's own jars is the reference here."""
    rnd = random.Random(seed)
    xs = [round(rnd.random(), 3) for _ in range(n)]
    ys = [round(x + rnd.uniform(-0.2, 0.25), 3) if i % 4 else xs[i] for i, x in enumerate(xs)]
    jvm = spark.sparkContext._jvm
    tt = jvm.org.apache.commons.math3.stat.inference.TTest()
    wt = jvm.org.apache.commons.math3.stat.inference.WilcoxonSignedRankTest()
    p_t = tt.pairedTTest(_jarray(spark, xs), _jarray(spark, ys))
    p_w = wt.wilcoxonSignedRankTest(_jarray(spark, xs), _jarray(spark, ys), True)
    runs = _runs(spark, xs, ys)
    assert t_test(paired_runs(runs)).first()["p_value"] == pytest.approx(p_t, abs=1e-9)
    assert wilcoxon_test(paired_runs(runs)).first()["p_exact"] == pytest.approx(p_w, abs=1e-12)


def test_exact_tails_are_looked_up(spark):
    """The subsets are counted once per n, not once per pair, and give the same p."""
    from quire.operators.significance import wilcoxon_test

    rows = [(f"r{n}", "z", "m", q, 0.0, float((q * 7) % (n + 3)) * (-1) ** (q % 3)) for n in (1, 2, 5, 12, 29, 30, 31) for q in range(n)]
    got = wilcoxon_test(spark.createDataFrame(rows, "run_a string, run_b string, metric string, query_id long, x double, y double"))
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    for r in got.select("n", "w_max", "p_exact").collect():
        if r.n > 30:
            assert r.p_exact is None
            continue
        counts = [1] + [0] * (r.n * (r.n + 1) // 2)
        for k in range(1, r.n + 1):
            counts = [c + (counts[s - k] if s >= k else 0) for s, c in enumerate(counts)]
        assert r.p_exact == 2.0 * sum(c for s, c in enumerate(counts) if s >= r.w_max) / 2.0 ** r.n
    assert got.count() == 7
