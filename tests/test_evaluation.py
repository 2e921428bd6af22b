"""Hand-worked metric cases (non-standard denominators of the replaced system)."""

import pytest

from quire.operators.evaluation import eval_report, mean_metrics, metrics


def _run(spark, rows):
    return spark.createDataFrame(rows, "query_id long, rk long, doc_id long, score double")


def test_metrics_by_hand(spark):
    # q1: hits 10, 20, 30 (cut 5 but only 3 returned); relevant 20, 30, 99
    # q2: no hit at all; relevant 7  -> zeros, still in the mean
    run = _run(spark, [(1, 1, 10, 3.0), (1, 2, 20, 2.0), (1, 3, 30, 1.0)])
    qrels = spark.createDataFrame([(1, 20), (1, 30), (1, 99), (1, 20), (2, 7)],
                                  "query_id long, doc_id long")
    queries = spark.createDataFrame([(1, "a"), (2, "b")], "query_id long, text string")
    m = {r["query_id"]: r for r in metrics(run, qrels, queries).collect()}
    assert m[1]["n_hits"] == 3
    assert m[1]["p"] == pytest.approx(2 / 3)                     # / hits returned
    assert m[1]["ap"] == pytest.approx((1 / 2 + 2 / 3) / 3)      # / hits returned
    assert m[1]["recall"] == pytest.approx(2 / 3)                # distinct judged ids
    assert m[1]["rr"] == pytest.approx(1 / 2)
    assert (m[2]["p"], m[2]["ap"], m[2]["recall"], m[2]["rr"], m[2]["n_hits"]) == (0, 0, 0, 0, 0)
    mean = mean_metrics(metrics(run, qrels, queries)).first()
    assert mean["n_queries"] == 2
    assert mean["mean_p"] == pytest.approx(1 / 3)
    rep = {r["query"]: r for r in eval_report(metrics(run, qrels, queries), 5).collect()}
    assert rep["average"]["rr"] == pytest.approx(0.25)
    assert rep["1"]["cut"] == 5


def test_standard_ap_option(spark):
    run = _run(spark, [(1, 1, 10, 3.0), (1, 2, 20, 2.0)])
    qrels = spark.createDataFrame([(1, 20), (1, 5), (1, 6)], "query_id long, doc_id long")
    q = spark.createDataFrame([(1, "a")], "query_id long, text string")
    r = metrics(run, qrels, q, denominator="relevant").first()
    assert r["ap"] == pytest.approx((1 / 2) / 3)


def test_unjudged_query_dropped_or_strict(spark):
    run = _run(spark, [(1, 1, 10, 1.0), (3, 1, 10, 1.0)])
    qrels = spark.createDataFrame([(1, 10)], "query_id long, doc_id long")
    q = spark.createDataFrame([(1, "a"), (3, "c")], "query_id long, text string")
    assert [r["query_id"] for r in metrics(run, qrels, q).collect()] == [1]
    with pytest.raises(ValueError):
        metrics(run, qrels, q, strict=True)


def test_mean_of_sample_report(spark):
    # the sample test CSV of the replaced tool: 0.2, 0.3, 0.0 -> 0.16666667
    m = spark.createDataFrame([(6, 0.2, 0.0, 0.0, 0.0), (7, 0.3, 0.0, 0.0, 0.0), (8, 0.0, 0.0, 0.0, 0.0)],
                              "query_id long, p double, ap double, recall double, rr double")
    assert mean_metrics(m).first()["mean_p"] == pytest.approx(0.16666667, abs=1e-8)


def test_mean_of_nothing_is_zero(spark):
    m = spark.createDataFrame([], "query_id long, p double, ap double, recall double, rr double")
    r = mean_metrics(m).first()
    assert (r["n_queries"], r["mean_p"]) == (0, 0.0)
