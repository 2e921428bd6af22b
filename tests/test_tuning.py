from quire.operators.ranking import JM_GRID
from quire.operators.tuning import best_param, tuning_matrix


def _tm(spark, rows):
    return spark.createDataFrame(rows, "model string, param double, query_id long, value double")


def test_ties_go_to_the_smallest_parameter(spark):
    rows = [("jm", p, q, v) for p, vals in ((0.0, (0.1, 0.1)), (0.1, (0.2, 0.4)), (0.2, (0.4, 0.2)),
                                            (0.3, (0.1, 0.0)))
            for q, v in zip((1, 2), vals)]
    b = best_param(_tm(spark, rows)).first()
    assert (b["best_param"], round(b["best_mean"], 9)) == (0.1, 0.3)   # 0.2 ties: not strictly greater


def test_all_zero_means_give_parameter_zero(spark):
    rows = [("dirichlet", p, 1, 0.0) for p in (0.0, 200.0, 400.0)]
    assert best_param(_tm(spark, rows)).first()["best_param"] == 0.0


def test_training_matrix_layout(spark):
    rows = [("jm", p, q, p * q) for p in JM_GRID
            for q in (1, 2)]
    m = {r["query"]: r for r in tuning_matrix(_tm(spark, rows), "jm").collect()}
    assert set(m) == {"1", "2", "avg"}
    assert m["2"]["m_0_5"] == 1.0 and abs(m["avg"]["m_1_0"] - 1.5) < 1e-9


def test_ranges_in_any_order(spark):
    """Every query of either range is scored once, whichever comes first."""
    from quire.operators.tuning import in_range, within
    q = spark.range(1, 11).withColumnRenamed("id", "query_id")
    for spans in ((6, 10, 1, 5), (1, 2, 8, 9), (4, 8, 6, 10)):
        r = spark.createDataFrame([spans], "train_lo long, train_hi long, test_lo long, test_hi long")
        got = {x.query_id for x in q.filter(within(r, "train") | within(r, "test")).collect()}
        assert got == {*range(spans[0], spans[1] + 1), *range(spans[2], spans[3] + 1)}
        assert in_range(q, r, "train").count() == spans[1] - spans[0] + 1


def test_tune_with_test_ids_first(spark):
    from quire.operators.index import build_index
    from quire.operators.tuning import tune
    docs = spark.createDataFrame([(i, f"word{i} common " + "pad " * (i % 4)) for i in range(12)], "doc_id long, contents string")
    queries = spark.createDataFrame([(i, f"word{i} common") for i in range(1, 9)], "query_id long, text string")
    qrels = spark.createDataFrame([(i, i) for i in range(1, 9)], "query_id long, doc_id long")
    r = spark.createDataFrame([(5, 8, 1, 4)], "train_lo long, train_hi long, test_lo long, test_hi long")
    train_m, best, test_m = tune(build_index(spark, docs), queries, qrels, r, ("jm",), "MAP", 5)
    assert {x.query_id for x in train_m.collect()} == {5, 6, 7, 8}
    assert best.count() == 1 and {x.query_id for x in test_m.collect()} == {1, 2, 3, 4}


def test_one_smoothing_model_is_tuned_at_a_time():
    """H6: only the two models with a parameter can be tuned."""
    import pytest

    from quire.operators.tuning import grid_metrics
    for models in (("bm25",), ("jm", "boolean"), ("both",)):
        with pytest.raises(ValueError, match="jm or dirichlet"):
            grid_metrics(None, None, None, models)
