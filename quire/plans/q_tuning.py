"""Registered queries: tuning on training queries, test report."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators.tuning import (GRIDS, best_param, id_ranges, in_range, metric_values, param_label, test_report,
                                    tuning_matrix)
from quire.plans.indexes import corpus_training, corpus_tune
from quire.plans.registry import register
from quire.plans.sqlparts import GRID_SQL, tuning_sql
from quire.sources.tables import benchmark_queries

CUT = 10


def _train(spark, sf_dir, model, metric):
    return metric_values(corpus_training(spark, sf_dir, model, CUT), metric)


@register("tune_jm", tuning_sql("jm", "P", """
SELECT 'jm' AS model, param, query_id, value FROM mv WHERE split = 'train'"""))
def tune_jm(spark, sf_dir):
    """H1: P@10 of every training query for lambda 0.0 (boolean), 0.1 .. 1.0."""
    return _train(spark, sf_dir, "jm", "P")


@register("tune_dirichlet", tuning_sql("dirichlet", "MAP", """
SELECT 'dirichlet' AS model, param, query_id, value FROM mv WHERE split = 'train'"""))
def tune_dirichlet(spark, sf_dir):
    """H2: AP@10 of every training query for mu in 0 .. 4000 (11 values)."""
    return _train(spark, sf_dir, "dirichlet", "MAP")


def _matrix_sql(model, metric):
    vals = [float(v) for v in GRID_SQL[model].split(", ")]
    cols = ",\n  ".join(f"max(CASE WHEN param = {v!r} THEN value END) AS {param_label(model, v)}"
                        for v in vals)
    avgs = ",\n  ".join(f"round(coalesce(avg({param_label(model, v)}), 0), 9)" for v in vals)
    names = ", ".join(param_label(model, v) for v in vals)
    return tuning_sql(model, metric, f"""
, wide AS (
  SELECT CAST(query_id AS VARCHAR) AS query,
  {cols}
  FROM mv WHERE split = 'train' GROUP BY query_id)
SELECT query, {names} FROM wide
UNION ALL
SELECT 'avg', {avgs} FROM wide""")


@register("tuning_matrix", _matrix_sql("jm", "P"))
def tuning_matrix_q(spark, sf_dir):
    """The training CSV as a table: query x lambda, plus the avg row."""
    return tuning_matrix(_train(spark, sf_dir, "jm", "P"), "jm", GRIDS["jm"])


@register("best_param", tuning_sql("dirichlet", "MAP", """
SELECT 'dirichlet' AS model, best_param, best_mean FROM best"""))
def best_param_q(spark, sf_dir):
    """H3: the parameter with the highest training mean (ties -> smallest)."""
    return best_param(_train(spark, sf_dir, "dirichlet", "MAP"))


def _test_report(spark, sf_dir, model, metric):
    _, _, test_m = corpus_tune(spark, sf_dir, (model,), metric, CUT)
    return test_report(test_m.select("query_id", "value", "best_param"))


_TEST_SQL = """
SELECT CASE WHEN grouping(query_id) = 1 THEN 'avg' ELSE CAST(query_id AS VARCHAR) END AS query,
       coalesce(round(avg(value), 9), 0) AS value, max(best_param) AS best_param
FROM test GROUP BY ROLLUP (query_id)"""


@register("test_report", tuning_sql("jm", "P", _TEST_SQL))
def test_report_q(spark, sf_dir):
    """H4/H5/K8: tune lambda on the lower half of the query ids, report P@10
    of the upper half with the best lambda."""
    return _test_report(spark, sf_dir, "jm", "P")


@register("test_report_dirichlet", tuning_sql("dirichlet", "MAP", _TEST_SQL))
def test_report_dirichlet(spark, sf_dir):
    """H4/H5/K8 for mu and AP@10."""
    return _test_report(spark, sf_dir, "dirichlet", "MAP")


@register("train_test", tuning_sql("jm", "P", """
SELECT r.lo AS train_lo, r.mid AS train_hi, r.mid + 1 AS test_lo, r.hi AS test_hi,
       (SELECT count(*) FROM benchmark, rng WHERE item_id BETWEEN rng.lo AND rng.mid)::BIGINT AS n_train,
       (SELECT count(*) FROM benchmark, rng WHERE item_id BETWEEN rng.mid + 1 AND rng.hi)::BIGINT AS n_test
FROM rng r"""))
def train_test_q(spark, sf_dir):
    """H4: the two inclusive id ranges and the number of queries in each."""
    q = benchmark_queries(spark, sf_dir)
    r = id_ranges(q)
    n_train = in_range(q, r, "train").agg(F.count(F.lit(1))).scalar()
    n_test = in_range(q, r, "test").agg(F.count(F.lit(1))).scalar()
    return r.select("*", n_train.alias("n_train"), n_test.alias("n_test"))
