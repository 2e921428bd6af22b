"""Registered queries: comparing the tuned Jelinek-Mercer and Dirichlet runs
on the test queries (C1-C4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators.significance import (checked_pairs, paired_runs, t_statistic, t_test,
                                          wilcoxon_statistic, wilcoxon_test)
from quire.plans.indexes import corpus_tune
from quire.plans.registry import register
from quire.plans.sqlparts import (FEAT_CTE, INDEX_CTES, QUERY_CTES, qrels_cte,
                                  tuning_ctes)

CUT = 10
METRIC = "MAP"


def tuned_test_runs(spark, sf_dir, metric=METRIC):
    """(run_id, metric, query_id, value): the test-query values of both tuned
    models -- the two 'test CSVs' of the replaced workflow, as one table."""
    _, _, test_m = corpus_tune(spark, sf_dir, ("jm", "dirichlet"), metric, CUT)
    return test_m.select(F.col("model").alias("run_id"), F.lit(metric).alias("metric"),
                         "query_id", "value")


_PAIRS_SQL = f"""
WITH {INDEX_CTES},
{QUERY_CTES},
{FEAT_CTE},
{qrels_cte(0.4)},
{tuning_ctes("jm", METRIC, CUT, prefix="a_")},
{tuning_ctes("dirichlet", METRIC, CUT, prefix="b_")},
pairs AS (
  SELECT 'dirichlet' AS run_a, 'jm' AS run_b, '{METRIC}' AS metric, b.query_id,
         b.value AS x, a.value AS y
  FROM b_test b JOIN a_test a ON a.query_id = b.query_id)"""


@register("paired_runs", _PAIRS_SQL + "\nSELECT * FROM pairs")
def paired_runs_q(spark, sf_dir):
    """The two test runs paired by query id."""
    return paired_runs(tuned_test_runs(spark, sf_dir))


@register("t_test", _PAIRS_SQL + """
, st AS (
  SELECT run_a, run_b, metric, count(*)::BIGINT AS n, avg(x - y) AS mean_diff,
         stddev_samp(x - y) AS sd_diff
  FROM pairs GROUP BY run_a, run_b, metric)
SELECT run_a, run_b, metric, n, round(mean_diff, 9) AS mean_diff, round(sd_diff, 9) AS sd_diff,
       round(CASE WHEN sd_diff = 0 THEN NULL ELSE mean_diff / (sd_diff / sqrt(n)) END, 9) AS t
FROM st""")
def t_test_q(spark, sf_dir):
    """Paired t statistic of AP@10 (dirichlet minus jm)."""
    s = t_statistic(paired_runs(tuned_test_runs(spark, sf_dir)))
    return s.select("run_a", "run_b", "metric", "n",
                    F.round("mean_diff", 9).alias("mean_diff"), F.round("sd_diff", 9).alias("sd_diff"),
                    F.round(F.when(F.col("sd_diff") != 0, F.col("t")), 9).alias("t"))


# two-sided tail of Student's t for whole degrees of freedom v, as a finite series in
# cos(theta), theta = atan(|t| / sqrt(v))
_T_TAIL = """
, st AS (
  SELECT run_a, run_b, metric, count(*)::BIGINT AS n, avg(x - y) AS md, stddev_samp(x - y) AS sd
  FROM pairs GROUP BY run_a, run_b, metric),
th AS (SELECT *, n - 1 AS v, atan(abs(md / (sd / sqrt(n))) / sqrt(n - 1)) AS th FROM st),
tail AS (
  SELECT *, CASE WHEN v % 2 = 0 THEN
      1 - sin(th) * (SELECT sum(list_product([1.0::DOUBLE] || list_transform(range(1, j + 1), lambda i: (2 * i - 1) / (2.0 * i) * cos(th) * cos(th))))
                     FROM range(0, v // 2) r(j))
    ELSE 1 - 2 / pi() * (th + CASE WHEN v = 1 THEN 0 ELSE sin(th) * cos(th) *
      (SELECT sum(list_product([1.0::DOUBLE] || list_transform(range(1, j + 1), lambda i: (2.0 * i) / (2 * i + 1) * cos(th) * cos(th))))
       FROM range(0, (v - 1) // 2) r(j)) END) END AS p
  FROM th)
SELECT run_a, run_b, metric, n, round(p, 8) AS p_value, p < 0.05 AS reject FROM tail"""


@register("t_test_pvalue", _PAIRS_SQL + _T_TAIL)
def t_test_pvalue_q(spark, sf_dir):
    """Two-sided p-value and decision at alpha 0.05."""
    t = t_test(checked_pairs(tuned_test_runs(spark, sf_dir)))
    return t.select("run_a", "run_b", "metric", "n", F.round("p_value", 8).alias("p_value"), "reject")


@register("wilcoxon", _PAIRS_SQL + """
, dd AS (SELECT run_a, run_b, metric, y - x AS d, abs(y - x) AS ad FROM pairs),
rk AS (
  SELECT *, rank() OVER (PARTITION BY run_a, run_b, metric ORDER BY ad)
            + (count(*) OVER (PARTITION BY run_a, run_b, metric, ad) - 1) / 2.0 AS r
  FROM dd),
w AS (
  SELECT run_a, run_b, metric, count(*)::BIGINT AS n,
         coalesce(sum(CASE WHEN d > 0 THEN r END), 0)::DOUBLE AS w_plus
  FROM rk GROUP BY run_a, run_b, metric)
SELECT run_a, run_b, metric, n, w_plus, n * (n + 1) / 2.0 - w_plus AS w_minus,
       greatest(w_plus, n * (n + 1) / 2.0 - w_plus) AS w_max
FROM w""")
def wilcoxon_q(spark, sf_dir):
    """Signed-rank statistics (zero differences ranked, ties averaged)."""
    return wilcoxon_statistic(paired_runs(tuned_test_runs(spark, sf_dir)))


@register("wilcoxon_pvalue")
def wilcoxon_pvalue_q(spark, sf_dir):
    """Exact p (n <= 30; may exceed 1), normal approximation, decisions."""
    return wilcoxon_test(checked_pairs(tuned_test_runs(spark, sf_dir)))


_LINE_DIFFS = """
WITH RECURSIVE pairs AS (
  SELECT {group} AS run_a, 'revenue' AS run_b, 'value' AS metric,
         {x} AS x, {y} AS y FROM lineitem{where}),
dd AS (SELECT run_a, run_b, metric, y - x AS d, abs(y - x) AS ad FROM pairs),
rk AS (
  SELECT *, rank() OVER (PARTITION BY run_a, run_b, metric ORDER BY ad)
            + (count(*) OVER (PARTITION BY run_a, run_b, metric, ad) - 1) / 2.0 AS r
  FROM dd),
w AS (
  SELECT run_a, run_b, metric, count(*)::BIGINT AS n,
         coalesce(sum(CASE WHEN d > 0 THEN r END), 0)::DOUBLE AS w_plus
  FROM rk GROUP BY run_a, run_b, metric)"""


def _line_pairs(spark, sf_dir, group, x, y):
    from quire.sources.tables import table
    return table(spark, sf_dir, "lineitem").select(
        group.alias("run_a"), F.lit("revenue").alias("run_b"), F.lit("value").alias("metric"), x.alias("x"), y.alias("y"))


@register("wilcoxon_large", _LINE_DIFFS.format(
    group="l_returnflag", x="l_quantity::DOUBLE * 1500", y="l_extendedprice::DOUBLE", where="") + """
SELECT run_a, run_b, metric, n, w_plus, n * (n + 1) / 2.0 - w_plus AS w_minus,
       greatest(w_plus, n * (n + 1) / 2.0 - w_plus) AS w_max
FROM w""")
def wilcoxon_large_q(spark, sf_dir):
    """C3 on every line item: price against 1500 a piece, by return flag."""
    return wilcoxon_statistic(_line_pairs(spark, sf_dir, F.col("l_returnflag"), F.col("l_quantity").cast("double") * 1500,
                                          F.col("l_extendedprice").cast("double")))


@register("wilcoxon_exact", _LINE_DIFFS.format(
    group="l_partkey::VARCHAR", x="l_quantity::DOUBLE * 1500", y="l_extendedprice::DOUBLE", where="") + """
, subsets AS (
  SELECT 0 AS k, [1::BIGINT] || list_transform(range(0, 465), lambda i: 0::BIGINT) AS c
  UNION ALL
  SELECT k + 1, list_transform(range(0, 466), lambda s: c[s + 1] + CASE WHEN s > k THEN c[s - k] ELSE 0 END)
  FROM subsets WHERE k < 30),
m AS (SELECT *, greatest(w_plus, n * (n + 1) / 2.0 - w_plus) AS w_max FROM w),
e AS (
  SELECT m.run_a, m.run_b, m.metric, m.n, m.w_max,
         2.0::DOUBLE * (SELECT sum(c[s + 1]) FROM range(0, 466) r(s) WHERE s >= m.w_max)::DOUBLE / pow(2.0, m.n) AS p
  FROM m LEFT JOIN subsets ON subsets.k = m.n)
SELECT run_a, run_b, metric, n, w_max, round(p, 9) AS p_exact, p < 0.05 AS reject_exact FROM e""")
def wilcoxon_exact_q(spark, sf_dir):
    """C3/C4 per part: exact p and decision, null for parts with over 30 lines."""
    w = wilcoxon_test(_line_pairs(spark, sf_dir, F.col("l_partkey").cast("string"), F.col("l_quantity").cast("double") * 1500,
                                  F.col("l_extendedprice").cast("double")))
    return w.select("run_a", "run_b", "metric", "n", "w_max", F.round("p_exact", 9).alias("p_exact"), "reject_exact")
