"""Comparing runs: paired t-test and Wilcoxon signed-rank.

Input is a long table of per-query values, (run_id, metric, query_id, value).
Every pair of runs with the same metric is compared in one job: a self-join on
(metric, query_id), then grouped aggregates per pair. Only the final one row
per pair goes through a pandas UDF (the t tail probability).

Semantics kept from the statistics library the replaced system calls:
- t: mean and sample variance of x - y, t = mean / sqrt(var / n), df = n - 1,
  two-sided; identical runs give NaN (0/0), which is "not rejected".
- Wilcoxon: d = y - x, ranks of |d| averaged over ties, *zero differences
  are ranked* (and count towards W-); W = max(W+, n(n+1)/2 - W+);
  exact p = 2 * #{subsets of 1..n with rank sum >= W} / 2^n, which may exceed
  1. The exact test exists for n <= 30 only: beyond, its p and decision are
  null. The normal approximation has columns of its own; ``method`` says which
  decision ``reject`` repeats, and no pair silently changes method.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.distributions import normal_cdf_udf, t_pvalue_udf
from quire.session import materialize

EXACT_MAX_N = 30
PAIR = ("run_a", "run_b", "metric")


def paired_runs(runs: DataFrame, run_a: str | None = None, run_b: str | None = None) -> DataFrame:
    """(run_a, run_b, metric, query_id, x, y). Without names, every pair of
    distinct runs (run_a < run_b) sharing a metric. Values are paired by
    query id (an inner join), not by line position."""
    a = runs.select(F.col("run_id").alias("run_a"), "metric", "query_id", F.col("value").alias("x"))
    b = runs.select(F.col("run_id").alias("run_b"), "metric", "query_id", F.col("value").alias("y"))
    if run_a is not None:
        a = a.filter(F.col("run_a") == run_a)
    if run_b is not None:
        b = b.filter(F.col("run_b") == run_b)
    j = a.join(b, ["metric", "query_id"])
    if run_a is None or run_b is None:
        j = j.filter(F.col("run_a") < F.col("run_b"))
    return j.select("run_a", "run_b", "metric", "query_id", "x", "y")


def unpaired_counts(runs: DataFrame, run_a: str | None = None, run_b: str | None = None) -> DataFrame:
    """Per pair of runs with a metric in common: queries that only one of the
    two has (0 if they can be compared), also for pairs without a common query."""
    pairs = paired_runs(runs, run_a, run_b)
    per_run = runs.groupBy("run_id", "metric").agg(F.countDistinct("query_id").alias("n"))
    na = per_run.select(F.col("run_id").alias("run_a"), "metric", F.col("n").alias("n_a"))
    nb = per_run.select(F.col("run_id").alias("run_b"), "metric", F.col("n").alias("n_b"))
    if run_a is not None:
        na = na.filter(F.col("run_a") == run_a)
    if run_b is not None:
        nb = nb.filter(F.col("run_b") == run_b)
    both = na.join(nb, "metric")
    if run_a is None or run_b is None:
        both = both.filter(F.col("run_a") < F.col("run_b"))
    got = pairs.groupBy(*PAIR).agg(F.countDistinct("query_id").alias("n_paired"))
    paired = F.coalesce("n_paired", F.lit(0))
    return (both.join(got, list(PAIR), "left")
            .select(*PAIR, (F.col("n_a") + F.col("n_b") - 2 * paired).alias("n_unpaired")))


def checked_pairs(runs: DataFrame, run_a: str | None = None, run_b: str | None = None) -> DataFrame:
    """C1 for runs that must cover the same queries: raises ValueError and names
    the pairs (first ten) if any query is in only one of two runs."""
    odd = unpaired_counts(runs, run_a, run_b).filter(F.col("n_unpaired") > 0).limit(10).collect()
    if odd:
        said = ", ".join(f"{r['run_a']} / {r['run_b']} ({r['metric']}): {r['n_unpaired']}" for r in odd)
        raise ValueError(f"runs of different queries cannot be compared: {said}")
    return paired_runs(runs, run_a, run_b)


def t_statistic(pairs: DataFrame) -> DataFrame:
    """(run_a, run_b, metric, n, mean_diff, sd_diff, t)."""
    d = pairs.withColumn("d", F.col("x") - F.col("y"))
    g = d.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"),
                             F.avg("d").alias("mean_diff"),
                             F.stddev_samp("d").alias("sd_diff"))
    se = F.col("sd_diff") / F.sqrt(F.col("n").cast("double"))
    t = (F.when(F.col("n") < 2, F.lit(None).cast("double"))
         .when((F.col("sd_diff") == 0) & (F.col("mean_diff") == 0), F.lit(float("nan")))
         .when(F.col("sd_diff") == 0,
               F.when(F.col("mean_diff") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
         .otherwise(F.col("mean_diff") / se))
    return g.select(*PAIR, F.col("n").cast("bigint").alias("n"), "mean_diff", "sd_diff", t.alias("t"))


def t_test(pairs: DataFrame, alpha: float = 0.05) -> DataFrame:
    """C2 + C4: statistic, two-sided p-value, decision (NaN is not rejected)."""
    s = t_statistic(pairs)
    # Arrow turns a NaN returned by pandas into null, so NaN is decided here
    p = F.when(F.isnan("t"), F.lit(float("nan"))).otherwise(
        t_pvalue_udf(F.col("t"), (F.col("n") - 1).cast("double")))
    return (s.withColumn("p_value", p)
            .withColumn("reject", F.coalesce(~F.isnan("p_value") & (F.col("p_value") < alpha),
                                             F.lit(False))))


def wilcoxon_statistic(pairs: DataFrame) -> DataFrame:
    """(run_a, run_b, metric, n, w_plus, w_minus, w_max).

    Ranks are computed over the *distinct* |d| values of a pair: rank =
    (number of smaller values) + mean position among equals. The number of
    smaller values is a running count, computed without putting a pair in one
    task: distinct values are range-partitioned by (pair, |d|); each partition
    contributes a subtotal per pair (a table of partitions x pairs rows), whose
    running sum gives every partition its offset; inside a partition the
    running sum covers only that partition's slice. The slices are a written
    table.
    """
    d = pairs.withColumn("d", F.col("y") - F.col("x")).withColumn("ad", F.abs("d"))
    by_val = d.groupBy(*PAIR, "ad").agg(F.count(F.lit(1)).alias("c"),
                                        F.sum(F.when(F.col("d") > 0, 1).otherwise(0)).alias("cpos"))
    # written once: the subtotals and the slices must see the same part numbers, and
    # two evaluations of a range exchange may draw different bounds
    sliced = materialize(by_val.repartitionByRange(*PAIR, "ad")
                         .withColumn("_part", F.spark_partition_id()), "wilcoxon-slices")
    sub = sliced.groupBy("_part", *PAIR).agg(F.sum("c").alias("_sub"))
    wo = (Window.partitionBy(*PAIR).orderBy("_part")
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sub.select("_part", *PAIR, F.coalesce(F.sum("_sub").over(wo), F.lit(0)).alias("_off"))
    wl = (Window.partitionBy("_part", *PAIR).orderBy("ad")
          .rowsBetween(Window.unboundedPreceding, -1))
    local = sliced.withColumn("_loc", F.coalesce(F.sum("c").over(wl), F.lit(0)))
    ranked = (local.join(offsets, ["_part", *PAIR])
              .withColumn("less", F.col("_off") + F.col("_loc"))
              .withColumn("avg_rank", F.col("less") + (F.col("c") + F.lit(1)) / F.lit(2.0)))
    g = ranked.groupBy(*PAIR).agg(F.sum("c").cast("bigint").alias("n"),
                                  F.sum(F.col("cpos") * F.col("avg_rank")).alias("w_plus"))
    total = F.col("n") * (F.col("n") + 1) / F.lit(2.0)
    return g.select(*PAIR, "n", "w_plus", (total - F.col("w_plus")).alias("w_minus"),
                    F.greatest(F.col("w_plus"), total - F.col("w_plus")).alias("w_max"))


# number of subsets of {1..n} per rank sum, by a dynamic programme over k = 1..n
_SUBSET_COUNTS = """
aggregate(sequence(1, CAST(n AS INT)),
          transform(sequence(0, CAST(n * (n + 1) / 2 AS INT)), s -> IF(s = 0, 1L, 0L)),
          (acc, k) -> transform(acc, (c, s) -> c + IF(s >= k, acc[s - k], 0L)))
"""
# of these, the subsets whose sum is at least w, for every w
_SUBSETS_FROM = """
transform(_cnt, (c, w) -> aggregate(slice(_cnt, w + 1, size(_cnt)), 0L, (a, x) -> a + x))
"""


def exact_tails(spark: SparkSession) -> DataFrame:
    """(n, _tail) for n = 1..EXACT_MAX_N: _tail[w] subsets of {1..n} have a sum of at least
    w. They depend on n alone, so a pair looks its own up."""
    n = spark.range(1, EXACT_MAX_N + 1, numPartitions=1).withColumnRenamed("id", "n")
    return n.withColumn("_cnt", F.expr(_SUBSET_COUNTS)).select("n", F.expr(_SUBSETS_FROM).alias("_tail"))


def wilcoxon_test(pairs: DataFrame, alpha: float = 0.05, cap_at_one: bool = False,
                  method: str = "exact") -> DataFrame:
    """C3 + C4: statistic, exact p and normal-approximation p, a decision for
    each (null where that method does not apply: exact for n > 30, normal for
    n = 0), and ``reject``, the decision of ``method``."""
    if method not in ("exact", "normal"):
        raise ValueError("method must be 'exact' or 'normal'")
    s = wilcoxon_statistic(pairs)
    exact = s.join(F.broadcast(exact_tails(s.sparkSession)), "n", "left").select(*s.columns, "_tail")
    larger = F.coalesce(F.get("_tail", F.ceil("w_max").cast("int")), F.lit(0))
    p_exact = F.lit(2.0) * larger / F.pow(F.lit(2.0), F.col("n"))
    if cap_at_one:
        p_exact = F.least(F.lit(1.0), p_exact)
    es = F.col("n") * (F.col("n") + 1) / F.lit(4.0)
    var = es * (F.lit(2.0) * F.col("n") + 1) / F.lit(6.0)
    w_min = F.least("w_plus", "w_minus")
    z = (w_min - es - F.lit(0.5)) / F.sqrt(var)
    return (exact.withColumn("p_exact", F.when(F.col("n") <= EXACT_MAX_N, p_exact))
            .withColumn("p_normal", F.when(var > 0, F.lit(2.0) * normal_cdf_udf(z)))
            .drop("_tail")
            .withColumn("reject_exact", F.col("p_exact") < alpha)
            .withColumn("reject_normal", F.col("p_normal") < alpha)
            .withColumn("reject", F.col(f"reject_{method}")))
