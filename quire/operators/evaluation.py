"""Retrieval evaluation at a cutoff: P@n, AP@n, recall@n, RR (and reports).

``n`` is min(cut, hits returned). The metrics keep the semantics of the
system being replaced, including its non-standard denominators:

- P@n      relevant / n            (hits returned, not the cut)
- AP@n     sum of precision at each relevant rank / n   (not / #relevant)
- recall@n relevant / number of judged documents of the query
- RR       1 / first relevant rank, 0 when none
- a query with no hit scores 0 on all four and still counts in the mean
- a query without judgements is dropped (and counted) unless ``strict``

All of it is joins, a running-sum window over at most ``cut`` rows per
query, and grouped aggregates; no per-query loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


METRICS = ("p", "ap", "recall", "rr")
# names used by the tuning job and its reports
METRIC_COLUMN = {"P": "p", "MAP": "ap", "R": "recall", "MRR": "rr"}

DECIMALS = 9


def tag_relevance(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Run + ``rel`` (0/1). Judgements are de-duplicated first, so a
    document listed twice does not duplicate hits."""
    j = qrels.select("query_id", "doc_id").distinct().withColumn("_j", F.lit(1))
    return (run.join(j, ["query_id", "doc_id"], "left")
            .withColumn("rel", F.coalesce(F.col("_j"), F.lit(0)).cast("bigint")).drop("_j"))


def running_precision(tagged: DataFrame, keys=()) -> DataFrame:
    """Relevant so far / rank, per query (frame bounded by the cut)."""
    w = (Window.partitionBy(*keys, "query_id").orderBy("rk")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return tagged.withColumn("cum_rel", F.sum("rel").over(w)).withColumn(
        "running_precision", F.round(F.col("cum_rel") / F.col("rk"), DECIMALS))


def judged_counts(qrels: DataFrame, distinct: bool = True) -> DataFrame:
    """(query_id, n_rel): judgement-list length (distinct ids by default)."""
    q = qrels.select("query_id", "doc_id")
    if distinct:
        q = q.distinct()
    return q.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))


def metrics(run: DataFrame, qrels: DataFrame, queries: DataFrame, keys=(),
            denominator: str = "returned", distinct_judgements: bool = True,
            strict: bool = False, key_values: DataFrame | None = None) -> DataFrame:
    """(keys..., query_id, n_hits, p, ap, recall, rr) for every selected
    query that has judgements (every query with ``strict=False`` dropping
    the unjudged ones; ``strict=True`` raises when one is unjudged).

    ``run`` has (keys..., query_id, rk, doc_id); ``queries`` is the selected
    query set (one row per query_id); zero-hit queries come from it.
    ``key_values`` gives the key combinations: a literal list of tuples (a
    parameter grid) or a one-row table (a chosen parameter).

    Joins between derived tables are left to AQE, which turns them into
    broadcast joins at run time when the measured side is small and keeps the
    shuffle join otherwise.
    """
    keys = list(keys)
    tagged = running_precision(tag_relevance(run, qrels), keys)
    agg = tagged.groupBy(*keys, "query_id").agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.sum("rel").alias("n_rel_ret"),
        F.sum(F.when(F.col("rel") == 1, F.col("cum_rel") / F.col("rk"))).alias("sum_prec"),
        F.min(F.when(F.col("rel") == 1, F.col("rk"))).alias("first_rel"))
    judged = judged_counts(qrels, distinct_judgements)
    qsel = queries.select("query_id").distinct()
    if strict:
        missing = qsel.join(judged, "query_id", "left_anti").limit(1).count()
        if missing:
            raise ValueError("a selected query has no relevance judgements")
    base = qsel.join(judged, "query_id")
    if keys:
        if key_values is None:
            raise ValueError("keys need key_values: a literal list or a one-row table")
        if isinstance(key_values, DataFrame):
            # a one-row table (e.g. the best parameter): scalar subqueries
            base = base.select("*", *[key_values.select(k).scalar().alias(k) for k in keys])
        else:
            # a literal grid: one generated row per combination, no join
            combos = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, row)])
                               for row in key_values])
            base = base.select("*", F.inline(combos))
    m = base.join(agg, [*keys, "query_id"], "left")
    n = F.coalesce(F.col("n_hits"), F.lit(0))
    rel = F.coalesce(F.col("n_rel_ret"), F.lit(0))
    ap_den = n if denominator == "returned" else F.col("n_rel")
    out = m.select(
        *keys, "query_id", n.cast("bigint").alias("n_hits"),
        F.when(n > 0, F.round(rel / n, DECIMALS)).otherwise(F.lit(0.0)).alias("p"),
        F.when(rel > 0, F.round(F.col("sum_prec") / ap_den, DECIMALS)).otherwise(F.lit(0.0)).alias("ap"),
        F.when(n > 0, F.round(rel / F.col("n_rel"), DECIMALS)).otherwise(F.lit(0.0)).alias("recall"),
        F.when(rel > 0, F.round(F.lit(1.0) / F.col("first_rel"), DECIMALS)).otherwise(F.lit(0.0)).alias("rr"))
    return out


def unjudged_queries(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    """Selected queries dropped from evaluation for lack of judgements."""
    return queries.select("query_id").distinct().join(
        qrels.select("query_id").distinct(), "query_id", "left_anti")


def mean_metrics(m: DataFrame, keys=()) -> DataFrame:
    """Arithmetic mean over queries; 0 when there are none (the mean is a
    global aggregate, so an empty input still yields one row)."""
    keys = list(keys)
    aggs = [F.round(F.coalesce(F.avg(c), F.lit(0.0)), DECIMALS).alias(f"mean_{c}") for c in METRICS]
    n = F.count(F.lit(1)).alias("n_queries")
    return m.groupBy(*keys).agg(n, *aggs) if keys else m.agg(n, *aggs)


def eval_report(m: DataFrame, cut: int) -> DataFrame:
    """One row per query plus an ``average`` row (rollup)."""
    r = m.rollup("query_id").agg(*[F.round(F.avg(c), DECIMALS).alias(c) for c in METRICS],
                                 F.grouping("query_id").alias("_g"))
    return r.select(
        F.when(F.col("_g") == 1, F.lit("average")).otherwise(F.col("query_id").cast("string")).alias("query"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in METRICS],
        F.lit(cut).cast("bigint").alias("cut"))


def metrics_long(m: DataFrame, keys=()) -> DataFrame:
    """One row per (query, metric) -- P, MAP, R, MRR."""
    keys = list(keys)
    stack = "stack(4, 'P', p, 'MAP', ap, 'R', recall, 'MRR', rr) as (metric, value)"
    return m.selectExpr(*keys, "query_id", stack)


def ranked_list(run: DataFrame, qrels: DataFrame, top: int) -> DataFrame:
    """The first ``top`` hits with running precision where relevant.
    Metrics are computed on the whole run elsewhere; this is the display cut."""
    tagged = running_precision(tag_relevance(run, qrels))
    return tagged.filter(F.col("rk") <= top).select(
        "query_id", "rk", "doc_id", "rel",
        F.when(F.col("rel") == 1, F.col("running_precision")).alias("running_precision"))
