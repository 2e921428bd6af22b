"""Parameter tuning on training queries, report on test queries.

One job scores every training query for every grid value (one weight column
per value, so the postings scan is shared); the training matrix and the best
parameter are aggregates of the resulting metrics table. The best parameter
stays a one-row DataFrame that the test job reads as a scalar subquery --
nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.evaluation import DECIMALS, METRIC_COLUMN, metrics
from quire.operators.index import Index
from quire.operators.ranking import DIRICHLET_GRID, JM_GRID, rank_grid
from quire.session import materialize

GRIDS = {"jm": JM_GRID, "dirichlet": DIRICHLET_GRID}


def param_label(model: str, v: float) -> str:
    """Column label of a grid value: m_0_1 for lambda 0.1, m_200 for mu 200."""
    return "m_" + (f"{v:.1f}".replace(".", "_") if model == "jm" else str(int(v)))


def id_ranges(queries: DataFrame) -> DataFrame:
    """One row (train_lo, train_hi, test_lo, test_hi): the id span of the
    query table split in two halves (every query is used once)."""
    b = queries.agg(F.min("query_id").alias("lo"), F.max("query_id").alias("hi"))
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("bigint")
    return b.select(F.col("lo").alias("train_lo"), mid.alias("train_hi"),
                    (mid + 1).alias("test_lo"), F.col("hi").alias("test_hi"))


def within(ranges: DataFrame, which: str) -> Column:
    """Whether query_id lies in the inclusive train or test range."""
    return F.col("query_id").between(ranges.select(f"{which}_lo").scalar(), ranges.select(f"{which}_hi").scalar())


def in_range(queries: DataFrame, ranges: DataFrame, which: str) -> DataFrame:
    """H4: queries whose id lies in the inclusive train or test range."""
    return queries.filter(within(ranges, which))


def grid_metrics(index: Index, queries: DataFrame, qrels: DataFrame, models=("jm",),
                 cut: int = 10, grids: dict | None = None) -> DataFrame:
    """(model, param, query_id, n_hits, p, ap, recall, rr) for every query and every
    grid value of every model, from ONE scoring pass (see ``ranking.score``)."""
    for mdl in models:
        if mdl not in GRIDS:
            raise ValueError("tuning model must be jm or dirichlet (not both)")
    specs = [(mdl, float(v)) for mdl in models for v in (grids or GRIDS)[mdl]]
    runs = rank_grid(index, queries, None, specs, cut)
    return metrics(runs, qrels, queries, keys=("model", "param"), key_values=specs)


def metric_values(table: DataFrame, metric: str) -> DataFrame:
    """One metric of a grid table: (model, param, query_id, value)."""
    return table.select("model", "param", "query_id", F.col(METRIC_COLUMN[metric]).alias("value"))


def training_metrics(index: Index, train: DataFrame, qrels: DataFrame, model: str,
                     metric: str = "P", cut: int = 10, grid=None) -> DataFrame:
    """(model, param, query_id, value) for every grid value and training query."""
    grids = {model: tuple(grid)} if grid else None
    return metric_values(grid_metrics(index, train, qrels, (model,), cut, grids), metric)


def tuning_matrix(train_m: DataFrame, model: str, grid=None) -> DataFrame:
    """One row per training query, one column per grid value, plus an
    ``avg`` row."""
    grid = list(grid or GRIDS[model])
    wide = train_m.groupBy("query_id").pivot("param", grid).agg(F.first("value"))
    wide = wide.select(F.col("query_id").cast("string").alias("query"),
                       *[F.col(f"`{c}`").alias(param_label(model, float(c)))
                         for c in wide.columns if c != "query_id"])
    labels = [param_label(model, v) for v in grid]
    avg = wide.agg(*[F.round(F.coalesce(F.avg(c), F.lit(0.0)), DECIMALS).alias(c) for c in labels])
    return wide.unionByName(avg.withColumn("query", F.lit("avg")))


def tune(index: Index, queries: DataFrame, qrels: DataFrame, ranges: DataFrame,
         models=("jm",), metric: str = "P", cut: int = 10, trained: DataFrame | None = None):
    """H1-H5: (training metrics, best parameter per model, test metrics with the
    best parameter). Training queries are scored for the whole grid in one pass,
    and the small table of their metrics is written once (or given as
    ``trained``); test queries are scored for the best value only, which stays in
    Spark as a scalar subquery. The ranges may come in any order, be apart or
    overlap."""
    if trained is None:
        trained = materialize(grid_metrics(index, in_range(queries, ranges, "train"), qrels, models, cut), "grid-metrics")
    train_m = metric_values(trained.filter(F.col("model").isin(*models)), metric)
    best = best_param(train_m)
    test = in_range(queries, ranges, "test")
    tested = [test_metrics(index, test, qrels, best, m, metric, cut)
              .select(F.lit(m).alias("model"), "query_id", "value", "best_param") for m in models]
    return train_m, best, reduce(lambda a, b: a.unionByName(b), tested)


def best_param(train_m: DataFrame) -> DataFrame:
    """H3: (model, best_param, best_mean). Highest mean wins; ties go to the
    smallest parameter (the grid ascends from 0 and a later value must be
    strictly greater); all-zero means give parameter 0."""
    means = train_m.groupBy("model", "param").agg(
        F.round(F.avg("value"), DECIMALS).alias("mean"))
    best = means.groupBy("model").agg(
        F.max(F.struct(F.col("mean"), (-F.col("param")).alias("neg"))).alias("b"))
    return best.select("model", (-F.col("b.neg")).alias("best_param"),
                       F.col("b.mean").alias("best_mean"))


def test_metrics(index: Index, test: DataFrame, qrels: DataFrame, best: DataFrame,
                 model: str, metric: str = "P", cut: int = 10) -> DataFrame:
    """H5: (query_id, value, best_param) of the test queries, scored for the best
    parameter alone. The value is not collected: it enters the weight as a scalar
    subquery of the one-row table. No training query, no best value: no rows."""
    col = METRIC_COLUMN[metric]
    g = best.filter(F.col("model") == model).select(
        "model", F.col("best_param").alias("param"))          # one row
    runs = rank_grid(index, test, model, [g.select("param").scalar()], cut)
    m = metrics(runs, qrels, test, keys=("model", "param"), key_values=g).filter(F.col("param").isNotNull())
    return m.select("query_id", F.col(col).alias("value"), F.col("param").alias("best_param"))


def test_report(test_m: DataFrame) -> DataFrame:
    """K8: per-query value, an ``avg`` row, the best parameter on every row."""
    r = test_m.rollup("query_id").agg(F.round(F.avg("value"), DECIMALS).alias("value"),
                                      F.max("best_param").alias("best_param"),
                                      F.grouping("query_id").alias("_g"))
    return r.select(
        F.when(F.col("_g") == 1, F.lit("avg")).otherwise(F.col("query_id").cast("string")).alias("query"),
        F.coalesce("value", F.lit(0.0)).alias("value"), "best_param")
