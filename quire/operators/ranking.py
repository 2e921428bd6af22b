"""Ranking: every query of a batch, every parameter value, in one job.

The best hits of a batch whose terms can be sent to the tasks come from blocks of documents
(``best``, ``docscores``). Plan shape of all scores, and of larger batches (checked with
``explain``)::

    query_terms (small, size-checked broadcast)
      -> join terms (df, cf)            broadcast into the terms scan
      -> join postings on term          broadcast hash join, one postings scan
      -> per-posting weight (column expression, codegen)
      -> sum by (param, query_id, doc_id)   partial + final hash aggregate
      -> row_number per (param, query_id) <= cut   WindowGroupLimit partial
                                                   before the shuffle

The shuffle is keyed by (query_id, doc_id), not by term, so a frequent term
(a third of all postings) is spread over all tasks; the per-query top-k is
cut map-side, so a query matching most documents ships only k rows per task.

Models (published formulas: Zhai & Lafferty 2001; Robertson & Zaragoza 2009),
``p = (cf + 1) / (T + 1)`` with T the number of tokens in the collection:

- ``jm``        ln(1 + ((1 - l) * tf / dl) / (l * p)), l in (0, 1]; in a tuning
                grid l = 0 means the boolean model
- ``dirichlet`` max(0, ln(1 + tf / (mu * p)) + ln(mu / (dl + mu))); mu = 0 -> 0
- ``boolean``   1 per matching query term
- ``bm25``      ln(1 + (N - df + .5)/(df + .5)) * tf / (tf + k1 (1 - b + b dl/avgdl))

Each term's weight is multiplied by its count in the query (qtf).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.docscores import best_scores, numbered_terms, query_table
from quire.operators.index import Index, term_counts
from quire.operators.joins import counted_join, fits_broadcast, join_small, salted_join
from quire.session import materialize

MODELS = ("jm", "dirichlet", "boolean", "bm25")

# Parameter grids of the tuning job.
JM_GRID = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
DIRICHLET_GRID = (0.0, 200.0, 400.0, 600.0, 800.0, 1000.0, 1500.0, 2000.0, 2500.0,
                  3000.0, 4000.0)
# BM25 defaults.
BM25_K1 = 1.2
BM25_B = 0.75

SCORE_DECIMALS = 6


def round_score(c: Column, decimals: int = SCORE_DECIMALS) -> Column:
    """Round half away from zero at ``decimals`` with double arithmetic:
    sign(x) * floor(|x| * 10^d + 0.5) / 10^d. Scores are rounded before
    ranking so that summation order cannot reorder near-ties; this form is
    several times cheaper per row than the decimal-based ``round`` and is the
    same computation SQL engines commonly use for doubles."""
    m = F.lit(float(10 ** decimals))
    return F.signum(c) * F.floor(F.abs(c) * m + F.lit(0.5)) / m


# ------------------------------------------------------------------ queries

def query_terms(queries: DataFrame, analyzer: str = "standard", id_col: str = "query_id",
                text_col: str = "text", stop_words: DataFrame | None = None) -> DataFrame:
    """(query_id, term, qtf). Queries are lower-cased before analysis, so
    operator words are never operators and case-keeping analyzers only match
    lower-case document words. ``stop_words`` are those of the index."""
    q = queries.select(F.col(id_col).alias("query_id"), F.lower(F.col(text_col)).alias("_q"))
    tc = term_counts(q, analyzer, "query_id", "_q", stop_words)
    return tc.select("query_id", "term", F.col("tf").alias("qtf"))


def select_queries(queries: DataFrame, first: int | None = None, last: int | None = None,
                   id_col: str = "query_id") -> DataFrame:
    """All queries, one id, or an inclusive id range."""
    out = queries
    if first is not None:
        out = out.filter(F.col(id_col) >= first)
    if last is not None:
        out = out.filter(F.col(id_col) <= last)
    return out


# ------------------------------------------------------------------ features

def candidates(index: Index, qterms: DataFrame) -> DataFrame:
    """(query_id, term, qtf, df, cf, doc_id, tf, dl): every posting of every
    query term. The query-side table is size-checked once; when it is small it
    is broadcast into the terms scan and the result (never larger) into the
    postings scan, so the large postings table is read once, four columns
    wide, without a shuffle. Otherwise both joins are shuffled, a term's postings to as
    many tasks as its document frequency asks for."""
    postings = index.postings.select("doc_id", "term", "tf", "dl")
    if fits_broadcast(qterms):
        qstats = index.terms.join(F.broadcast(qterms), "term")
        return postings.join(F.broadcast(qstats), "term")
    qstats = salted_join(index.terms, qterms, "term")
    return counted_join(postings, qstats, "term", "df", spread_col="doc_id")


def corpus_scalars(index: Index) -> tuple[Column, Column, Column]:
    """(tokens in the collection, documents with a term, mean length) as
    scalar subqueries of the one-row corpus table: evaluated once, inlined
    into the expressions -- no join with the statistics table."""
    c = index.corpus
    return (c.select("n_tokens").scalar(), c.select("n_docs_nonempty").scalar(),
            c.select("avgdl").scalar())


def weight(model: str, param: float | Column, tf: Column, dl: Column, df: Column, cf: Column,
           n_tokens: Column, n_docs: Column, avgdl: Column, k1: float = BM25_K1,
           b: float = BM25_B) -> Column:
    """Per-posting weight of one model with a *literal* parameter, so Catalyst
    folds the constants and no branch on the parameter is evaluated per row.
    Edge values are decided here, not per row: lambda = 0 is the boolean model
    (tuning grids only), mu = 0 scores 0. A parameter that is only known when the
    job runs (a scalar subquery) decides them in the expression."""
    if isinstance(param, Column):
        at_zero = weight(model, 0.0, tf, dl, df, cf, n_tokens, n_docs, avgdl, k1, b)
        return F.when(param == 0.0, at_zero).otherwise(_smoothed(model, param, tf, dl, cf, n_tokens))
    tf_d, dl_d = tf.cast("double"), dl.cast("double")
    if model == "boolean" or (model == "jm" and param == 0.0):
        return F.lit(1.0)
    if model == "dirichlet" and param == 0.0:
        return F.lit(0.0)
    if model in ("jm", "dirichlet"):
        return _smoothed(model, F.lit(float(param)), tf, dl, cf, n_tokens)
    if model == "bm25":
        df_d = df.cast("double")
        idf = F.log(F.lit(1.0) + (n_docs.cast("double") - df_d + F.lit(0.5)) / (df_d + F.lit(0.5)))
        return idf * tf_d / (tf_d + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl_d / avgdl))
    raise ValueError(f"unknown model {model!r}; choose from {MODELS}")


def _smoothed(model: str, param: Column, tf: Column, dl: Column, cf: Column, n_tokens: Column) -> Column:
    """Language-model weight for a parameter other than 0."""
    tf_d, dl_d = tf.cast("double"), dl.cast("double")
    p = (cf.cast("double") + F.lit(1.0)) / (n_tokens.cast("double") + F.lit(1.0))
    if model == "jm":
        return F.log(F.lit(1.0) + ((F.lit(1.0) - param) * tf_d / dl_d) / (param * p))
    return F.greatest(F.lit(0.0),
                      F.log(F.lit(1.0) + tf_d / (param * p)) + F.log(param / (dl_d + param)))


def _specs(model, params) -> list[tuple[str, float]]:
    """(model, param) pairs: ``model`` with a list of values, or model=None
    and ``params`` already a list of (model, value) pairs."""
    if model is None:
        return [(m, float(v)) for m, v in params]
    return [(model, v if isinstance(v, Column) else float(v)) for v in params]


def _sums(index: Index, feats: DataFrame, specs, k1: float, b: float) -> DataFrame:
    """(query_id, doc_id, _s0, _s1, ...): rounded scores of every (model, parameter) pair."""
    args = (F.col("tf"), F.col("dl"), F.col("df"), F.col("cf"), *corpus_scalars(index), k1, b)
    qtf = F.col("qtf").cast("double")
    sums = [F.sum(qtf * weight(m, v, *args)).alias(f"_s{i}") for i, (m, v) in enumerate(specs)]
    agg = feats.groupBy("query_id", "doc_id").agg(*sums)
    return agg.select("query_id", "doc_id", *[round_score(F.col(f"_s{i}")).alias(f"_s{i}") for i in range(len(specs))])


def _long(wide: DataFrame, specs) -> DataFrame:
    """(spec, model, param, query_id, doc_id, score): one row per pair. ``spec`` (int)
    identifies it: a numeric window key keeps the top-k sort on its fast prefix comparison."""
    if len(specs) == 1:
        return wide.select(F.lit(0).alias("spec"), F.lit(specs[0][0]).alias("model"), F.lit(specs[0][1]).alias("param"),
                           "query_id", "doc_id", F.col("_s0").alias("score"))
    rows = ", ".join(f"{i}, '{m}', CAST({v!r} AS DOUBLE), _s{i}" for i, (m, v) in enumerate(specs))
    return wide.selectExpr(f"stack({len(specs)}, {rows}) AS (spec, model, param, score)", "query_id", "doc_id") \
        .select("spec", "model", "param", "query_id", "doc_id", "score")


#: One document in so many makes the thresholds of a cut.
THRESHOLD_SHARE = 16


def thresholds(index: Index, feats: DataFrame, specs, cut: int, k1: float, b: float) -> DataFrame:
    """(query_id, _t0, _t1, ...): per pair the ``cut``-th best score among one document in
    THRESHOLD_SHARE, which the best ``cut`` of all documents reach; null where there are
    fewer. One row per query."""
    some = feats.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("cut")), F.lit(THRESHOLD_SHARE)) == 0)
    kth = top_k(_long(_sums(index, some, specs, k1, b), specs), cut).filter(F.col("rk") == cut)
    return kth.groupBy("query_id").agg(*[F.max(F.when(F.col("spec") == i, F.col("score"))).alias(f"_t{i}")
                                         for i in range(len(specs))])


def score(index: Index, qterms: DataFrame, model: str | None, params, k1: float = BM25_K1,
          b: float = BM25_B, cut: int | None = None) -> DataFrame:
    """(spec, model, param, query_id, doc_id, score) for every matching document and
    every (model, parameter) pair.

    All pairs are computed in the same pass: one weight column per pair,
    summed in one grouped aggregate keyed by (query_id, doc_id), then
    unpivoted. The candidate volume is shuffled once whatever the number of
    models and grid values, and there is no cross join with the grid.

    With ``cut`` rows that can't be among the first ``cut`` of their query and pair are
    left out: a first pass over a share of the documents gives the scores that these
    reach, and what is below goes before the unpivot, so that the ranking sorts a small
    multiple of ``cut`` rows instead of all.
    """
    specs = _specs(model, params)
    feats = candidates(index, qterms)
    wide = _sums(index, feats, specs, k1, b)
    if cut is None:
        return _long(wide, specs)
    bounds = thresholds(index, feats, specs, cut, k1, b)
    wide = join_small(wide, materialize(bounds, "score-thresholds"), "query_id", "left")
    reached = [F.col(f"_t{i}").isNull() | (F.col(f"_s{i}") >= F.col(f"_t{i}")) for i in range(len(specs))]
    some = wide.filter(reduce(lambda x, y: x | y, reached))
    # a pair below its bound has no score any more
    some = some.select("query_id", "doc_id", *[F.when(ok, F.col(f"_s{i}")).alias(f"_s{i}") for i, ok in enumerate(reached)])
    return _long(some, specs).filter(F.col("score").isNotNull())


def top_k(scored: DataFrame, cut: int, keys=None) -> DataFrame:
    """First ``cut`` hits per query (and per model/parameter pair) by
    score desc, doc_id asc (the order in which documents were added).
    ``row_number() <= cut`` is planned as a partial WindowGroupLimit before
    the shuffle."""
    if keys is None:
        keys = ("query_id", "spec") if "spec" in scored.columns else ("query_id",)
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("doc_id"))
    return (scored.withColumn("rk", F.row_number().over(w).cast("bigint"))
            .filter(F.col("rk") <= cut))


def _check_param(model: str, param: float | None) -> float:
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; choose from {MODELS}")
    if model == "jm":
        if param is None or not (0.0 < param <= 1.0):
            raise ValueError("Jelinek-Mercer lambda must be in (0, 1]")
    if model == "dirichlet" and (param is None or param < 0):
        raise ValueError("Dirichlet mu must be >= 0")
    return float(param or 0.0)


def rank(index: Index, queries: DataFrame, model: str = "jm", param: float | None = 0.5,
         cut: int = 10, analyzer: str | None = None, k1: float = BM25_K1,
         b: float = BM25_B) -> DataFrame:
    """Run (query_id, rk, doc_id, score) of one model for a query batch."""
    p = _check_param(model, param)
    qt = query_terms(queries, analyzer or index.analyzer, stop_words=index.stop_words)
    return best(index, qt, model, [p], cut, k1, b).select("query_id", "rk", "doc_id", "score")


def rank_grid(index: Index, queries: DataFrame, model: str | None, params, cut: int = 10,
              analyzer: str | None = None) -> DataFrame:
    """Run (model, param, query_id, rk, doc_id, score) for every grid value,
    or every (model, value) pair when ``model`` is None (one scoring pass;
    see ``score``)."""
    qt = query_terms(queries, analyzer or index.analyzer, stop_words=index.stop_words)
    return best(index, qt, model, params, cut)


def best(index: Index, qterms: DataFrame, model: str | None, params, cut: int, k1: float = BM25_K1,
         b: float = BM25_B) -> DataFrame:
    """(spec, model, param, query_id, doc_id, score, rk): the first ``cut`` hits per query and
    (model, parameter) pair. Weights are made once per posting and multiplied with the
    queries some documents at a time (``docscores``), so that no row is made per query and
    posting; a query batch beyond the bound of that is joined (``score``)."""
    table = query_table(qterms)
    if table is None:
        return top_k(score(index, qterms, model, params, k1, b, cut if len(params) > 1 and _large(index) else None), cut)
    specs = _specs(model, params)
    stats = index.terms.join(F.broadcast(numbered_terms(index.terms, table)), "term")
    feats = index.postings.select("doc_id", "term", "tf", "dl").join(F.broadcast(stats), "term")
    args = (F.col("tf"), F.col("dl"), F.col("df"), F.col("cf"), *corpus_scalars(index), k1, b)
    scored = best_scores(feats, table, qterms.schema["query_id"].dataType, [weight(m, v, *args) for m, v in specs], cut,
                         SCORE_DECIMALS)
    names, values = (F.element_at(F.array(*[F.lit(s[i]) for s in specs]), F.col("spec") + 1) for i in (0, 1))
    return top_k(scored, cut).select("spec", names.alias("model"), values.alias("param"), "query_id", "doc_id", "score", "rk")


#: Documents from which a grid is ranked with thresholds. The rows are the same either way;
#: the first pass costs more than it saves on a small index.
DEFAULT_THRESHOLD_DOCS = 1_000_000
CONF_THRESHOLD_DOCS = "quire.rank.thresholdDocs"


def _large(index: Index) -> bool:
    least = index.corpus.sparkSession.conf.get(CONF_THRESHOLD_DOCS, None)
    return index.corpus.select("n_docs_nonempty").first()[0] >= int(least or DEFAULT_THRESHOLD_DOCS)


def total_hits(index: Index, queries: DataFrame, analyzer: str | None = None) -> DataFrame:
    """Number of matching documents per query (exact, before the cut);
    queries without a match report 0."""
    qt = query_terms(queries, analyzer or index.analyzer, stop_words=index.stop_words)
    matched = (candidates(index, qt).select("query_id", "doc_id").distinct()
               .groupBy("query_id").agg(F.count(F.lit(1)).alias("total_hits")))
    return (queries.select("query_id").distinct().join(matched, "query_id", "left")
            .select("query_id", F.coalesce("total_hits", F.lit(0)).cast("bigint").alias("total_hits")))


def page(run: DataFrame, page_no: int, page_size: int) -> DataFrame:
    """Ranks (page_no-1)*page_size+1 .. page_no*page_size."""
    if page_size < 1 or page_no < 1:
        raise ValueError("page number and size must be >= 1")
    lo = (page_no - 1) * page_size + 1
    return run.filter(F.col("rk").between(lo, lo + page_size - 1))


def hits_with_fields(run: DataFrame, docs: DataFrame, fields=("source", "lang")) -> DataFrame:
    """Stored fields of the hits only. The run (queries x cut) is size-checked
    and broadcast into the scan of the stored fields."""
    return join_small(docs.select("doc_id", *fields), run, "doc_id", "inner")
