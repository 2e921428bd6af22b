"""Registered queries: evaluation of runs against judgements."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators.evaluation import (eval_report, mean_metrics, metrics, metrics_long,
                                        ranked_list, tag_relevance, unjudged_queries)
from quire.operators.ranking import rank
from quire.plans.indexes import corpus_index, corpus_qrels
from quire.plans.registry import register
from quire.plans.sqlparts import (FEAT_CTE, INDEX_CTES, QUERY_CTES, eval_sql, metrics_ctes,
                                  qrels_cte, run_cte)
from quire.sources.tables import benchmark_queries, derived_qrels, documents, verbatim_qrels

CUT = 10


def _setup(spark, sf_dir, model="jm", param=0.5, cut=CUT, analyzer="standard"):
    std = corpus_index(spark, sf_dir, "standard")
    idx = std if analyzer == "standard" else corpus_index(spark, sf_dir, analyzer)
    q = benchmark_queries(spark, sf_dir)
    run = rank(idx, q, model, param, cut)
    qrels = corpus_qrels(spark, sf_dir)
    return q, run, qrels


@register("tag_relevance", eval_sql("SELECT query_id, rk, doc_id, score, rel FROM tagged"))
def tag_relevance_q(spark, sf_dir):
    """Every hit tagged relevant or not (judgements de-duplicated)."""
    q, run, qrels = _setup(spark, sf_dir)
    return tag_relevance(run, qrels).select("query_id", "rk", "doc_id", "score", "rel")


@register("qrels_derived", f"""
WITH {INDEX_CTES},
{qrels_cte(0.4)}
SELECT query_id, doc_id FROM qrels""")
def qrels_derived(spark, sf_dir):
    """S11 input, derived: judgements from the tables -- >= 40% of the
    passage's distinct terms occur in the document (postings join, no
    all-pairs product)."""
    q = benchmark_queries(spark, sf_dir)
    return derived_qrels(q, corpus_index(spark, sf_dir).postings)


@register("qrels_verbatim", f"""
WITH {INDEX_CTES},
{qrels_cte(1.0)}
SELECT r.query_id, r.doc_id FROM qrels r
JOIN benchmark b ON b.item_id = r.query_id
JOIN documents d ON d.doc_id = r.doc_id
WHERE contains(d.text, b.text)""")
def qrels_verbatim(spark, sf_dir):
    """S11 input, derived: the document contains the passage verbatim
    (all-terms pre-filter through the postings, then a substring test on the
    candidates only)."""
    q = benchmark_queries(spark, sf_dir)
    return verbatim_qrels(q, documents(spark, sf_dir), corpus_index(spark, sf_dir).postings)


@register("metrics", eval_sql("SELECT query_id, n_hits, p, ap, recall, rr FROM m"))
def metrics_q(spark, sf_dir):
    """P@10, AP@10 (over hits returned), recall@10, RR of JM 0.5."""
    q, run, qrels = _setup(spark, sf_dir)
    return metrics(run, qrels, q)


@register("metrics_bm25", eval_sql("SELECT query_id, n_hits, p, ap, recall, rr FROM m",
                                   model="bm25", param=0.0))
def metrics_bm25(spark, sf_dir):
    """E2-E5 on the BM25 run."""
    q, run, qrels = _setup(spark, sf_dir, "bm25", None)
    return metrics(run, qrels, q)


_KEYWORD_SQL = rf"""
WITH {INDEX_CTES},
kpost AS (SELECT doc_id, trim(text) AS term FROM documents),
kq AS (SELECT item_id AS query_id, trim(lower(text)) AS term FROM benchmark),
kdocs AS (SELECT DISTINCT kq.query_id, kpost.doc_id FROM kq JOIN kpost USING (term)),
run AS (
  SELECT query_id, doc_id, 0.0 AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY doc_id)::BIGINT AS rk
  FROM kdocs QUALIFY rk <= {CUT}),
{qrels_cte(0.4)},
qsel AS (SELECT item_id AS query_id FROM benchmark),
{metrics_ctes()}
SELECT query_id, n_hits, p, ap, recall, rr FROM m"""


@register("metrics_zero_hits", _KEYWORD_SQL)
def metrics_zero_hits(spark, sf_dir):
    """Keyword analyzer -- a whole passage rarely equals a whole document,
    so queries return no hit; they score 0 and still count."""
    q, run, qrels = _setup(spark, sf_dir, "boolean", None, analyzer="keyword")
    return metrics(run, qrels, q)


@register("mean_metrics", eval_sql("""
SELECT count(*)::BIGINT AS n_queries,
       round(coalesce(avg(p), 0), 9) AS mean_p, round(coalesce(avg(ap), 0), 9) AS mean_ap,
       round(coalesce(avg(recall), 0), 9) AS mean_recall, round(coalesce(avg(rr), 0), 9) AS mean_rr
FROM m"""))
def mean_metrics_q(spark, sf_dir):
    """Means over queries (0 when there are none)."""
    q, run, qrels = _setup(spark, sf_dir)
    return mean_metrics(metrics(run, qrels, q))


@register("eval_report", eval_sql("""
SELECT CASE WHEN grouping(query_id) = 1 THEN 'average' ELSE CAST(query_id AS VARCHAR) END AS query,
       coalesce(round(avg(p), 9), 0) AS p, coalesce(round(avg(ap), 9), 0) AS ap,
       coalesce(round(avg(recall), 9), 0) AS recall, coalesce(round(avg(rr), 9), 0) AS rr,
       10::BIGINT AS cut
FROM m GROUP BY ROLLUP (query_id)"""))
def eval_report_q(spark, sf_dir):
    """Per-query rows plus the ``average`` row, cut recorded."""
    q, run, qrels = _setup(spark, sf_dir)
    return eval_report(metrics(run, qrels, q), CUT)


@register("ranked_list", eval_sql("""
SELECT query_id, rk, doc_id, rel,
       CASE WHEN rel = 1 THEN round(cum_rel::DOUBLE / rk, 9) END AS running_precision
FROM cum WHERE rk <= 5"""))
def ranked_list_q(spark, sf_dir):
    """First 5 of the top-10 run with running precision."""
    q, run, qrels = _setup(spark, sf_dir)
    return ranked_list(run, qrels, 5)


@register("metrics_long", eval_sql("""
SELECT query_id, 'P' AS metric, p AS value FROM m UNION ALL
SELECT query_id, 'MAP', ap FROM m UNION ALL
SELECT query_id, 'R', recall FROM m UNION ALL
SELECT query_id, 'MRR', rr FROM m"""))
def metrics_long_q(spark, sf_dir):
    """Metric choice as a long table (P, MAP, R, MRR)."""
    q, run, qrels = _setup(spark, sf_dir)
    return metrics_long(metrics(run, qrels, q))


_VERBATIM = rf"""
WITH {INDEX_CTES},
{QUERY_CTES},
{FEAT_CTE},
{run_cte("jm", 0.5, CUT)},
{qrels_cte(1.0).replace("qrels AS", "allterms AS")},
qrels AS (
  SELECT r.query_id, r.doc_id FROM allterms r
  JOIN benchmark b ON b.item_id = r.query_id JOIN documents d ON d.doc_id = r.doc_id
  WHERE contains(d.text, b.text)),
qsel AS (SELECT item_id AS query_id FROM benchmark),
{metrics_ctes()}"""


@register("metrics_verbatim", _VERBATIM + "\nSELECT query_id, n_hits, p, ap, recall, rr FROM m")
def metrics_verbatim(spark, sf_dir):
    """E1-E5 with unjudged queries: with verbatim judgements
    some queries have none; they are dropped from the evaluation, not failed."""
    q = benchmark_queries(spark, sf_dir)
    idx = corpus_index(spark, sf_dir)
    qrels = verbatim_qrels(q, documents(spark, sf_dir), idx.postings)
    return metrics(rank(idx, q, "jm", 0.5, CUT), qrels, q)


@register("unjudged_queries", _VERBATIM + """
SELECT (SELECT count(*) FROM benchmark b
        WHERE b.item_id NOT IN (SELECT query_id FROM qrels))::BIGINT AS n_unjudged""")
def unjudged_queries_q(spark, sf_dir):
    """E7 / SURVEY 7.4 #4: the number of selected queries dropped for lack of
    judgements (reported, not silently lost)."""
    q = benchmark_queries(spark, sf_dir)
    idx = corpus_index(spark, sf_dir)
    qrels = verbatim_qrels(q, documents(spark, sf_dir), idx.postings)
    return unjudged_queries(q, qrels).agg(F.count(F.lit(1)).cast("bigint").alias("n_unjudged"))
