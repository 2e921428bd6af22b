"""Registered queries: ranking models and hit handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.analysis import ENGLISH_STOP_WORDS
from quire.operators.index import open_index, write_index
from quire.operators.ranking import (hits_with_fields, page, query_terms, rank,
                                     total_hits)
from quire.plans.indexes import corpus_index
from quire.plans.registry import register
from quire.plans.sqlparts import INDEX_CTES, QUERY_CTES, ranked_sql
from quire.session import scratch_path
from quire.sources.collection import read_stopwords
from quire.sources.tables import benchmark_queries, documents

CUT = 10


def _rank(spark, sf_dir, model, param, cut=CUT):
    idx = corpus_index(spark, sf_dir)
    return rank(idx, benchmark_queries(spark, sf_dir), model, param, cut)


@register("rank_jm", ranked_sql("jm", 0.5, CUT))
def rank_jm(spark, sf_dir):
    """Jelinek-Mercer, lambda = 0.5, top 10 for every benchmark query."""
    return _rank(spark, sf_dir, "jm", 0.5)


@register("rank_dirichlet", ranked_sql("dirichlet", 2000.0, CUT))
def rank_dirichlet(spark, sf_dir):
    """Dirichlet prior, mu = 2000."""
    return _rank(spark, sf_dir, "dirichlet", 2000.0)


@register("rank_dirichlet_mu0", ranked_sql("dirichlet", 0.0, CUT))
def rank_dirichlet_mu0(spark, sf_dir):
    """R4 edge: mu = 0 scores every match 0, so the order is by doc id."""
    return _rank(spark, sf_dir, "dirichlet", 0.0)


@register("rank_jm_l1", ranked_sql("jm", 1.0, CUT))
def rank_jm_l1(spark, sf_dir):
    """R3 edge: lambda = 1 scores every match 0."""
    return _rank(spark, sf_dir, "jm", 1.0)


@register("rank_boolean", ranked_sql("boolean", 0.0, CUT))
def rank_boolean(spark, sf_dir):
    """Boolean similarity, 1 per matching query term occurrence."""
    return _rank(spark, sf_dir, "boolean", None)


@register("rank_bm25", ranked_sql("bm25", 0.0, CUT))
def rank_bm25(spark, sf_dir):
    """BM25, k1 = 1.2, b = 0.75."""
    return _rank(spark, sf_dir, "bm25", None)


@register("top_k", ranked_sql("jm", 0.1, 100))
def top_k_q(spark, sf_dir):
    """A deeper cut (100) with lambda = 0.1."""
    return _rank(spark, sf_dir, "jm", 0.1, cut=100)


@register("query_terms", f"""
WITH {QUERY_CTES}
SELECT query_id, term, qtf FROM qt""")
def query_terms_q(spark, sf_dir):
    """Analysed queries; a repeated word keeps its count (qtf)."""
    return query_terms(benchmark_queries(spark, sf_dir), "standard")


@register("total_hits", f"""
WITH {INDEX_CTES},
{QUERY_CTES}
SELECT b.item_id AS query_id, count(DISTINCT p.doc_id)::BIGINT AS total_hits
FROM benchmark b LEFT JOIN qt ON qt.query_id = b.item_id
LEFT JOIN post p ON p.term = qt.term
GROUP BY b.item_id""")
def total_hits_q(spark, sf_dir):
    """Exact number of matching documents per query."""
    return total_hits(corpus_index(spark, sf_dir), benchmark_queries(spark, sf_dir))


@register("page", f"""
SELECT * FROM ({ranked_sql("bm25", 0.0, 20)}) WHERE rk BETWEEN 11 AND 20""")
def page_q(spark, sf_dir):
    """Page 2 of size 10 of the BM25 ranking."""
    return page(_rank(spark, sf_dir, "bm25", None, cut=20), 2, 10)


@register("hits_with_fields", f"""
SELECT r.query_id, r.rk, r.doc_id, r.score, d.source, d.lang
FROM ({ranked_sql("jm", 0.5, CUT)}) r JOIN documents d ON d.doc_id = r.doc_id""")
def hits_with_fields_q(spark, sf_dir):
    """Stored fields fetched for the hits only."""
    idx = corpus_index(spark, sf_dir)
    run = _rank(spark, sf_dir, "jm", 0.5)
    return hits_with_fields(run, idx.docs, ("source", "lang")).select(
        "query_id", "rk", "doc_id", "score", "source", "lang")


@register("query_subset", f"""
WITH b AS (SELECT min(item_id) AS lo, max(item_id) AS hi FROM benchmark)
SELECT r.* FROM ({ranked_sql("jm", 0.5, CUT)}) r, b
WHERE r.query_id BETWEEN (b.lo + b.hi) // 2 + 1 AND b.hi""")
def query_subset_q(spark, sf_dir):
    """An inclusive id range -- the upper half of the id span, bounds
    computed from the table as scalar subqueries (nothing collected)."""
    q = benchmark_queries(spark, sf_dir)
    lo = q.agg(F.min("query_id")).scalar()
    hi = q.agg(F.max("query_id")).scalar()
    sel = q.filter(F.col("query_id").between(F.floor((lo + hi) / 2) + 1, hi))
    return rank(corpus_index(spark, sf_dir), sel, "jm", 0.5, CUT)


@register("rank_english")
def rank_english(spark, sf_dir):
    """A6 in retrieval: the English analyzer (possessives, stop words, Porter
    stems) at index and query time, BM25 top 10. Stems are computed once per
    distinct term of the documents and of the queries."""
    idx = corpus_index(spark, sf_dir, "english")
    return rank(idx, benchmark_queries(spark, sf_dir), "bm25", None, CUT, analyzer="english")


_STOPPED = "(" + ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS) + ")"


@register("rank_stop_file", ranked_sql("bm25", 0.0, CUT)
          .replace("post AS (\n  SELECT doc_id, term, count(*)::BIGINT AS tf FROM tok GROUP",
                   f"post AS (\n  SELECT doc_id, term, count(*)::BIGINT AS tf FROM tok WHERE term NOT IN {_STOPPED} GROUP")
          .replace("count(*)::BIGINT AS qtf FROM qtok GROUP", f"count(*)::BIGINT AS qtf FROM qtok WHERE term NOT IN {_STOPPED} GROUP"))
def rank_stop_file(spark, sf_dir):
    """S13 end to end: a stop-word file given when the index is created holds for
    appended documents and, from the index, for queries."""
    words = scratch_path(spark, "stop-words")
    spark.createDataFrame([(f" {w} ",) for w in ENGLISH_STOP_WORDS], "value string").coalesce(1).write.text(words)
    path, d = scratch_path(spark, "index-stopped"), documents(spark, sf_dir)
    write_index(spark, d.filter("doc_id % 2 = 0"), path, "create", stop_words=read_stopwords(spark, words))
    write_index(spark, d.filter("doc_id % 2 = 1"), path, "append")
    return rank(open_index(spark, path), benchmark_queries(spark, sf_dir), "bm25", None, CUT)
