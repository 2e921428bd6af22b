"""Registered queries: index build and collection statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators.index import (approximate_terms, index_stats, merge_postings, term_counts, term_sketch,
                                   term_stats)
from quire.plans.indexes import corpus_index
from quire.plans.registry import register
from quire.plans.sqlparts import INDEX_CTES
from quire.sources.tables import documents


@register("term_freq", f"""
WITH {INDEX_CTES}
SELECT p.doc_id, p.term, p.tf, d.dl FROM post p JOIN dlen d USING (doc_id)""")
def term_freq(spark, sf_dir):
    """G1: occurrences per (document, term), with the document length."""
    return corpus_index(spark, sf_dir).postings.select("doc_id", "term", "tf", "dl")


@register("doc_freq", f"""
WITH {INDEX_CTES}
SELECT term, df, cf FROM tstat""")
def doc_freq(spark, sf_dir):
    """Documents containing the term, occurrences in the collection."""
    return corpus_index(spark, sf_dir).terms.select("term", "df", "cf")


@register("collection_stats", f"""
WITH {INDEX_CTES}
SELECT t.term, t.df, t.cf,
       round((t.cf + 1.0) / (c.n_tokens + 1.0), 12) AS p_coll
FROM tstat t CROSS JOIN corp c""")
def collection_stats(spark, sf_dir):
    """Collection probability (cf + 1) / (T + 1) of every term."""
    idx = corpus_index(spark, sf_dir)
    n_tokens = idx.corpus.select("n_tokens").scalar()
    return idx.terms.select(
        "term", "df", "cf",
        F.round((F.col("cf") + F.lit(1.0)) / (n_tokens + F.lit(1.0)), 12).alias("p_coll"))


@register("doc_length", f"""
WITH {INDEX_CTES}
SELECT doc_id, dl FROM dlen""")
def doc_length(spark, sf_dir):
    """Tokens per document (documents with at least one token)."""
    return corpus_index(spark, sf_dir).doclen.select("doc_id", "dl")


@register("index_stats", f"""
WITH {INDEX_CTES}
SELECT c.n_docs, c.n_docs_nonempty, c.n_tokens, (SELECT count(*) FROM tstat)::BIGINT AS n_terms
FROM corp c""")
def index_stats_q(spark, sf_dir):
    """Documents, documents with a term, tokens, distinct terms."""
    return index_stats(corpus_index(spark, sf_dir))


@register("merge_index", f"""
WITH {INDEX_CTES}
SELECT term, df, cf FROM tstat""")
def merge_index(spark, sf_dir):
    """K4: partial indexes built per language group, merged by union; the
    statistics recomputed after the union equal those of one global build."""
    docs = documents(spark, sf_dir)
    parts = [term_counts(docs.filter(F.col("lang") == "en"), "standard", text_col="contents"),
             term_counts(docs.filter((F.col("lang") != "en") | F.col("lang").isNull()),
                         "standard", text_col="contents")]
    return term_stats(merge_postings(*parts)).select("term", "df", "cf")


@register("distinct_terms_sketch", f"""
WITH {INDEX_CTES}
SELECT (SELECT count(*) FROM tstat)::BIGINT AS n_terms, true AS within_error""")
def distinct_terms_sketch(spark, sf_dir):
    """G6/K4 at scale: the distinct terms of the whole collection by its exact count, and
    whether sketches made per language group and united estimate it within four standard
    errors."""
    docs = documents(spark, sf_dir)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    parts = [term_sketch(term_counts(docs.filter(which), "standard", text_col="contents")) for which in (english, ~english)]
    exact = corpus_index(spark, sf_dir).terms.agg(F.count(F.lit(1))).scalar()
    return approximate_terms(*parts).select(
        exact.alias("n_terms"), (F.abs(F.col("n_terms") - exact) <= 4 * F.col("error") * exact).alias("within_error"))
