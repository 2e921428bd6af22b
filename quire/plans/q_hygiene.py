"""Registered queries: deduplication, deletes, tf-idf top terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators.hygiene import (delete_by_key, dedup_exact, dup_groups, java_string_hash,
                                     kept_ids, tfidf, top_terms)
from quire.operators.index import index_stats, write_index
from quire.plans.indexes import corpus_index
from quire.plans.registry import register
from quire.plans.sqlparts import INDEX_CTES
from quire.plans.workflows import remove_duplicates
from quire.session import scratch_path
from quire.sources.tables import documents, table


@register("dedup_exact", """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY sha256(text))""")
def dedup_exact_q(spark, sf_dir):
    """One document per exact content (lowest id kept)."""
    return dedup_exact(documents(spark, sf_dir)).select("doc_id", "lang", "source", "n_chars")


@register("dup_groups", """
WITH h AS (SELECT sha256(text) AS h, doc_id FROM documents),
g AS (SELECT h, min(doc_id) AS kept_id, count(*)::BIGINT AS n_copies FROM h GROUP BY h
      HAVING count(*) > 1)
SELECT h.doc_id, g.kept_id, g.n_copies FROM h JOIN g USING (h)""")
def dup_groups_q(spark, sf_dir):
    """Members of every group of exact copies, with the kept id."""
    return dup_groups(documents(spark, sf_dir))


@register("dedup_report", f"""
WITH {INDEX_CTES},
kept AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text))
SELECT 'before' AS stage, (SELECT count(*) FROM documents)::BIGINT AS n_docs,
       (SELECT count(DISTINCT term) FROM post)::BIGINT AS n_terms
UNION ALL
SELECT 'after', (SELECT count(*) FROM kept)::BIGINT,
       (SELECT count(DISTINCT term) FROM post WHERE doc_id IN (SELECT doc_id FROM kept))::BIGINT""")
def dedup_report_q(spark, sf_dir):
    """Documents and distinct terms before and after removing copies; the
    after-index is the postings of the kept documents (terms only found in
    deleted documents disappear)."""
    idx = corpus_index(spark, sf_dir)
    kept = kept_ids(documents(spark, sf_dir))
    before = index_stats(idx).select(F.lit("before").alias("stage"), "n_docs", "n_terms")
    after_terms = (idx.postings.join(kept, "doc_id", "left_semi").select("term").distinct()
                   .agg(F.count(F.lit(1)).cast("bigint")).scalar())
    after = kept.agg(F.count(F.lit(1)).cast("bigint").alias("n_docs")).select(
        F.lit("after").alias("stage"), "n_docs", after_terms.alias("n_terms"))
    return before.unionByName(after)


@register("dedup_copy", f"""
WITH {INDEX_CTES},
kept AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text))
SELECT 'before' AS stage, (SELECT count(*) FROM documents)::BIGINT AS n_docs,
       (SELECT count(DISTINCT term) FROM post)::BIGINT AS n_terms
UNION ALL
SELECT 'after', (SELECT count(*) FROM kept)::BIGINT,
       (SELECT count(DISTINCT term) FROM post WHERE doc_id IN (SELECT doc_id FROM kept))::BIGINT""")
def dedup_copy_q(spark, sf_dir):
    """Copies removed into a new index; the statistics of both indexes."""
    path, copy = scratch_path(spark, "index-full"), scratch_path(spark, "index-dedup")
    write_index(spark, documents(spark, sf_dir), path, contents_stored=True)
    return remove_duplicates(spark, path, copy)


@register("delete_by_key", """
SELECT doc_id, lang, source FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def delete_by_key_q(spark, sf_dir):
    """D3: delete documents by key (labelled toxic) with an anti join."""
    keys = table(spark, sf_dir, "labels").filter(F.col("toxic") == 1)
    return delete_by_key(documents(spark, sf_dir), keys).select("doc_id", "lang", "source")


@register("tfidf", f"""
WITH {INDEX_CTES}
SELECT p.doc_id, p.term, p.tf, t.df,
       round(p.tf * log10(c.n_docs::DOUBLE / t.df), 7) AS tfidf
FROM post p JOIN tstat t USING (term) CROSS JOIN corp c""")
def tfidf_q(spark, sf_dir):
    """Tf * log10(N / df) for every posting."""
    return tfidf(corpus_index(spark, sf_dir))


@register("top_terms", f"""
WITH {INDEX_CTES},
w AS (
  SELECT p.doc_id, p.term, p.tf, t.df,
         round(p.tf * log10(c.n_docs::DOUBLE / t.df), 7) AS tfidf
  FROM post p JOIN tstat t USING (term) CROSS JOIN corp c),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term)::BIGINT AS rank
      FROM w)
SELECT doc_id, rank, term, tf, df, tfidf FROM r WHERE rank <= 5""")
def top_terms_q(spark, sf_dir):
    """The 5 best tf-idf terms of every document."""
    return top_terms(corpus_index(spark, sf_dir), 5)


@register("top_terms_range", f"""
WITH {INDEX_CTES},
w AS (
  SELECT p.doc_id, p.term, p.tf, t.df,
         round(p.tf * log10(c.n_docs::DOUBLE / t.df), 7) AS tfidf
  FROM post p JOIN tstat t USING (term) CROSS JOIN corp c WHERE p.doc_id BETWEEN 50 AND 149),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term)::BIGINT AS rank
      FROM w)
SELECT doc_id, rank, term, tf, df, tfidf FROM r WHERE rank <= 3""")
def top_terms_range_q(spark, sf_dir):
    """The report of an id range (the range is the feature); df is the whole collection's."""
    return top_terms(corpus_index(spark, sf_dir), 3, 50, 149)


@register("java_hash", """
WITH units AS (
  SELECT doc_id, flatten(list_transform(string_split(text, ''), lambda c: CASE WHEN unicode(c) < 65536 THEN [unicode(c)::BIGINT]
    ELSE [55296 + ((unicode(c)::BIGINT - 65536) >> 10), 56320 + ((unicode(c)::BIGINT - 65536) & 1023)] END)) AS u
  FROM documents),
h AS (SELECT doc_id, list_reduce([0::BIGINT] || u, lambda a, b: (a * 31 + b) % 4294967296) AS h FROM units)
SELECT doc_id, (CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)::INTEGER AS contents_hash FROM h""")
def java_hash_q(spark, sf_dir):
    """Java String.hashCode of every document text (compatibility key)."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", java_string_hash(F.col("contents")).alias("contents_hash"))


@register("dedup_java_hash", """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY sha256(text))""")
def dedup_java_hash_q(spark, sf_dir):
    """D1 in compatibility mode: keyed by the 32-bit Java hash (on this data
    no two different texts collide, so it equals the sha-256 result)."""
    return dedup_exact(documents(spark, sf_dir), mode="java").select(
        "doc_id", "lang", "source", "n_chars")
