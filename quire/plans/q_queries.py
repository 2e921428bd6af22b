"""Registered queries: structured queries and field choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.analysis import ENGLISH_STOP_WORDS
from quire.operators.ranking import query_terms, rank
from quire.operators.structured import boolean_rank, fuzzy_expansion, wildcard_rank
from quire.plans.indexes import corpus_index, field_index
from quire.plans.registry import register
from quire.plans.sqlparts import FEAT_CTE, INDEX_CTES, QUERY_CTES, weight_sql
from quire.sources.tables import benchmark_queries

CUT = 10
_STOPS = "[" + ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS) + "]"


def _top(select_scores: str, cut: int = CUT) -> str:
    return f"""
, r AS (SELECT query_id, doc_id, score,
               row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::BIGINT AS rk
        FROM ({select_scores}))
SELECT query_id, rk, doc_id, score FROM r WHERE rk <= {cut}"""


_TITLE = r"regexp_extract(html, '<title>(.*?)</title>', 1)"


@register("field_search", f"""
WITH {INDEX_CTES.replace("FROM documents", "FROM (SELECT page_id AS doc_id, " + _TITLE + " AS text FROM pages)")
                 .replace("(SELECT count(*) FROM documents)", "(SELECT count(*) FROM pages)")},
{QUERY_CTES},
{FEAT_CTE}""" + _top(
    f"SELECT query_id, doc_id, round(sum(qtf * ({weight_sql('bm25', '0')})), 6) AS score "
    "FROM feat GROUP BY query_id, doc_id"))
def field_search(spark, sf_dir):
    """Search another field -- the <title> of the raw pages -- with BM25
    (one index per field, so statistics are per field)."""
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    idx = field_index(spark, sf_dir, "pages", "page_id", title, "title")
    return rank(idx, benchmark_queries(spark, sf_dir), "bm25", None, CUT)


def _clauses(spark, sf_dir, mode):
    qt = query_terms(benchmark_queries(spark, sf_dir), "standard")
    if mode == "must":
        return qt.withColumn("occur", F.lit("must"))
    stop = F.col("term").isin(list(ENGLISH_STOP_WORDS))
    return qt.withColumn("occur", F.when(stop, F.lit("must_not")).otherwise(F.lit("should")))


_BOOL_BASE = f"""
WITH {INDEX_CTES},
{QUERY_CTES},
{FEAT_CTE}"""


@register("bool_must", _BOOL_BASE + """
, nq AS (SELECT query_id, count(*) AS need FROM qt GROUP BY query_id),
agg AS (SELECT query_id, doc_id, count(*) AS got, round(sum(qtf * (""" + weight_sql("bm25", "0") + """)), 6) AS score
        FROM feat GROUP BY query_id, doc_id)""" + _top(
    "SELECT a.query_id, a.doc_id, a.score FROM agg a JOIN nq USING (query_id) WHERE a.got = nq.need"))
def bool_must(spark, sf_dir):
    """Every term of the passage required (+t1 +t2 ...), BM25 scored."""
    return boolean_rank(corpus_index(spark, sf_dir), _clauses(spark, sf_dir, "must"), "bm25")


@register("bool_must_not", f"""
WITH {INDEX_CTES},
{QUERY_CTES},
qn AS (SELECT query_id, term, qtf, list_contains({_STOPS}, term) AS neg FROM qt),
fe AS (
  SELECT qn.query_id, qn.qtf, qn.neg, p.doc_id, p.tf::DOUBLE AS tf, d.dl::DOUBLE AS dl,
         t.df::DOUBLE AS df, c.n_docs_nonempty::DOUBLE AS n_ne, c.avgdl
  FROM qn JOIN post p ON p.term = qn.term JOIN dlen d ON d.doc_id = p.doc_id
  JOIN tstat t ON t.term = qn.term CROSS JOIN corp c),
agg AS (
  SELECT query_id, doc_id, sum(CASE WHEN neg THEN 1 ELSE 0 END) AS bad,
         sum(CASE WHEN neg THEN 0 ELSE 1 END) AS pos,
         round(sum(CASE WHEN neg THEN NULL ELSE qtf * ({weight_sql("bm25", "0")}) END), 6) AS score
  FROM fe GROUP BY query_id, doc_id)""" + _top(
    "SELECT query_id, doc_id, score FROM agg WHERE bad = 0 AND pos > 0"))
def bool_must_not(spark, sf_dir):
    """The passage's non-stop words as optional terms, its stop words
    prohibited (-the -of ...): documents with any prohibited word are out."""
    return boolean_rank(corpus_index(spark, sf_dir), _clauses(spark, sf_dir, "must_not"), "bm25")


@register("wildcard", f"""
WITH {INDEX_CTES},
{QUERY_CTES},
exp AS (SELECT DISTINCT qt.query_id, qt.term AS pattern, t.term
        FROM qt JOIN tstat t ON starts_with(t.term, qt.term)),
hits AS (SELECT DISTINCT e.query_id, e.pattern, p.doc_id FROM exp e JOIN post p ON p.term = e.term)"""
          + _top("SELECT query_id, doc_id, count(*)::DOUBLE AS score FROM hits GROUP BY query_id, doc_id"))
def wildcard(spark, sf_dir):
    """Every passage word as a prefix query ``word*`` expanded over the
    vocabulary; constant score per matched pattern, top 10."""
    patterns = query_terms(benchmark_queries(spark, sf_dir), "standard").select(
        "query_id", F.col("term").alias("pattern"))
    return wildcard_rank(corpus_index(spark, sf_dir), patterns, CUT)


@register("wildcard_inner", f"""
WITH {INDEX_CTES},
{QUERY_CTES},
pat AS (
  SELECT DISTINCT query_id, substr(term, 1, 2) || '*' || substr(term, length(term) - 1, 2) AS pattern FROM qt WHERE length(term) >= 5
  UNION
  SELECT query_id, substr(term, 1, 1) || '?' || substr(term, 3) FROM qt WHERE length(term) >= 4
  UNION
  SELECT query_id, '*' || substr(term, length(term) - 3, 4) FROM qt WHERE length(term) >= 6),
exp AS (SELECT DISTINCT pat.query_id, pat.pattern, t.term
        FROM pat JOIN tstat t ON t.term LIKE replace(replace(pat.pattern, '*', '%'), '?', '_')),
hits AS (SELECT DISTINCT e.query_id, e.pattern, p.doc_id FROM exp e JOIN post p ON p.term = e.term)"""
          + _top("SELECT query_id, doc_id, count(*)::DOUBLE AS score FROM hits GROUP BY query_id, doc_id"))
def wildcard_inner(spark, sf_dir):
    """``*`` inside and at the beginning, ``?`` inside, made of the passage words."""
    qt = query_terms(benchmark_queries(spark, sf_dir), "standard")
    t, n = F.col("term"), F.length("term")
    made = F.array(F.when(n >= 5, F.concat(F.substring(t, 1, 2), F.lit("*"), F.substring(t, n - 1, F.lit(2)))),
                   F.when(n >= 4, F.concat(F.substring(t, 1, 1), F.lit("?"), F.substring(t, F.lit(3), n))),
                   F.when(n >= 6, F.concat(F.lit("*"), F.substring(t, n - 3, F.lit(4)))))
    patterns = qt.select("query_id", F.explode(F.array_compact(made)).alias("pattern"))
    return wildcard_rank(corpus_index(spark, sf_dir), patterns, CUT, prefixes=False)


# The SQL engine's distances count bytes: every letter outside ASCII is first replaced by
# an ASCII capital of its own (terms are lower case, so capitals are free).
_ONE_BYTE = "translate({}, 'àáâãäåæçèéêëìíîïñòóôõöøùúûüßœ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ@#$')"


def _fuzzy_sql(distance: str, k: int) -> str:
    q, t = _ONE_BYTE.format("q.term"), _ONE_BYTE.format("t.term")
    return f"""
WITH {INDEX_CTES},
{QUERY_CTES},
words AS (SELECT DISTINCT term FROM qt),
near AS (
  SELECT q.term, t.term AS match, {distance}({q}, {t})::BIGINT AS distance
  FROM words q JOIN tstat t ON abs(length(q.term) - length(t.term)) <= {k})
SELECT qt.query_id, qt.term, near.match, near.distance FROM qt JOIN near USING (term) WHERE distance <= {k}"""


@register("fuzzy", _fuzzy_sql("levenshtein", 2))
def fuzzy(spark, sf_dir):
    """Every passage word expanded to the vocabulary terms within edit
    distance 2 (exact, uncapped), over characters."""
    qt = query_terms(benchmark_queries(spark, sf_dir), "standard")
    return fuzzy_expansion(corpus_index(spark, sf_dir).terms, qt, 2)


@register("fuzzy_transpositions", _fuzzy_sql("damerau_levenshtein", 1))
def fuzzy_transpositions(spark, sf_dir):
    """R17 with adjacent swaps counted as one edit (optimal string alignment),
    distance 1."""
    qt = query_terms(benchmark_queries(spark, sf_dir), "standard")
    return fuzzy_expansion(corpus_index(spark, sf_dir).terms, qt, 1, transpositions=True)
