"""Registered queries: analyzers, term vectors, phrases."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.analysis import ENGLISH_STOP_WORDS, token_array
from quire.operators.index import explode_terms, term_counts
from quire.operators.vectors import phrase_matches, phrase_places, term_vectors
from quire.plans.registry import register
from quire.plans.sqlparts import WORD
from quire.sources.tables import benchmark_queries, documents


def _vocab(spark, sf_dir, analyzer):
    """(term, cf): every token of every document, counted."""
    d = documents(spark, sf_dir).select("doc_id", token_array("contents", analyzer).alias("_toks"))
    return explode_terms(d, []).groupBy("term").agg(F.count(F.lit(1)).cast("bigint").alias("cf"))


def _vocab_sql(expr: str) -> str:
    return f"""
SELECT term, count(*)::BIGINT AS cf FROM (SELECT unnest({expr}) AS term FROM documents)
GROUP BY term"""


_STOP_SQL_LIST = "[" + ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS) + "]"


@register("tok_whitespace", _vocab_sql(r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"))
def tok_whitespace(spark, sf_dir):
    """A1: white-space tokens, case kept."""
    return _vocab(spark, sf_dir, "whitespace")


@register("tok_simple", _vocab_sql(r"regexp_extract_all(lower(text), '\p{L}+')"))
def tok_simple(spark, sf_dir):
    """A2: runs of letters, lower-cased."""
    return _vocab(spark, sf_dir, "simple")


@register("tok_keyword", _vocab_sql("[trim(text)]"))
def tok_keyword(spark, sf_dir):
    """A3: the whole trimmed text is one term."""
    return _vocab(spark, sf_dir, "keyword")


@register("tok_standard", _vocab_sql(f"regexp_extract_all(lower(text), '{WORD}')"))
def tok_standard(spark, sf_dir):
    """A4: runs of letters and digits, lower-cased."""
    return _vocab(spark, sf_dir, "standard")


@register("tok_stop", _vocab_sql(
    rf"list_filter(regexp_extract_all(lower(text), '\p{{L}}+'), lambda x: NOT list_contains({_STOP_SQL_LIST}, x))"))
def tok_stop(spark, sf_dir):
    """Letters, lower-cased, English stop words removed."""
    return _vocab(spark, sf_dir, "stop")


# A text and its string of classes have equal length: letters are @, digits 0, what joins
# two of either is +; of the text the characters of these classes and _ stay.
_CLASSES = r"""regexp_replace(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_''’.:·,;]', ' ', 'g'), '\p{L}', '@', 'g'), '\p{N}', '0', 'g')"""
for _pattern in ("(@)[''’.:·](@)", "(0)[,.;''’](0)"):
    for _ in range(2):                               # a second time for what met the first match
        _CLASSES = rf"regexp_replace({_CLASSES}, '{_pattern}', '\1+\2', 'g')"
_UAX_SQL = rf"""
WITH c AS (SELECT regexp_extract_all(lower(text), '(?s).') AS ch, regexp_extract_all({_CLASSES}, '(?s).') AS k FROM documents),
m AS (SELECT array_to_string(list_transform(list_zip(ch, k), lambda x: CASE WHEN x[2] IN ('@', '0', '_', '+') THEN x[1] ELSE ' ' END), '') AS t FROM c)
SELECT term, count(*)::BIGINT AS cf FROM (SELECT unnest(regexp_extract_all(t, '[^ ]+')) AS term FROM m) GROUP BY term"""


@register("tok_standard_uax", _UAX_SQL)
def tok_standard_uax(spark, sf_dir):
    """A4 (fuller form): in-word apostrophes, dots, digit separators and
    underscores kept inside tokens. Look-around here; the SQL, which has none,
    matches on a string of character classes."""
    return _vocab(spark, sf_dir, "standard_uax")


@register("tok_english")
def tok_english(spark, sf_dir):
    """Possessive removal, English stop words, Porter stemming (stems
    computed once per distinct term of a batch of texts)."""
    d = documents(spark, sf_dir)
    return (term_counts(d, "english", text_col="contents", united=False).groupBy("term")
            .agg(F.sum("tf").cast("bigint").alias("cf")))


@register("tok_spanish")
def tok_spanish(spark, sf_dir):
    """Spanish stop words and light stemming over all documents."""
    d = documents(spark, sf_dir)
    return (term_counts(d, "spanish", text_col="contents", united=False).groupBy("term")
            .agg(F.sum("tf").cast("bigint").alias("cf")))


@register("term_vectors", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS toks FROM documents),
p AS (SELECT doc_id, unnest(toks) AS term, unnest(range(0, len(toks))) AS pos FROM t)
SELECT doc_id, term, count(*)::BIGINT AS freq, list_sort(list(pos::BIGINT)) AS positions
FROM p GROUP BY doc_id, term""")
def term_vectors_q(spark, sf_dir):
    """Per document and term: frequency and token positions."""
    return term_vectors(documents(spark, sf_dir))


@register("term_vector_offsets", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS toks,
                  regexp_split_to_array(text, '{WORD}') AS seps FROM documents),
p AS (SELECT doc_id, unnest(range(0, len(toks))) AS pos, unnest(toks) AS tok,
             unnest(seps[1:len(toks)]) AS sep FROM t),
c AS (SELECT doc_id, pos, lower(tok) AS term,
             sum(length(sep) + length(tok)) OVER (PARTITION BY doc_id ORDER BY pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e,
             length(tok) AS lt FROM p)
SELECT doc_id, term, count(*)::BIGINT AS freq,
       list(pos::BIGINT ORDER BY pos) AS positions,
       list((e - lt)::BIGINT ORDER BY pos) AS start_offsets,
       list(e::BIGINT ORDER BY pos) AS end_offsets
FROM c GROUP BY doc_id, term""")
def term_vector_offsets(spark, sf_dir):
    """Positions plus start/end character offsets of every occurrence."""
    return term_vectors(documents(spark, sf_dir), offsets=True)


@register("phrase", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS toks FROM documents),
db AS (SELECT DISTINCT doc_id, toks[i] || ' ' || toks[i + 1] AS bg
       FROM (SELECT doc_id, toks, unnest(range(1, len(toks))) AS i FROM t)),
q AS (SELECT item_id AS query_id, regexp_extract_all(lower(text), '{WORD}') AS toks FROM benchmark),
qb AS (SELECT DISTINCT query_id, toks[i] || ' ' || toks[i + 1] AS bg
       FROM (SELECT query_id, toks, unnest(range(1, len(toks))) AS i FROM q))
SELECT qb.query_id, db.doc_id, count(*)::BIGINT AS n_phrases
FROM qb JOIN db USING (bg) GROUP BY qb.query_id, db.doc_id""")
def phrase_q(spark, sf_dir):
    """Every adjacent word pair of each passage as a phrase query;
    documents matching at least one, with the number matched."""
    from quire.plans.indexes import corpus_index
    shingles = corpus_index(spark, sf_dir, "shingle2")
    return phrase_matches(shingles.postings, benchmark_queries(spark, sf_dir))


@register("phrase_long", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS toks FROM documents),
q AS (SELECT item_id, regexp_extract_all(lower(text), '{WORD}') AS toks FROM benchmark),
ph AS (SELECT item_id * 10000 + i AS phrase_id, toks[i + 1 : i + 4] AS w
       FROM (SELECT item_id, toks, unnest(range(0, len(toks) - 3)) AS i FROM q)),
f AS (SELECT DISTINCT w[1] || ' ' || w[2] || ' ' || w[3] || ' ' || w[4] AS g FROM ph),
d AS (SELECT doc_id, toks[i] || ' ' || toks[i + 1] || ' ' || toks[i + 2] || ' ' || toks[i + 3] AS g
      FROM (SELECT doc_id, toks, unnest(range(1, len(toks) - 2)) AS i FROM t))
SELECT ph.phrase_id, d.doc_id, count(*)::BIGINT AS n_places
FROM ph JOIN d ON d.g = ph.w[1] || ' ' || ph.w[2] || ' ' || ph.w[3] || ' ' || ph.w[4]
GROUP BY ph.phrase_id, d.doc_id""".replace("f AS (SELECT DISTINCT w[1] || ' ' || w[2] || ' ' || w[3] || ' ' || w[4] AS g FROM ph),\n", ""))
def phrase_long(spark, sf_dir):
    """Every four consecutive words of each passage as a phrase; how often
    each document has them, from the positions of an index."""
    from quire.plans.indexes import corpus_index
    words = benchmark_queries(spark, sf_dir).select("query_id", token_array(F.lower("text"), "standard").alias("w"))
    four = (words.select("query_id", F.posexplode(F.when(F.size("w") > 3, F.transform(
        F.sequence(F.lit(1), F.size("w") - 3), lambda i: F.array_join(F.slice("w", i, 4), " "))).otherwise(
        F.array().cast("array<string>"))).alias("i", "text")))
    phrases = four.select((F.col("query_id") * 10000 + F.col("i")).alias("phrase_id"), "text")
    return phrase_places(corpus_index(spark, sf_dir, positions=True), phrases)
