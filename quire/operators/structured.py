"""Structured queries over the index: required/prohibited terms, wildcard and
fuzzy term expansion (R14, R16, R17).

Term expansion always runs over the *vocabulary* (the terms table), never
over postings, and is expressed as equi joins:

- wildcard ``t*``: every vocabulary term is expanded to its prefixes
  (one row per prefix), joined on equality with the patterns;
- fuzzy (edit distance <= k): vocabulary terms are cut into k + 1 segments, one of
  which stands unspoilt in any term within distance k; the equi join on segments
  finds every candidate, and ``levenshtein`` then verifies each one exactly. No
  cap on expansions, no cross product of vocabulary and query terms.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.docscores import MAX_QUERY_ROWS, most_bits
from quire.operators.index import Index
from quire.operators.joins import (counted_join, fits_broadcast, join_small, max_broadcast_bytes, max_broadcast_rows, row_bytes,
                                   salted_join)
from quire.operators.ranking import BM25_B, BM25_K1, corpus_scalars, round_score, weight
from quire.session import materialize
from quire.sources.collection import ordered_ids


def boolean_rank(index: Index, clauses: DataFrame, model: str = "bm25", param: float = 0.0,
                 cut: int = 10) -> DataFrame:
    """Clauses (query_id, term, qtf, occur) with occur in should | must |
    must_not. A document must contain every ``must`` term and no ``must_not``
    term; should and must terms are scored. Queries with only prohibited
    terms match nothing.

    Prohibited terms are neither scored nor grouped with the others: the queries that a
    document is prohibited for are one small list per document, made from the postings of
    prohibited terms and joined by document. Postings are bucketed by document, so neither
    the grouping nor that join shuffles."""
    cl = clauses.select("query_id", "term", "qtf", "occur")
    wanted = cl.filter(F.col("occur") != "must_not")
    n_must = wanted.groupBy("query_id").agg(F.sum(F.when(F.col("occur") == "must", 1).otherwise(0)).alias("_need"))
    wanted = wanted.join(n_must, "query_id")
    postings = index.postings.select("doc_id", "term", "tf", "dl")
    w = weight(model, param, F.col("tf"), F.col("dl"), F.col("df"), F.col("cf"),
               *corpus_scalars(index), BM25_K1, BM25_B)
    agg = _of_terms(postings, index.terms, wanted).groupBy("query_id", "_need", "doc_id").agg(
        F.sum(F.col("qtf").cast("double") * w).alias("_s"),
        F.sum(F.when(F.col("occur") == "must", 1).otherwise(0)).alias("_got"))
    ok = agg.filter(F.col("_got") == F.col("_need"))
    banned = _of_terms(postings.select("doc_id", "term"), index.terms, cl.filter(F.col("occur") == "must_not")) \
        .groupBy("doc_id").agg(F.collect_set("query_id").alias("_bad"))
    ok = ok.join(banned, "doc_id", "left").filter(~F.coalesce(F.array_contains("_bad", F.col("query_id")), F.lit(False)))
    scored = ok.select("query_id", "doc_id", round_score(F.col("_s")).alias("score"))
    win = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return (scored.withColumn("rk", F.row_number().over(win).cast("bigint"))
            .filter(F.col("rk") <= cut).select("query_id", "rk", "doc_id", "score"))


def _of_terms(postings: DataFrame, terms: DataFrame, clauses: DataFrame) -> DataFrame:
    """Postings of the terms of clauses, with both and the terms' statistics."""
    if fits_broadcast(clauses):
        return postings.join(F.broadcast(terms.join(F.broadcast(clauses), "term")), "term")
    return counted_join(postings, salted_join(terms, clauses, "term"), "term", "df", spread_col="doc_id")


# ----------------------------------------------------------------- wildcard

def asked_lengths(df: DataFrame, col: str) -> list[int]:
    """The different lengths of a query-side column: a few numbers."""
    return sorted(r[0] for r in df.select(F.length(col)).distinct().collect() if r[0] is not None)


def prefix_expansion(terms: DataFrame, patterns: DataFrame) -> DataFrame:
    """(query_id, pattern, term) for every vocabulary term that starts
    with a ``pattern*`` prefix, by an equi join on generated prefixes. Other columns of
    ``terms`` stay with the term."""
    pats = patterns.select("query_id", "pattern").distinct()
    # prefixes of the lengths asked for only
    made = [F.when(F.length("term") >= n, F.substring("term", 1, n)) for n in asked_lengths(pats, "pattern")]
    pre = terms.select("*", F.explode(F.array_compact(F.array(*made).cast("array<string>"))).alias("pattern"))
    return join_small(pre, pats, "pattern").select("query_id", "pattern", *terms.columns)


GRAM = 3


def wildcard_expansion(terms: DataFrame, patterns: DataFrame) -> DataFrame:
    """(query_id, pattern, term) for patterns with ``*`` (any characters)
    and ``?`` (one character) anywhere.

    An equi join, not a test of every pair: a pattern is keyed by up to GRAM characters
    that its terms begin with and as many that they end with, or, where it has longer
    literals inside, by GRAM characters of its longest literal run. A term has a key for
    each shape of key that is asked for, and the pairs that meet are tested with the pattern
    as a regular expression. A pattern without a literal has the empty key, which all terms
    share: it has to look at the whole vocabulary. Other columns of ``terms`` stay with the
    term."""
    pats = patterns.select("query_id", "pattern").distinct()
    runs = F.split("pattern", r"[*?]")
    longest = F.array_sort(F.transform(runs, lambda r: F.struct((-F.length(r)).alias("n"), r.alias("r"))))[0]["r"]
    # every character quoted on its own, then the wildcards put back
    quoted = F.regexp_replace("pattern", r"([^\p{L}\p{N}])", r"\\$1")
    regex = F.replace(F.replace(quoted, F.lit("\\*"), F.lit(".*")), F.lit("\\?"), F.lit("."))
    # cheap tests that come first; with one wildcard, a star, they decide
    pats = pats.withColumn("_head", runs[0]).withColumn("_tail", F.element_at(runs, -1)) \
        .withColumn("_regex", F.concat(F.lit("(?s)^"), regex, F.lit("$"))) \
        .withColumn("_least", F.length(F.replace("pattern", F.lit("*"), F.lit("")))) \
        .withColumn("_plain", (F.size(runs) == 2) & F.contains("pattern", F.lit("*"))) \
        .withColumn("_long", F.substring(longest, 1, GRAM))
    head, tail = F.least(F.length("_head"), F.lit(GRAM)), F.least(F.length("_tail"), F.lit(GRAM))
    ends = head + tail >= F.length("_long")
    pats = pats.withColumn("_shape", F.when(ends, F.concat(head, F.lit("-"), tail)).otherwise(F.length("_long").cast("string"))) \
        .withColumn("_key", F.concat("_shape", F.lit(":"), F.when(ends, F.concat(
            F.substring("_head", F.lit(1), head), F.substring("_tail", F.length("_tail") - tail + 1, tail))).otherwise(F.col("_long"))))
    n = F.length("term")

    def key(shape: str) -> Column:
        if "-" not in shape:
            k = int(shape)
            every = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.concat(F.lit(f"{shape}:"), F.substring("term", i, k)))
            return F.when(n >= k, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))
        h, t = map(int, shape.split("-"))
        both = F.concat(F.lit(f"{shape}:"), F.substring("term", 1, h), F.substring("term", n - t + 1, F.lit(t)))
        return F.when(n >= max(h, t), F.array(both)).otherwise(F.array().cast("array<string>"))
    # at most (GRAM + 1) ** 2 + GRAM shapes
    shapes = sorted(r[0] for r in pats.select("_shape").distinct().collect() if r[0] is not None)
    keys = F.concat(F.array().cast("array<string>"), *map(key, shapes))
    keyed = terms.select("*", F.explode(keys).alias("_key"))
    matches = F.expr("length(term) >= _least AND startswith(term, _head) AND endswith(term, _tail) AND (_plain OR term rlike _regex)")
    # only keys that a pattern asks for leave the vocabulary scan
    return join_small(keyed, pats, "_key").filter(matches).select("query_id", "pattern", *terms.columns)


#: Patterns whose hits in a document are bits of one number.
WORD_BITS = 64


def wildcard_rank(index: Index, patterns: DataFrame, cut: int = 10, prefixes: bool = True) -> DataFrame:
    """Constant-score wildcard query: a document scores 1 per pattern it
    matches (through any expansion); top ``cut`` by score, then doc id. With
    ``prefixes`` a pattern is a prefix, otherwise it has its own ``*`` and ``?``.

    A pattern is expanded once, whatever the number of queries that have it. Patterns are
    numbered, and WORD_BITS of them make a word: a document's hits are a mask for each word,
    united over its postings, and a query counts the bits that it shares with them, for
    some documents and all queries at a time (``docscores``). So no row is made for each
    query and document, nor for each query, pattern and term."""
    asked = patterns.select("query_id", "pattern").distinct().filter(F.col("pattern").isNotNull())
    number = F.col("_n") - 1
    numbered = materialize(ordered_ids(asked.select("pattern").distinct(), "pattern", "_n").select(
        "pattern", F.floor(number / WORD_BITS).alias("_word"),
        F.expr(f"shiftleft(1L, CAST((_n - 1) % {WORD_BITS} AS INT))").alias("_bit")), "wildcard-patterns")
    exp = (prefix_expansion if prefixes else wildcard_expansion)(
        index.terms.select("term", "df"), numbered.select(F.lit(0).alias("query_id"), "pattern"))
    # at most a row per term and word
    exp = materialize(join_small(exp, numbered, "pattern").groupBy("term", "df", "_word").agg(F.bit_or("_bit").alias("_mask")),
                      "wildcard-terms")
    hits = word_masks(index, exp)
    wants = materialize(join_small(asked, numbered, "pattern").groupBy("query_id", "_word").agg(F.bit_or("_bit").alias("_want")),
                        "wildcard-queries")
    if fits_broadcast(wants, min(MAX_QUERY_ROWS, max_broadcast_rows(wants))):
        scored = most_bits(hits, wants.toArrow(), wants.schema["query_id"].dataType, cut)
    else:
        hits = hits.groupBy("doc_id", "_word").agg(F.bit_or("_mask").alias("_mask"))
        shared = join_small(hits, wants, "_word").select(
            "query_id", "doc_id", F.bit_count(F.col("_mask").bitwiseAND(F.col("_want"))).alias("_n")).filter(F.col("_n") > 0)
        scored = shared.groupBy("query_id", "doc_id").agg(F.sum("_n").cast("double").alias("score"))
    win = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return (scored.withColumn("rk", F.row_number().over(win).cast("bigint"))
            .filter(F.col("rk") <= cut).select("query_id", "rk", "doc_id", "score"))


#: Expanded terms that are sent to the tasks at most (and within the bounds of ``joins``).
SENT_TERMS = 500_000


def sent_df(*tables: DataFrame) -> int | None:
    """The least power of two such that the rows of that ``df`` or more can be broadcast,
    of each table; None where those of the first can be as a whole."""
    least = []
    for rows in tables:
        # at most 64 rows, the most frequent first
        sizes = rows.groupBy(F.floor(F.log2("df")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(rows)).alias("b")) \
            .orderBy(F.desc("k")).collect()
        n, b, k = min(SENT_TERMS, max_broadcast_rows(rows)), max_broadcast_bytes(rows), None
        for r in sizes:
            n, b = n - r["n"], b - r["b"]
            if n < 0 or b < 0:
                k = r["k"] + 1
                break
        if k is None and not least:
            return None
        least.append(k or 0)
    return 1 << max(least)


def word_masks(index: Index, exp: DataFrame) -> DataFrame:
    """(doc_id, _word, _mask): the masks of expanded terms (term, df, _word, _mask) that a
    document has; a word may come twice.

    Expanded terms may be a large part of the vocabulary, but its frequent terms make nearly
    all postings: they are broadcast, and what they give is united beside the postings,
    which are bucketed by document. Only postings of rarer terms are shuffled."""
    postings = index.postings.select("doc_id", "term")
    least = sent_df(exp, index.terms.select("term", "df"))
    sent = exp if least is None else exp.filter(F.col("df") >= least)
    masks = postings.join(F.broadcast(sent.drop("df")), "term").groupBy("doc_id", "_word").agg(F.bit_or("_mask").alias("_mask"))
    if least is None:
        return masks
    often = index.terms.filter(F.col("df") >= least).select("term")
    rare = counted_join(postings.join(F.broadcast(often), "term", "left_anti"), exp.filter(F.col("df") < least), "term", "df", spread_col="doc_id")
    return masks.unionByName(rare.select("doc_id", "_word", "_mask"))


# ----------------------------------------------------------------- fuzzy

def _segment(length: Column, i: Column, m: int) -> tuple[Column, Column]:
    """(start, size) of the i-th of m segments of a term of a length; the last ones are
    longer by one where it does not divide."""
    base, longer = F.floor(length / m).cast("int"), m - length % m
    return i * base + F.greatest(i - longer, F.lit(0)), base + F.when(i >= longer, 1).otherwise(0)


def term_segments(term: Column, m: int) -> Column:
    """The m segments of a vocabulary term as structs (length, i, segment)."""
    n = F.length(term)

    def one(i: Column) -> Column:
        start, size = _segment(n, i, m)
        return F.struct(n.alias("length"), i.alias("i"), F.substring(term, start + 1, size).alias("segment"))
    return F.transform(F.sequence(F.lit(0), F.lit(m - 1)), one)


def near_segments(term: Column, m: int, k: int) -> Column:
    """What segments of a term within k edits may be in a query term: for each length that
    is off by at most k and each of its m segments, the substrings of its size that begin
    at most k places off."""
    n = F.length(term)

    def of_length(length: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: of_segment(length, i)))

    def of_segment(length: Column, i: Column) -> Column:
        start, size = _segment(length, i, m)
        starts = F.filter(F.transform(F.sequence(F.lit(-k), F.lit(k)), lambda s: start + s), lambda p: (p >= 0) & (p + size <= n))
        return F.transform(starts, lambda p: F.struct(length.alias("length"), i.alias("i"), F.substring(term, p + 1, size).alias("segment")))
    lengths = F.sequence(F.greatest(n - k, F.lit(1)), n + k)
    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def _osa(a: str, b: str) -> int:
    """Optimal string alignment distance: Levenshtein plus adjacent swaps."""
    la, lb = len(a), len(b)
    d = [[0] * (lb + 1) for _ in range(la + 1)]
    for i in range(la + 1):
        d[i][0] = i
    for j in range(lb + 1):
        d[0][j] = j
    for i in range(1, la + 1):
        for j in range(1, lb + 1):
            cost = 0 if a[i - 1] == b[j - 1] else 1
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + cost)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[la][lb]


@F.pandas_udf(T.LongType())
def _osa_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_osa(x, y) for x, y in zip(a, b)], dtype="int64")


def fuzzy_expansion(terms: DataFrame, qterms: DataFrame, max_edits: int = 2,
                    transpositions: bool = False) -> DataFrame:
    """(query_id, term, match, distance) for every vocabulary term within
    ``max_edits`` of a query term: Levenshtein (JVM built-in), or with
    ``transpositions`` the optimal-string-alignment distance (an adjacent
    swap counts once).

    Segment index: a vocabulary term is cut into one segment more than edits can spoil (an
    edit spoils one, a swap two), so one of them stands in the query term unspoilt, at most
    ``max_edits`` places off. Both sides meet on (length, number, segment); the distance of
    each pair is then computed exactly (a pandas UDF over candidate pairs for swaps). The
    vocabulary side has a row per segment, the query side some per length and segment."""
    # a term whose length differs by more than max_edits from every query term's is no
    # match: such terms (very long ones) are left out before segments are made
    near = {n + d for n in asked_lengths(qterms, "term") for d in range(-max_edits, max_edits + 1)}
    terms = terms.filter(F.length("term").isin(sorted(near)))
    m = (2 * max_edits if transpositions else max_edits) + 1
    key = ["length", "i", "segment"]
    qv = qterms.select("query_id", "term").distinct() \
        .select("query_id", "term", F.explode(near_segments(F.col("term"), m, max_edits)).alias("_g")).select("query_id", "term", "_g.*")
    vv = terms.select(F.col("term").alias("match"), F.explode(term_segments(F.col("term"), m)).alias("_g")).select("match", "_g.*")
    pairs = join_small(vv, qv, key).select("query_id", "term", "match").distinct()
    dist = _osa_udf("term", "match") if transpositions else \
        F.levenshtein("term", "match").cast("bigint")
    return pairs.withColumn("distance", dist).filter(F.col("distance") <= max_edits)
