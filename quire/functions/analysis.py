"""Analyzers: text column -> array<string> of terms, plus stemming.

Every analyzer is expressed with built-in SQL functions (regex extraction,
lower, split, filter), so tokenisation runs inside whole-stage codegen on the
executors. Stop words from a file are removed with a broadcast anti join of a
size-checked table; stemming runs once per *distinct term* of a batch of texts (see
``stemmed``), never per token.

Analyzer names (the same analyzer must be used for documents and queries):

========== ===========================================================
whitespace split on white space, case kept
simple     runs of letters, lower-cased
keyword    the whole (trimmed) text is one term
standard   runs of letters/digits, lower-cased (word-boundary rules of
           UAX #29 approximated; ``standard_uax`` keeps in-word joiners)
stop       simple + stop-word removal (default list or a file)
english    standard_uax, possessive 's removed, English stop words,
           Porter stem
spanish    standard, Spanish stop words, light Spanish stem
shingle2   adjacent pairs of standard terms, "w1 w2" (a phrase index)
========== ===========================================================
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.stemmers import porter_stem, spanish_light_stem

ANALYZERS = ("whitespace", "simple", "keyword", "standard", "standard_uax",
             "stop", "english", "spanish", "shingle2")

# Token patterns (Java regex syntax).
LETTERS = r"\p{L}+"
WORD = r"[\p{L}\p{N}]+"
NOT_LETTERS = r"[^\p{L}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"
# in-word joiners: apostrophes, '.', ':' and middle dot between letters;
# ',', '.', ';' and apostrophes between digits; '_' anywhere inside a word
WORD_UAX = (r"[\p{L}\p{N}_]+(?:(?:(?<=\p{L})['’.:·](?=\p{L})"
            r"|(?<=\p{N})[,.;'’](?=\p{N}))[\p{L}\p{N}_]+)*")

# Default English stop words of the standard/stop analyzers, in
# alphabetical order.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will",
    "with",
)

# Spanish function words.
_SPANISH_WORDS = """
de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque
esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra
otros ese eso ante ellos e esto mí antes algunos qué unos yo otro otras otra él tanto esa estos mucho quienes
nada muchos cual poco ella estar estas algunas algo nosotros mi mis tú te ti tu tus ellas nosotras vosotros
vosotras os mío mía míos mías tuyo tuya tuyos tuyas suyo suya suyos suyas nuestro nuestra nuestros nuestras
vuestro vuestra vuestros vuestras esos esas
""".split()


def _spanish_auxiliaries() -> set[str]:
    """Forms of estar, haber, ser and tener, from their stems and the endings of the tenses."""
    out = set()
    present = ("estoy estás está estamos estáis están he has ha hemos habéis han soy eres es somos sois son "
               "tengo tienes tiene tenemos tenéis tienen")
    out |= set(present.split())
    for stem, a in (("est", "é és é emos éis én"), ("hay", "a as a amos áis an"), ("se", "a as a amos áis an"),
                    ("teng", "a as a amos áis an")):
        out |= {stem + e for e in a.split()}                                   # subjunctive
    for stem in ("estar", "habr", "ser", "tendr"):
        out |= {stem + e for e in "é ás á emos éis án ía ías íamos íais ían".split()}
    for stem, a in (("est", "aba abas ábamos abais aban"), ("hab", "ía ías íamos íais ían"), ("", "era eras éramos erais eran"),
                    ("ten", "ía ías íamos íais ían")):
        out |= {stem + e for e in a.split()}                                   # imperfect
    for stem, a in (("estuv", "e iste o imos isteis ieron"), ("hub", "e iste o imos isteis ieron"),
                    ("fu", "i iste e imos isteis eron"), ("tuv", "e iste o imos isteis ieron")):
        out |= {stem + e for e in a.split()}                                   # past
        past = stem if stem == "fu" else stem + "i"
        for mark in ("r", "s"):
            out |= {past + e + mark + x for e, x in (("e", "a"), ("e", "as"), ("é", "amos"), ("e", "ais"), ("e", "an"))} \
                if mark == "r" else {past + e + mark + x for e, x in (("e", "e"), ("e", "es"), ("é", "emos"), ("e", "eis"), ("e", "en"))}
    out |= {"estando", "habiendo", "siendo", "teniendo", "sido", "estad", "tened"}
    for stem in ("estad", "habid", "tenid"):
        out |= {stem + e for e in ("o", "a", "os", "as")}
    return out


SPANISH_STOP_WORDS = tuple(sorted({*_SPANISH_WORDS, *_spanish_auxiliaries()}))

STEMMERS = {"english": porter_stem, "spanish": spanish_light_stem}


def token_array(text: Column | str, analyzer: str = "standard",
                stop_words: tuple[str, ...] | None = None) -> Column:
    """array<string> of terms for one text, before stemming.

    ``stop_words`` is a short literal list (bounded, inlined in the
    expression); large lists from files go through ``remove_stop_words``.
    """
    text = F.col(text) if isinstance(text, str) else text
    # maximal runs of a class == split on runs of its complement, minus the
    # empty edge pieces; split + array_remove stays in generated code and is
    # faster than regexp_extract_all
    if analyzer == "whitespace":
        arr = F.array_remove(F.split(text, r"\s+"), "")
    elif analyzer == "simple":
        arr = F.array_remove(F.split(F.lower(text), NOT_LETTERS), "")
    elif analyzer == "stop":
        arr = F.array_remove(F.split(F.lower(text), NOT_LETTERS), "")
        stop_words = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    elif analyzer == "keyword":
        arr = F.array(F.trim(text))
    elif analyzer == "standard":
        arr = F.array_remove(F.split(F.lower(text), NOT_WORD), "")
    elif analyzer == "standard_uax":
        arr = F.regexp_extract_all(F.lower(text), F.lit(WORD_UAX), 0)
    elif analyzer == "english":
        arr = F.transform(
            F.regexp_extract_all(F.lower(text), F.lit(WORD_UAX), 0),
            lambda x: F.regexp_replace(x, r"['’]s$", ""))
        stop_words = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    elif analyzer == "spanish":
        arr = F.array_remove(F.split(F.lower(text), NOT_WORD), "")
        stop_words = SPANISH_STOP_WORDS if stop_words is None else stop_words
    elif analyzer == "shingle2":
        # pairs built from a materialised token column: see ``shingles``
        arr = F.array_remove(F.split(F.lower(text), NOT_WORD), "")
    else:
        raise ValueError(f"unknown analyzer {analyzer!r}; choose from {ANALYZERS}")
    if stop_words:
        # a set of literals is looked up by hash
        arr = F.filter(arr, lambda x: ~x.isin(sorted(set(stop_words))))
    return arr


def shingles(words: Column) -> Column:
    """Adjacent pairs "w1 w2" of a token-array *column* (apply it to a
    projected column, not to an expression, so the text is split once)."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def runs(ordered: Column, fields: tuple[str, ...] = ()) -> Column:
    """Counted runs of equal neighbours of a sorted array *column*: structs of term and tf.
    With ``fields`` the elements are structs of term and these, and each run has an array
    of each."""
    n = F.size(ordered)
    term = (lambda i: F.get(ordered, i)["term"]) if fields else (lambda i: F.get(ordered, i))
    ends = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i + 1 == n) | (term(i) != term(i + 1)))
    # arrays of the fields, made once, so that a run is cut from plain values
    once = F.array(F.struct(ends.alias("ends"), *[ordered[k].alias(k) for k in fields]))

    def counted(e: Column, before: Column, all_of: Column) -> Column:
        first = F.coalesce(before, F.lit(-1)) + 1
        return F.struct(term(e).alias("term"), (e - first + 1).alias("tf"),
                        *[F.slice(all_of[k], first + 1, e - first + 1).alias(k) for k in fields])
    # each end beside the one before it
    made = F.transform(once, lambda one: F.transform(one["ends"], lambda e, j: counted(e, F.get(one["ends"], j - 1), one)))[0]
    return F.when(n > 0, made)


def stemmer_for(analyzer: str):
    return STEMMERS.get(analyzer)


#: Stems that a worker remembers, per analyzer.
KEPT_STEMS = 200_000


@lru_cache
def _memo(analyzer: str):
    return lru_cache(maxsize=KEPT_STEMS)(STEMMERS[analyzer])


def _stems(words: pa.Array, analyzer: str) -> pa.Array:
    """Stems of an array of strings, one call per different word of it."""
    coded = pc.dictionary_encode(words)
    made = pa.array(map(_memo(analyzer), coded.dictionary.to_pylist()), pa.string())
    return made.take(coded.indices)


def stemmed(words: Column, analyzer: str) -> Column:
    """Stem of every element of a token-array *column*: the different words of a batch of
    texts are stemmed once, and nothing is shuffled."""
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def stem(lists: pa.Array) -> pa.Array:
        ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32()))
        return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), _stems(lists.flatten(), analyzer),
                                        mask=lists.is_null())

    return stem(words)


def stemmed_term(term: Column, analyzer: str) -> Column:
    """Stem of a term column, once per different term of a batch."""
    @F.arrow_udf(T.StringType())
    def stem(terms: pa.Array) -> pa.Array:
        return _stems(terms, analyzer)

    return stem(term)


def remove_stop_words(tokens: DataFrame, stop_words: DataFrame, term_col: str = "term",
                      max_broadcast_rows: int | None = None) -> DataFrame:
    """Anti join of a long token table with a stop-word table (column ``word``).

    The stop list is broadcast only after its size is checked; a larger list
    falls back to a shuffled anti join.
    """
    from quire.operators.joins import broadcast_if_small

    stops = stop_words.select(F.col("word").alias(term_col)).distinct()
    return tokens.join(broadcast_if_small(stops, max_broadcast_rows), term_col, "left_anti")
