"""Quality rules as weak supervision.

Every rule looks at a document's counts and votes good (1), bad (-1) or abstains (0).
Expectation-maximisation over the votes estimates, without labels, how often each rule
is right on good and on bad documents and how common good ones are; a document's
posterior probability of being good replaces a filter that all rules must pass.

Everything is column expressions. Counts are taken inside the row, so texts are neither
shuffled nor exploded; the counts and votes are a written table. Votes have at most
3 ** len(RULES) patterns (6561): they are counted by an aggregate and the iterations
run over that one row. Every document then gets the posterior of its pattern by a
broadcast of the pattern table, which has that many rows at most. Rules come in overlapping kinds: EM
tells a bad document by rules that agree, one bad vote among good ones can be chance.

Defined results: null or empty text has no words and fails the base check; repeated rows
are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ROW, SPACE, boxed, field, let, unboxed
from quire.session import materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50          # per cent of words in repeated 3-word windows
ROUNDS = 30
THRESHOLD = 0.5
#: What EM starts from and, as pseudo-counts, what it is smoothed with: rules rarely vote
#: bad on good documents; a bad document sets off few of them.
PRIOR_GOOD, GOOD_ON_GOOD, BAD_ON_BAD, PSEUDO = 0.8, 0.98, 0.3, 2.0

#: rule -> (votes bad, votes good), over the counts.
RULES = {
    "symbols": ("n_symbols > 0.25 * n_words", "n_symbols <= 0.02 * n_words"),
    "repeats": ("n_repeat_words > 0.4 * n_words", "n_repeat_words <= 0.15 * n_words"),
    "lines": ("n_dup_lines > 0.4 * n_lines and n_lines >= 4", "n_dup_lines <= 0.1 * n_lines"),
    "word_length": ("word_chars > 14 * n_words or word_chars < 2 * n_words",
                    "word_chars between 3 * n_words and 10 * n_words"),
    "capitals": ("n_capitals > 0.5 * word_chars", "n_capitals <= 0.15 * word_chars"),
    "marks": ("n_shouts > 0.2 * n_words", "n_shouts <= 0.02 * n_words"),
    "plain": ("n_plain < 0.5 * n_words", "n_plain >= 0.85 * n_words"),
    "bare": ("n_bare > 0.2 * n_words", "n_bare <= 0.02 * n_words"),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _size(a: Column) -> Column:
    return F.size(a).cast("long")


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the text has twice or more.

    Windows are compared as strings; only a text with fewer different windows than
    windows sorts them with their places, keeps those equal to a neighbour, and adds
    up what each covers before the next one.
    """
    n = F.size(words)

    def covered(places: Column) -> Column:
        size = F.size(places)
        return F.aggregate(
            F.transform(places, lambda p, i: F.when(i + 1 < size, F.least(F.lit(3), F.get(places, i + 1) - p)).otherwise(3)),
            F.lit(0).cast("long"), lambda s, x: s + x)

    def equal_places(ranked: Column) -> Column:
        at = lambda i: F.get(ranked, i)["w"]
        twice = F.filter(ranked, lambda x, i: (x["w"] == at(i - 1)) | (x["w"] == at(i + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    def of(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")) \
            .otherwise(let(ranked, lambda r: let(equal_places(r), covered)))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(words, lambda w: let(windows(w), of)))


def counts(docs: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and all counts."""
    plain = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), F.lit(" "))
    rows = docs.withColumn("_text", F.coalesce(text, F.lit(""))).withColumn("_plain", plain)
    rows = rows.withColumn("_words", F.when(F.col("_plain") == "", F.array().cast("array<string>"))
                           .otherwise(F.split("_plain", " ")))
    # a line with a word; \x0b, \x0c and \r do not end lines
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")) != "")
    taken = lambda pattern: F.regexp_count("_text", F.lit(pattern)).cast("long")
    n_words = _size(F.col("_words"))
    return (rows.withColumn("_lines", lines)
            .select(*keep, n_words.alias("n_words"),
                    (F.length("_plain") - F.greatest(n_words - 1, F.lit(0))).cast("long").alias("word_chars"),
                    taken("[#*$%&|<>]").alias("n_symbols"),
                    (_size(F.col("_lines")) - _size(F.array_distinct("_lines"))).alias("n_dup_lines"),
                    repeated_words(F.col("_words")).alias("n_repeat_words"),
                    _size(F.col("_lines")).alias("n_lines"),
                    taken(r"\p{Lu}").alias("n_capitals"),
                    F.regexp_count("_plain", F.lit(r"!(?= |$)")).cast("long").alias("n_shouts"),
                    F.regexp_count("_plain", F.lit(r"(?<![^ ])\p{L}++[.,;:?!]?(?![^ ])")).cast("long").alias("n_plain"),
                    F.regexp_count("_plain", F.lit(r"(?<![^ ])[^ \p{L}\p{N}]+(?![^ ])")).cast("long").alias("n_bare"))
            .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words")))


def votes() -> Column:
    """Votes of all rules, in the order of RULES; all abstain on a text without words."""
    def vote(bad: str, good: str) -> Column:
        return F.expr(f"case when n_words = 0 then 0 when {bad} then -1 when {good} then 1 else 0 end").cast("int")
    return F.array(*[vote(*rule) for rule in RULES.values()])


def _posterior(v: Column, model: Column) -> Column:
    """Probability of good, given votes and a model (prior, right_good, right_bad)."""
    def log(p: Column) -> Column:
        return F.log(p)

    def odds(i: int) -> Column:
        right, wrong = model["right_good"][i], 1 - model["right_good"][i]
        bad_right, bad_wrong = model["right_bad"][i], 1 - model["right_bad"][i]
        return F.when(v[i] == 1, log(right) - log(bad_wrong)).when(v[i] == -1, log(wrong) - log(bad_right)).otherwise(0.0)
    start = log(model["prior"]) - log(1 - model["prior"])
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, [odds(i) for i in range(len(RULES))], start)))


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(votes, n) rows, one per pattern, to one row with a ``model``. Sums run over the
    patterns in a fixed order, so that reruns agree."""
    k = len(RULES)
    one = patterns.agg(F.sort_array(F.collect_list(F.struct(F.col("votes").alias("v"), F.col("n").cast("double").alias("n"))))
                       .alias("rows"))
    start = F.struct(F.lit(PRIOR_GOOD).alias("prior"),
                     F.array_repeat(F.lit(GOOD_ON_GOOD), k).alias("right_good"),
                     F.array_repeat(F.lit(BAD_ON_BAD), k).alias("right_bad"))

    def total(rows: Column, of) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda s, r: s + of(r))

    def rate(rows: Column, weight, i: int, hit: int, expected: float) -> Column:
        hits = total(rows, lambda r: F.when(r["v"][i] == hit, weight(r)).otherwise(0.0))
        cast = total(rows, lambda r: F.when(r["v"][i] != 0, weight(r)).otherwise(0.0))
        return (hits + PSEUDO * expected) / (cast + PSEUDO)

    def step(model: Column) -> Column:
        def update(rows: Column) -> Column:
            good, bad = lambda r: r["n"] * r["g"], lambda r: r["n"] * (1 - r["g"])
            return F.struct(
                ((total(rows, good) + PSEUDO * PRIOR_GOOD) / (total(rows, lambda r: r["n"]) + PSEUDO)).alias("prior"),
                F.array(*[rate(rows, good, i, 1, GOOD_ON_GOOD) for i in range(k)]).alias("right_good"),
                F.array(*[rate(rows, bad, i, -1, BAD_ON_BAD) for i in range(k)]).alias("right_bad"))
        scored = F.transform("rows", lambda r: F.struct(r["v"].alias("v"), r["n"].alias("n"), _posterior(r["v"], model).alias("g")))
        return let(scored, update)

    return one.select("rows", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda m, _: step(m)).alias("model"))


def score(docs: DataFrame, text: Column, keep: list[str], rounds: int = ROUNDS,
          threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` with counts, base_failed, votes, quality (the posterior) and kept."""
    rows = materialize(counts(docs, text, keep).withColumn("votes", votes()), "quality-votes")
    patterns = rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    fitted = fit(patterns, rounds).select(F.explode("rows").alias("r"), "model")
    by_pattern = fitted.select(F.col("r.v").alias("votes"), _posterior(F.col("r.v"), F.col("model")).alias("quality"))
    # at most 3 ** len(RULES) rows
    return (rows.join(F.broadcast(by_pattern), "votes")
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))


def filter_quality(docs: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The documents that are kept, columns as given."""
    return unboxed(score(boxed(docs), field(text_col), [ROW], **params).filter("kept").select(ROW))
