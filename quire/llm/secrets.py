"""Secrets in texts: known shapes, and high entropy in sliding windows.

Base kinds are regular expressions (assignments to secret-like names, access key ids,
long hex strings). Over every other candidate string (a long run of key characters with
a digit and a letter) a window slides; the counts of its characters are kept up to date
by the one that enters and the one that leaves, and with them the sum of c * log2(c),
which gives the window's Shannon entropy without counting again. Windows above the
threshold of their alphabet make spans (``alphabet_spans``); base spans and what is known
not to be a secret are cut out of a candidate, and the rest is judged.

Everything is column expressions inside the row: no shuffle, no Python. Offsets come from
the lengths of matches and of what lies between them. Work is linear in the text.

Defined results: null or empty text has no spans; offsets are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import let

ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 12
#: A run that is long enough is what a longest match with too few characters dropped leaves.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"

KEY = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{KEY}])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[{KEY}]{{20,}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_base32", "entropy_alnum", "entropy_base62")
#: Alphabets, the narrowest first, and the least bits per character of a window. Of windows
#: of 20 random characters, 99% have 2.90 bits in hex, 3.35 in base 32, 3.41 of one-case
#: letters and digits, 3.65 in base 62 and base 64.
ALPHABETS = (("entropy_hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.9), ("entropy_base32", r"^(?:[a-z2-7]+|[A-Z2-7]+)$", 3.3),
             ("entropy_alnum", r"^(?:[a-z0-9]+|[A-Z0-9]+)$", 3.4), ("entropy_base62", r"^[A-Za-z0-9]+$", 3.6),
             ("entropy_base64", r"", 3.6))
#: A stretch without separators is also judged by its own alphabet.
SEGMENT = rf"[A-Za-z0-9]{{{WINDOW},}}"
_WORD = r"(?:[A-Z]?[a-z]{3,}+(?:[A-Z][a-z]++)*+|[A-Z]{3,}+)"
#: Parts of a candidate that are no secrets, each with a separator after it: UUIDs; digests
#: named as such, to their length in base 64; segments with samples or runs of the alphabet;
#: segments that are words, or words with a number in fewer than 16 characters.
CLEARED = (r"(?<![A-Za-z0-9])(?:[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])|"
           + "|".join(rf"(?i:{name})[-_=](?:[0-9A-Fa-f]++(?![A-Za-z0-9+])|[A-Za-z0-9+/]{{{size}}}|[A-Za-z0-9]*+)"
                      for name, size in (("md5", 22), ("sha1", 27), ("sha256", 43), ("sha384", 64), ("sha512", 86)))
           + r"|[A-Za-z0-9]*?(?i:example|sample|placeholder|xxxx|abcdefgh|01234567|12345678)[A-Za-z0-9]*+"
           rf"|{_WORD}(?![A-Za-z0-9])|(?=[A-Za-z0-9]{{1,15}}(?![A-Za-z0-9])){_WORD}[0-9]{{1,4}}+(?![A-Za-z0-9]))[+/_=-]?")


FOUND = "array<struct<s:int,e:int,m:string>>"


def matches(text: Column, pattern: str, wanted: Column | None = None) -> Column:
    """Array of (s, e, m): start, end and text of each match, leftmost and not
    overlapping. ``wanted``, an array of booleans, keeps some of them."""
    def located(found: Column, between: Column, wanted: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("out"))

        def step(state: Column, i: Column) -> Column:
            s = state["at"] + F.length(F.get(between, i))
            e = s + F.length(F.get(found, i))
            one = F.array(F.struct(s.alias("s"), e.alias("e"), F.get(found, i).alias("m")))
            return F.struct(e.alias("at"), F.when(F.get(wanted, i), F.concat(state["out"], one))
                            .otherwise(state["out"]).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step, lambda s: s["out"])

    def of(found: Column) -> Column:
        chosen = F.transform(found, lambda m: F.lit(True)) if wanted is None else wanted
        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), lambda between: let(
            chosen, lambda w: located(found, between, w)))).otherwise(F.array().cast(FOUND))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)


def kept_assignments(text: Column) -> Column:
    """For each assignment, whether its value is long enough."""
    return F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_LEAST)


def _clog(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def hot_windows(text: Column, least: Column) -> Column:
    """Spans (s, e) in ``text`` that windows of at least ``least`` bits cover."""
    spans = "array<struct<s:int,e:int>>"
    start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(-1).alias("s"), F.lit(-1).alias("e"), F.array().cast(spans).alias("out"))

    def run(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            def slide(came: Column, went: Column) -> Column:
                up = F.get(state["counts"], came - 1)
                # counts after the new character came, then after the oldest went
                down = F.get(state["counts"], went - 1) + (came == went).cast("int")
                total = state["sum"] + _clog(up + 1) - _clog(up) + \
                    F.when(went > 0, _clog(down - 1) - _clog(down)).otherwise(F.lit(0.0))
                counts = F.transform(state["counts"], lambda c, k: c + (k == came - 1).cast("int") - (k == went - 1).cast("int"))

                def close(s: Column) -> Column:
                    size = F.lit(float(WINDOW))
                    hit = (i + 1 >= WINDOW) & (F.log2(size) - s / size >= least - 1e-9)
                    first, joined = i + 1 - WINDOW, state["e"] >= i + 1 - WINDOW
                    open_span = F.array(F.struct(state["s"].alias("s"), state["e"].alias("e")))
                    return F.struct(
                        counts.alias("counts"), s.alias("sum"),
                        F.when(hit & ~((state["e"] > 0) & joined), first).otherwise(state["s"]).alias("s"),
                        F.when(hit, i + 1).otherwise(state["e"]).alias("e"),
                        F.when(hit & (state["e"] > 0) & ~joined, F.concat(state["out"], open_span))
                        .otherwise(state["out"]).alias("out"))
                return let(total, close)
            return let(F.get(codes, i), lambda came: let(
                F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(0)), lambda went: slide(came, went)))

        def end(state: Column) -> Column:
            last = F.array(F.struct(state["s"].alias("s"), state["e"].alias("e")))
            return F.when(state["e"] > 0, F.concat(state["out"], last)).otherwise(state["out"])
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, end)

    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return let(codes, run)


def stretches(c: Column, taken: Column) -> Column:
    """Stretches (s, e) of a candidate between base spans and what CLEARED names, where
    they have room for a window."""
    found = "array<struct<s:int,e:int>>"
    near = F.filter(taken, lambda t: (t["s"] < c["e"]) & (t["e"] > c["s"]))
    cuts = F.concat(F.transform(near, lambda t: F.struct((t["s"] - c["s"]).alias("s"), (t["e"] - c["s"]).alias("e"))),
                    F.transform(matches(c["m"], CLEARED), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
    end = F.array(F.struct(F.length(c["m"]).alias("s"), F.length(c["m"]).alias("e")))

    def step(state: Column, x: Column) -> Column:
        room = F.array(F.struct(state["at"].alias("s"), x["s"].alias("e")))
        return F.struct(F.greatest(state["at"], x["e"]).alias("at"), F.when(x["s"] - state["at"] >= WINDOW, F.concat(
            state["out"], room)).otherwise(state["out"]).alias("out"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(found).alias("out"))
    return F.aggregate(F.concat(F.sort_array(cuts), end), start, step, lambda x: x["out"])


def alphabet_spans(candidates: Column, taken: Column) -> Column:
    """Spans (s, k, e) of windows of the candidates' stretches, and of the long segments
    between separators in them, that reach the threshold of their alphabet; spans of a
    segment only where the stretch around it has none."""
    def judged(text: Column, at: Column) -> Column:
        kind, least = F.lit(None).cast("int"), F.lit(None).cast("double")
        for name, alphabet, bits in reversed(ALPHABETS):
            fits = F.rlike(text, F.lit(alphabet))
            kind = F.when(fits, F.lit(KINDS.index(name))).otherwise(kind)
            least = F.when(fits, F.lit(bits)).otherwise(least)
        mixed = F.rlike(text, F.lit("[0-9]")) & F.rlike(text, F.lit("[A-Za-z]"))
        found = let(least, lambda bits: let(kind, lambda k: F.transform(hot_windows(text, bits), lambda x: F.struct(
            (at + x["s"]).alias("s"), k.alias("k"), (at + x["e"]).alias("e")))))
        return F.when(mixed, found).otherwise(F.array().cast("array<struct<s:int,k:int,e:int>>"))

    def of(text: Column, at: Column) -> Column:
        segments = F.filter(matches(text, SEGMENT), lambda x: F.length(x["m"]) < F.length(text))
        inner = F.flatten(F.transform(segments, lambda x: judged(x["m"], at + x["s"])))
        return let(judged(text, at), lambda outer: F.concat(outer, F.filter(inner, lambda x: ~F.exists(
            outer, lambda o: (o["s"] <= x["s"]) & (x["e"] <= o["e"])))))

    def spans(c: Column) -> Column:
        return F.flatten(F.transform(stretches(c, taken), lambda x: let(
            c["m"].substr(x["s"] + 1, x["e"] - x["s"]), lambda text: of(text, c["s"] + x["s"]))))
    return F.flatten(F.transform(candidates, spans))


def written(spans: Column) -> Column:
    """kind:start:end of (s, k, e) spans, by start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with n_assign, n_access, n_hex, and the span arrays
    base_spans and all_spans of (s, k, e): start, kind (index into KINDS), end."""
    rows = docs.withColumn("_text", F.coalesce(text, F.lit("")))
    t = F.col("_text")
    rows = rows.select(*keep, "_text",
                       matches(t, ASSIGN, kept_assignments(t)).alias("_assign"),
                       matches(t, ACCESS).alias("_access"), matches(t, HEX).alias("_hex"),
                       matches(t, CANDIDATE).alias("_found"))
    of = lambda c, k: F.transform(F.col(c), lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
    rows = rows.select(*keep, "_found", F.size("_assign").cast("long").alias("n_assign"),
                       F.size("_access").cast("long").alias("n_access"), F.size("_hex").cast("long").alias("n_hex"),
                       F.concat(of("_assign", 0), of("_access", 1), of("_hex", 2)).alias("base_spans"))
    extra = F.when(F.size("_found") > 0, alphabet_spans(F.col("_found"), F.col("base_spans"))) \
        .otherwise(F.array().cast("array<struct<s:int,k:int,e:int>>"))
    return rows.select(*keep, "n_assign", "n_access", "n_hex", "base_spans",
                       F.concat("base_spans", extra).alias("all_spans"))
