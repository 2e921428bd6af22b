"""Personal data in texts, also behind disguises.

Plain identifiers are found in the text as it is. Then transducers rewrite what is used
to hide identifiers (letters and digits that look like ASCII ones, invisible characters,
spelled digits, "at" and "dot" in words or brackets, "dot" also as punkt, point and
punto), keeping for every character of the
result the stretch of source characters that it stands for. Identifiers of the rewritten
text that lean on a rewritten character are mapped back to source offsets and added,
unless they lie within a plain one of their kind.

Left out, because prose has the same words: "at" in words before a domain with a real dot
("look at example.com") unless the domain is a known mail host and the word before may be
a name; punkt, point and punto in words unless a known top-level domain follows; other
languages' words for "at".

Texts are handled one at a time inside tasks, in time linear in their length; nothing is
shuffled. Defined results: null or empty text has no spans; offsets are code points, end
exclusive.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ROW, boxed, field, in_slices, unboxed
from quire.session import ship_package

KINDS = ("email", "ip", "card", "phone")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match begins where a run of digits does: within a run no other start can match
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Letters of other scripts that look like these ASCII letters.
LOOKALIKES = {
    "a": "аαɑ", "b": "ЬƄ", "c": "сϲ", "d": "ԁ", "e": "еεё", "g": "ɡ",
    "h": "һ", "i": "іιı", "j": "јϳ", "k": "кκ", "l": "ӏℓ",
    "m": "м", "n": "ոη", "o": "оοօ", "p": "рρ", "q": "ԛ",
    "r": "г", "s": "ѕ", "t": "тτ", "u": "υս", "v": "νѵ", "w": "ԝω",
    "x": "хχ", "y": "уγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ",
    "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ",
    "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ΥҮ", "Z": "Ζ",
    ".": "。․｡", "-": "‐‑‒–−", "@": "﹫", "+": "﹢",
}
PLAIN = {c: a for a, cs in LOOKALIKES.items() for c in cs}
INVISIBLE = "­​‌‍⁠﻿"

# Names of the digits 0 to 9.
SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
NAMES = {name: str(d) for line in SPELLED for d, name in enumerate(line.split())} | {"oh": "0"}
_NAME = "(?:" + "|".join(sorted(NAMES, key=len, reverse=True)) + ")"
_DOT = r"(?:[\[({<]\s*(?:dot|punkt|point|punto|\.)\s*[\])}>]|(?:dot|punkt|point|punto))"
DIGITS = re.compile(rf"\b(?:plus[\s-]+)?{_NAME}(?:[\s,-]+(?:{_DOT}[\s,-]+)?{_NAME}){{2,}}\b", re.I)
#: A separator between spelled digits, and what it stands for.
BETWEEN = re.compile(rf"[\s,-]+({_DOT})?[\s,-]*", re.I)
#: Digits with capital or small O, small L or capital I among them, in a run of their own.
MIXED = re.compile(r"(?<![A-Za-z0-9])\+?[(]?[0-9OolI](?:[\x20().-]?[\x20().-]?[0-9OolI])+(?![A-Za-z0-9])")
LETTER_DIGIT = re.compile(r"(?<=[0-9])[OolI]+|(?<![OolI])[OolI]+(?=[0-9])")
AS_DIGIT = str.maketrans("OolI", "0011")
IN_BRACKETS = re.compile(r"(?<!\s)\s*(?:[\[({<]\s*(at|dot|punkt|point|punto|@|\.)\s*[\])}>])\s*", re.I)
_BRACKET_DOT = r"[\[({<]\s*(?:dot|punkt|point|punto|\.)\s*[\])}>]"
# What must follow "punkt", "point" and "punto" (with up to three labels
# between), which are common words; "at this point in time" has no address.
_TOP = r"(?:com|net|org|info|eu|de|ch|li|lu|fr|es|mx|ar|cl|pe|uy|edu|gov|gob|gouv|uk)\b"
_WORD_DOT = rf"(?:dot\s+|(?:punkt|point|punto)\s+(?=(?:[A-Za-z0-9-]++\s++(?:punkt|point|punto)\s++){{0,3}}{_TOP}))"
# Mail hosts, the only domains with real dots before which "at" is a sign, and
# words that are no names before it.
_MAIL_HOST = (r"(?:(?:gmail|googlemail|yahoo|hotmail|outlook|live|icloud|aol|protonmail|gmx)\.(?:com|net|org|de|fr|es|ch|co\.uk)|web\.de|proton\.me)"
              r"(?![A-Za-z0-9-]|\.[A-Za-z0-9])")
#: A part of each mail host, looked for first.
_HOSTS = ("mail.", "yahoo.", "outlook.", "live.", "icloud.", "aol.", "gmx.", "web.de", "proton.me")
NO_NAMES = frozenset("""a account accounts address addresses available email emails here hosted in inbox it log login look looking mail mailbox
    mailboxes mails me more news on page read registered sign team them us user users up work working works""".split())
IN_WORDS = re.compile(rf"(?<=[A-Za-z0-9])\s+at\s+(?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?:\s+{_WORD_DOT}|\s*{_BRACKET_DOT}\s*)[A-Za-z]|({_MAIL_HOST}))", re.I)
DOT_WORD = re.compile(rf"(?<=[A-Za-z0-9])\s+{_WORD_DOT}(?=[A-Za-z0-9])", re.I)
HIDDEN_DOT = re.compile(r"\bdot\b|[\[({<]\s*[.@]\s*[\])}>]|[\[({<]\s*(?:at|punkt|point|punto)\s*[\])}>]", re.I)
HIDDEN_POINT = re.compile(rf"\b(?:punkt|point|punto)\s+{_TOP}", re.I)
AT_HOST = re.compile(rf"(?<=[A-Za-z0-9])\s+at\s+{_MAIL_HOST}", re.I)
FOREIGN = re.compile("[­ıƄɑɡͰ-׿٠-٩۰-۹०-९"
                     "ᴢ​-‍‐-–․⁠⁰-ₙ℀-⅏−①-⓿。"
                     "﹐-﹯﻿！-￮\U0001d400-\U0001d7ff]")


# ------------------------------------------------------------------ detection

def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of name@domain: each sign with the name characters before it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > free and LOCAL.match(text, s - 1):
            s -= 1
        m = DOMAIN.match(text, at + 1) if s < at else None
        if m:
            found.append((s, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return found


def plain_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind in the text as it is."""
    mail = emails(text) if "@" in text else []
    if not DIGIT.search(text):
        return [mail, [], [], []]
    ip = [m.span() for m in IP.finditer(text) if all(len(n) < 4 and int(n or "0") <= 255 for n in (p.lstrip("0") for p in m[0].split(".")))]
    card = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                card.append(m.span())
    phone = [m.span() for m in PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15] if "+" in text else []
    return [mail, ip, card, phone]


# ---------------------------------------------------------------- transducers

class Traced:
    """A text with, for each character, the source stretch it stands for and whether a
    transducer wrote it."""

    def __init__(self, text: str):
        self.text = text
        self.start = list(range(len(text)))
        self.end = list(range(1, len(text) + 1))
        self.written = bytearray(len(text))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace stretches [s, e) by texts, left to right; all characters of a
        replacement stand for the whole stretch."""
        if not edits:
            return
        text, start, end, written, at = [], [], [], bytearray(), 0
        for s, e, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:s])
            start += self.start[at:s]
            end += self.end[at:s]
            written += self.written[at:s]
            if new:
                text.append(new)
                start += [self.start[s]] * len(new)
                end += [self.end[e - 1]] * len(new)
                written += b"\1" * len(new)
            at = e
        self.text, self.start, self.end, self.written = "".join(text), start, end, written


def lookalike(c: str) -> str | None:
    """The ASCII character that c stands for, if it is another one; "" to leave it out."""
    if c in INVISIBLE:
        return ""
    if c in PLAIN:
        return PLAIN[c]
    if c.isdecimal():
        return str(unicodedata.decimal(c))
    folded = unicodedata.normalize("NFKC", c)
    return folded if len(folded) == 1 and folded.isascii() else None


def unhide_letters(t: Traced) -> None:
    t.rewrite([(m.start(), m.end(), new) for m in FOREIGN.finditer(t.text) if (new := lookalike(m[0])) is not None])


def unhide_letter_digits(t: Traced) -> None:
    """O for 0 and l or I for 1 next to a digit, in runs that are mostly digits."""
    edits = []
    for m in MIXED.finditer(t.text):
        letters = sum(c in "OolI" for c in m[0])
        if letters and sum("0" <= c <= "9" for c in m[0]) >= max(4, 2 * letters):
            edits += [(x.start(), x.end(), x[0].translate(AS_DIGIT)) for x in LETTER_DIGIT.finditer(t.text, m.start(), m.end())]
    t.rewrite(edits)


def unhide_digits(t: Traced) -> None:
    """Runs of three and more spelled digits, with "plus" before and "dot" between."""
    edits = []
    for m in DIGITS.finditer(t.text):
        at, words = m.start(), m[0]
        if words.lower().startswith("plus"):
            edits.append((at, at + 4, "+"))
            gap = BETWEEN.match(t.text, at + 4)
            edits.append((at + 4, gap.end(), ""))
            at = gap.end()
        while at < m.end():
            name = next(n for n in _BY_LENGTH if t.text[at:at + len(n)].lower() == n)
            edits.append((at, at + len(name), NAMES[name]))
            at += len(name)
            gap = BETWEEN.match(t.text, at, m.end())
            if gap and gap.end() < m.end():
                edits.append((at, gap.end(), "." if gap[1] else ""))
                at = gap.end()
            elif at < m.end():
                break
    t.rewrite(edits)


#: What may stand around words, so that splitting leaves them bare.
_TO_SPACES = {ord(c): " " for c in ",.;:!?-()[]{}<>\"'/|«»¿¡“”‘’„‚…–—*_#&%$+=~^`@"}
_BY_LENGTH = sorted(NAMES, key=len, reverse=True)


def named(text: str, end: int) -> bool:
    """Whether the word that ends there may be the name of an address."""
    s = end
    while s and LOCAL.match(text, s - 1):
        s -= 1
    return text[s:end].lower() not in NO_NAMES


def unhide_signs(t: Traced) -> None:
    """"at" and "dot": words first (they need both, or a mail host), then brackets."""
    t.rewrite([(m.start(), m.end(), "@") for m in IN_WORDS.finditer(t.text) if not m[1] or named(t.text, m.start())])
    t.rewrite([(m.start(), m.end(), "@" if m[1].lower() in ("at", "@") else ".") for m in IN_BRACKETS.finditer(t.text)])
    if "@" in t.text:
        t.rewrite([(m.start(), m.end(), ".") for m in DOT_WORD.finditer(t.text)])


def spelled(text: str) -> bool:
    """Whether a text has a run of spelled digits (looked for if it has any such word)."""
    words = text.lower().translate(_TO_SPACES).split()
    return not NAMES.keys().isdisjoint(words) and DIGITS.search(text) is not None


def signed(text: str) -> bool:
    """Whether a text has a "dot" in some language, a sign in brackets or "at" before a mail host."""
    low = text.lower()
    return (("dot" in low or any(b in text for b in "[({<")) and HIDDEN_DOT.search(text) is not None
            or any(w in low for w in ("punkt", "point", "punto")) and HIDDEN_POINT.search(text) is not None
            or any(h in low for h in _HOSTS) and AT_HOST.search(text) is not None)


def hidden_spans(text: str, plain: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """Spans of each kind, in source offsets, that only show after rewriting."""
    foreign = not text.isascii() and FOREIGN.search(text)
    digits, signs, mixed = spelled(text), signed(text), LETTER_DIGIT.search(text)
    if foreign and not (digits and signs):
        shown = Traced(text)
        unhide_letters(shown)
        digits, signs = digits or spelled(shown.text), signs or signed(shown.text)
    if not (foreign or digits or signs or mixed):
        return [[], [], [], []]
    t = Traced(text)
    if foreign:
        unhide_letters(t)
    if foreign or mixed:
        unhide_letter_digits(t)
    if digits:
        unhide_digits(t)
    if signs:
        unhide_signs(t)
    out = []
    for found, known in zip(plain_spans(t.text), plain):
        own, k = [], 0
        for s, e in found:
            a, b = t.start[s], t.end[e - 1]
            if not any(t.written[s:e]) and b - a == e - s:
                continue                         # nothing rewritten or left out in it
            while k < len(known) and known[k][1] <= a:
                k += 1
            if k == len(known) or not known[k][0] <= a <= b <= known[k][1]:
                own.append((a, b))
        out.append(own)
    return out


def joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, own in zip(KINDS, spans) for s, e in own)


def find(text: str | None) -> tuple[list, list]:
    """Plain and all spans of a text, per kind and sorted."""
    plain = plain_spans(text or "")
    more = hidden_spans(text or "", plain)
    return plain, [sorted(a + b) for a, b in zip(plain, more)]


def redacted(text: str | None) -> str | None:
    """The text with every span replaced by its kind; overlapping spans are one."""
    if text is None:
        return None
    spans = sorted((s, e, kind) for kind, own in zip(KINDS, find(text)[1]) for s, e in own)
    out, at = [], 0
    for i, (s, e, kind) in enumerate(spans):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


# -------------------------------------------------------------------- columns

def spans(text: Column) -> Column:
    """Struct of n_email, n_ip, n_card, n_phone, base and spans (both written out)."""
    @F.arrow_udf("n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    def of(column: pa.Array) -> pa.Array:
        return in_slices(some, column)

    def some(column: pa.Array) -> pa.Array:
        counts, base, every = [], [], []
        for value in column:
            plain, all_spans = find(value.as_py())
            counts.append([len(x) for x in plain])
            base.append(joined(plain))
            every.append(joined(all_spans))
        cols = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
        return pa.StructArray.from_arrays([*cols, pa.array(base, pa.string()), pa.array(every, pa.string())],
                                          ["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])
    return of(text)


def scan(docs: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.select(*keep, spans(text).alias("_found")).select(*keep, "_found.*")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with personal data replaced; other columns as given."""
    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        return in_slices(lambda some: pa.array([redacted(v.as_py()) for v in some], pa.string()), column)

    ship_package(docs.sparkSession)
    rows = boxed(docs)
    return unboxed(rows.withColumn(ROW, F.col(ROW).withField(f"`{text_col}`", of(field(text_col)))))
