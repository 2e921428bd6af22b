"""Per-word stemmers, written from the published algorithms.

These are small per-row helpers. They are never applied token by token: the
index and query jobs stem the *distinct vocabulary* (one row per term) in a
pandas UDF and join the result back, so the Python work grows with the
vocabulary, not with the corpus.

- ``porter_stem``: M. F. Porter, "An algorithm for suffix stripping",
  Program 14(3), 1980 (the original algorithm, steps 1a-5b).
- ``spanish_light_stem``: J. Savoy's light stemmer for Spanish (plural and
  gender endings only, after folding accented vowels).
"""

from __future__ import annotations

_VOWELS = frozenset("aeiou")


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, i, n = 0, 0, len(stem)
    while i < n and _is_cons(stem, i):
        i += 1
    while i < n:
        while i < n and not _is_cons(stem, i):
            i += 1
        if i >= n:
            break
        while i < n and _is_cons(stem, i):
            i += 1
        m += 1
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    if not (_is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2) and _is_cons(w, len(w) - 1)):
        return False
    return w[-1] not in "wxy"


def _replace_if(w: str, rules, min_m: int):
    """First rule whose suffix matches decides; replace only when m(stem) > min_m."""
    for suf, rep in rules:
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            if _measure(stem) > min_m:
                return stem + rep
            return w
    return w


# Suffix tables of Porter (1980), steps 2, 3 and 4, in the order of
# the author's published C implementation (which uses bli->ble and adds
# logi->log in step 2).
_STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
_STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
_STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def porter_stem(word: str) -> str:
    if word is None:
        return None
    w = word
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # steps 2-3
    w = _replace_if(w, _STEP2, 0)
    w = _replace_if(w, _STEP3, 0)
    # step 4
    for suf in sorted(_STEP4, key=len, reverse=True):
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            if _measure(stem) > 1:
                if suf == "ion":
                    if stem and stem[-1] in "st":
                        w = stem
                else:
                    w = stem
            break
    # step 5a
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


# Accent folding used by the Spanish light stemmer.
_ES_FOLD = str.maketrans({
    "à": "a", "á": "a", "â": "a", "ä": "a",
    "ò": "o", "ó": "o", "ô": "o", "ö": "o",
    "è": "e", "é": "e", "ê": "e", "ë": "e",
    "ù": "u", "ú": "u", "û": "u", "ü": "u",
    "ì": "i", "í": "i", "î": "i", "ï": "i",
})


def spanish_light_stem(word: str) -> str:
    """Savoy's light Spanish stemmer: fold accents, strip gender/plural endings."""
    if word is None:
        return None
    if len(word) < 5:
        return word
    w = word.translate(_ES_FOLD)
    last = w[-1]
    if last in "oae":
        return w[:-1]
    if last == "s":
        if w.endswith("eses"):
            return w[:-2]
        if w.endswith("ces"):
            return w[:-3] + "z"
        if w[-2] in "oae":
            return w[:-2]
    return w
