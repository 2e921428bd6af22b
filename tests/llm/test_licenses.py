import random
import re

from quire.llm import licenses
from quire.llm.licenses import BASE, NOTICES, Notice, Scanner

FAR = 99
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def edits(notice, run):
    """Edit distance with the notice's exact words, and the spaces around them, kept."""
    text, hard, at = notice.words, set(), 0
    for w in text.split():
        if w in notice.exact:
            hard |= set(range(max(0, at - 1), min(len(text), at + len(w) + 1)))
        at += len(w) + 1
    loose = [not (i in hard and i - 1 in hard or i == 0 and 0 in hard or i == len(text) and i - 1 in hard)
             for i in range(len(text) + 1)]
    row = [0] + [j if loose[0] else FAR for j in range(1, len(run) + 1)]
    for i, c in enumerate(text):
        cost = FAR if i in hard else 1
        new = [row[0] + cost]
        for j, d in enumerate(run):
            new.append(min(row[j] + (0 if c == d else cost), row[j + 1] + cost, new[j] + (1 if loose[i + 1] else FAR)))
        row = new
    return min(row[-1], FAR)


def runs(notice, text):
    """All runs of whole words within the notice's edits: (start, end, edits)."""
    words, at, out = text.split(" "), [0], []
    for w in words:
        at.append(at[-1] + len(w) + 1)
    for i in range(len(words)):
        for j in range(i + 1, len(words) + 1):
            if abs(at[j] - 1 - at[i] - len(notice.words)) <= notice.edits:
                n = edits(notice, text[at[i]:at[j] - 1])
                if n <= notice.edits:
                    out.append((at[i], at[j] - 1, n))
    return out


def noisy(rng, words):
    w = list(words)
    for _ in range(rng.randrange(5)):
        i, op = rng.randrange(len(w)), rng.randrange(3)
        if op == 0:
            w[i] = rng.choice("abt 2")
        elif op == 1:
            del w[i]
        else:
            w.insert(i, rng.choice("eis 3"))
    return "".join(w)


def test_matches_are_sound_and_whole():
    rng, s, hits = random.Random(4), Scanner(), 0
    for _ in range(50):
        parts = [p for _ in range(4) for p in (noisy(rng, rng.choice(NOTICES[:14]).words), rng.choice(["x", "the", "", "license", "2"]))]
        text = " ".join(" ".join(parts).split())
        found = s.matches(text, s.candidates(text))
        for k, n in enumerate(NOTICES):
            own, every = [(a, b, e) for a, b, kk, e in found if kk == k], runs(n, text)
            hits += len(own)
            assert set(own) <= set(every), (n, text)
            # every place within the edits is reported, or meets one that is
            assert all(any(a < r[1] and r[0] < b for a, b, _ in own) for r in every), (n, text)
            assert all(x[1] <= y[0] for x, y in zip(sorted(own), sorted(own)[1:]))
    assert hits > 100


def test_every_notice_is_found_with_its_edits():
    rng, s = random.Random(5), Scanner()
    for k, n in enumerate(NOTICES):
        for _ in range(15):
            w = list(n.words)
            free = [i for i, c in enumerate(w) if c != " " and not any(
                m.start() - 1 <= i <= m.end() for x in n.exact for m in re.finditer(rf"(?<!\S){x}(?!\S)", n.words))]
            for i in rng.sample(free, n.edits):
                w[i] = "q"
            text = "some words " + "".join(w) + " and more"
            assert any(kk == k for _, _, kk, _ in s.matches(text, s.candidates(text))), text


def brute(text):
    """Digest columns by plain regular expressions."""
    words = WORD.findall(lowered(text))
    places = sorted((i, label) for label, phrase in BASE for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    return len(words), places


TEXTS = [None, "", " ", "Released under the MIT License.", "under the MIT\n * License under the MIT License",
         "Apache License, Version 2.0", "CC BY-NC 4.0 cc by nc", "CC-BY-NCé", "under the mit license", "UNDER THE MİT LICENSE",
         "undér the mit license é😀 Undr the MIT Licens!", "apache license version 3", "cc by nc " * 500, "x" * 100_000,
         "é " * 3000 + "GNU Generel Public License, version 3", "under the mit licence " * 300, "license " * 2000]


def test_scan(spark, odd, clashing, make):
    rows = make(list(enumerate(TEXTS)))
    got = {r["_row"]["doc_id"]: r for r in licenses.scan(rows).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        n, places = brute(text)
        r = got[i]
        assert r["n_words"] == n and r["n_base"] == len(places), text
        assert r["first_word"] == min((p for p, _ in places), default=None)
        assert r["last_word"] == max((p for p, _ in places), default=None)
        assert r["base_labels"] == sorted({x for _, x in places}) and set(r["base_labels"]) <= set(r["labels"])
        assert set(r["labels"]) == {x["label"] for x in r["spans"]} and 0 <= r["score"] <= 1
        for x in r["spans"]:
            assert any(n.label == x["label"] and edits(n, " ".join(WORD.findall(lowered(text[x["start"]:x["end"]])))) == x["edits"]
                       for n in NOTICES), x
    assert [(x["label"], TEXTS[10][x["start"]:x["end"]], x["edits"]) for x in got[10]["spans"]] == [
        ("mit", "undér the mit license", 1), ("mit", "Undr the MIT Licens", 2)]
    assert got[14]["labels"] == ["gpl-3"] and got[14]["spans"][0]["start"] == 6000 and got[11]["labels"] == []
    assert len(got[15]["spans"]) == 300
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(odd.limit(0)).count() == 0
    same = licenses.scan(clashing).select("_row.doc_id", "_row.spans", "n_words")
    assert {r["spans"] for r in same.collect()} == {clashing.columns.index("spans") - len(odd.columns)}


def test_own_notices(make):
    own = (Notice("x", "all rights reserved", 1),)
    r = licenses.scan(make([(1, "All rights reservd by a b a b a")]), notices=own, base=(("aba", "a b a"),)).first()
    assert r["labels"] == ["aba", "x"] and r["n_base"] == 2 and (r["first_word"], r["last_word"]) == (4, 6)
