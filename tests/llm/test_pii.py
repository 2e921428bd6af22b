import functools
import random
import re

import pytest
from pyspark.sql import functions as F

from quire.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


@functools.cache
def base(text):
    """The patterns as they are (quadratic on long runs; a sign or digit is looked for first)."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return [[m.span() for m in EMAIL.finditer(text)] if "@" in text else [],
            [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
            [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
            [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]]


def test_plain_spans_match_patterns():
    rng = random.Random(5)
    pool = ["a", "b_", "@", ".", "1", "23", "456", "-", " ", "+", "(", ")", "%", "c.d", "0", "255", "\n", "é", "4111 1111 1111 1111", "x@y.z"]
    for _ in range(20_000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(15)))
        assert pii.plain_spans(text) == base(text), text


@pytest.mark.parametrize("text,want", [
    ("write john.doe [at] example [dot] com now", "email:6:37"),
    ("john (at) mail (dot) example (dot) org", "email:0:38"),
    ("reach jane at example dot com today", "email:6:29"),
    ("john@example dot com", "email:0:20"),
    ("john@example[.]com", "email:0:18"),
    ("ｊｏｈｎ＠ｅｘ．ｃｏｍ", "email:0:11"),
    ("jоhn@exаmple.com", "email:0:16"),
    ("jоhn@example.com", "email:0:16,email:2:16"),
    ("j​ane@example.com", "email:0:17,email:2:17"),
    ("call plus one three seven seven five five five one two three four ok", "phone:5:65"),
    ("ip one nine two dot one six eight dot one dot two three four x", "ip:3:60"),
    ("card four one one one one one one one one one one one one one one one", "card:5:69"),
    ("١٩٢.168.1.1", "ip:0:11"),
    ("IP 192[.]168[.]1[.]1", "ip:3:20"),
    ("call +1 (2O3) 555-l234 now", "phone:5:22"), ("4lll 1111 1111 1111", "card:0:19"), ("host 1O.0.0.1", "ip:5:13"),
    ("pay 4111 1111 1111 1111 I was", "card:4:23"), ("pay 411111111111111 O", ""), ("Oil 55 lol", ""),
    ("meet at noon. dot com", ""), ("call at one two three dot", ""), ("un deux trois quatre", ""),
    ("AT&T at home (at) 5", ""), ("look at the dot", ""), ("a@b.c", "email:0:5"), ("", ""), (None, ""),
])
def test_disguises(text, want):
    assert pii.joined(pii.find(text)[1]) == want


def test_base_spans_stay():
    for text in ("a@b.c and d [at] e [dot] f", "+1 (243) 555-5526 plus one two three four five six seven eight"):
        plain, every = pii.find(text)
        assert all(set(p) <= set(e) for p, e in zip(plain, every))
        assert sum(map(len, every)) == sum(map(len, plain)) + 1


def test_redacted():
    assert pii.redacted("mail a@b.c, j [at] x [dot] com, 10.0.0.1!") == "mail [EMAIL], [EMAIL], [IP]!"
    assert pii.redacted("jоhn@example.com") == "[EMAIL]"
    assert pii.redacted(None) is None and pii.redacted("") == ""


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 100_000, "+1(" * 60_000, "@" * 100_000, "a@b.c_" * 40_000,
                                  " at " * 50_000, "dot" + " " * 100_000, "1O" * 60_000, "1 I " * 40_000, "(1" * 50_000, "[ " * 50_000, "one " * 20_000])
def test_long_texts_in_linear_time(text):
    import time
    t = time.process_time()
    pii.find(text)
    assert time.process_time() - t < 10


def test_columns(odd, clashing):
    for docs in (odd, clashing):
        rows = pii.scan(docs, F.col("text"), ["doc_id", "text"]).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.base == pii.joined(base(r.text or "")) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(x) for x in base(r.text or "")]
    clean = pii.redact(clashing)
    assert clean.columns == clashing.columns and clean.count() == clashing.count()
    assert clean.filter("text is null").count() == clashing.filter("text is null").count()
    assert pii.redact(odd.limit(0)).count() == 0


@pytest.mark.parametrize("text,want", [
    ("john at mail.example dot com", "email:0:28"), ("john at a.mail.example (dot) com", "email:0:32"),
    ("write john at gmail.com today", "email:6:23"), ("john\nat\ngmail.com", "email:0:17"), ("john at yahoo.co.uk.", "email:0:19"),
    ("max [at] beispiel [punkt] de", "email:0:28"), ("jean (at) exemple (point) fr", "email:0:28"), ("ana {at} ejemplo {punto} es", "email:0:27"),
    ("max at beispiel punkt de", "email:0:24"), ("max at mail punkt beispiel punkt de", "email:0:35"), ("max@beispiel punkt de", "email:0:21"),
    ("jean@exemple [point] fr", "email:0:23"), ("ana at mail.ejemplo punto es", "email:0:28"), ("IP 192[punkt]168[punkt]1[punkt]1", "ip:3:32"),
    ("look at example.com", ""), ("your account at gmail.com", ""), ("john at gmail.com.example", ""), ("at this point in time", ""),
    ("arrive at some point in May", ""), ("write a@b.fr point final", "email:6:12"), ("at that point we (point) out", ""),
])
def test_signs_in_other_words(text, want):
    assert pii.joined(pii.find(text)[1]) == want


@pytest.mark.parametrize("text", ["a at " * 40_000 + "gmail.com", "a at b" + ".c" * 50_000, "punkt " * 40_000 + "de", "a@b point " * 30_000 + "fr",
                                  "x" * 100_000 + " at gmail.com", "a at gmail.com " * 10_000, "[punkt " * 40_000, "a at " + "b" * 100_000 + " "])
def test_signs_in_linear_time(text):
    import time
    t = time.process_time()
    pii.find(text)
    assert time.process_time() - t < 10


@pytest.mark.parametrize("zeros", [4_300, 5_000, 200_000])
def test_long_runs_of_zeros_in_an_ip(zeros):
    """Python reads no number of over 4,300 digits."""
    assert pii.plain_spans("0" * zeros + ".1.2.3")[1] == [(0, zeros + 6)]
    assert pii.plain_spans("1.2." + "0" * zeros + "256.4")[1] == []
    assert pii.redacted("x " + "0" * zeros + ".1.2.3 y") == "x [IP] y"
