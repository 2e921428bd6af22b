import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import fim
from tests.llm.conftest import PROSE

ALPHABET = ["a", "b", " ", "é", "ñ", "한", "文", "😀", "<", ">", "P", "S", "M", "\n", "́"]


def brute(doc_id, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_index_converts_both_ways():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60)))
        odd = fim.Exceptions(np.frombuffer(text.encode(), np.uint8))
        at = [len(text[:i].encode()) for i in range(len(text) + 1)]
        assert odd.bytes(np.arange(len(text) + 1)).tolist() == at
        assert odd.points(np.array(at)).tolist() == list(range(len(text) + 1))
        assert len(odd.byte) == sum(c > "\x7f" for c in text)


def check(rows, texts):
    got = {r["key"]: r for r in rows}
    assert len(got) == len(texts)
    for key, (doc_id, text) in texts.items():
        r = got[key]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(doc_id, text), (doc_id, text)
        assert r["back"]["text"] == (text or "")
        assert (r["back"]["prefix_chars"], r["back"]["middle_chars"]) == (r["prefix_chars"], r["middle_chars"])
    return {r["form"] for r in rows}


def test_against_brute_force(spark):
    rng = random.Random(8)
    texts = ["", "x", "<P>", "a<S>b", "<M", "<" * 7, "<<P", "S>a<", "😀", None, PROSE * 2000 + "é", "한" * 5000]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(80))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = fim.fill_in_middle(docs).select(F.col("_row.doc_id").alias("key"), "*")
    rows = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert check(rows, {i: (i, t) for i, t in enumerate(texts)}) == {"plain", "psm", "spm"}
    # a slice of an Arrow batch has offsets of its own
    assert docs.count() == fim.restore(made).filter(F.col("restored") == F.coalesce("_row.text", F.lit(""))).count()


def test_rates(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text of a few words").alias("text"))
    n = {r["form"]: r["count"] for r in fim.fill_in_middle(docs).groupBy("form").count().collect()}
    assert n["plain"] == pytest.approx(400, abs=80) and n["spm"] == pytest.approx(720, abs=110)
    none = fim.fill_in_middle(docs, cut=0).select("form").distinct().collect()
    assert [r[0] for r in none] == ["plain"]
    assert fim.fill_in_middle(docs, seed=2).join(fim.fill_in_middle(docs), ["_row", "output"]).count() < 1200


def test_odd(odd, clashing):
    rows = fim.fill_in_middle(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["_row"]["doc_id"], r["_row"]["text"])
    assert fim.fill_in_middle(odd.limit(0)).count() == 0
    same = fim.fill_in_middle(clashing).select("_row.*", "n").columns
    assert same == [*clashing.columns, "n"]
