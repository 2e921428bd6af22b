import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs)


def slow_bins(text, dims):
    """Grams one by one."""
    body = "".join(c if c.isalpha() else "\n" for c in text.lower())
    out = " " + " ".join(w for w in body.split("\n") if w) + (" " if body.strip("\n") and not body.endswith("\n") else "  ")
    out = " " + " ".join(w for w in body.split("\n") if w) + " "
    mask = (1 << 32) - 1
    c = [ord(x) for x in out]
    one = [x * 0x9E3779B1 & mask for x in c]
    two = [(a ^ (b * 0x85EBCA77 & mask)) * 0xC2B2AE3D & mask for a, b in zip(one, c[1:])]
    three = [(a ^ (b * 0x27D4EB2F & mask)) * 0x165667B1 & mask for a, b in zip(two, c[2:])]
    shift = 32 - dims.bit_length() + 1
    return sorted(x >> shift for x in one[1:-1] + two + three)


@pytest.mark.parametrize("text", ["Ab", "Hello, Wörld", "a1b", "x y", "É à"])
def test_grams(text):
    assert sorted(langid.gram_bins(text, 8192).tolist()) == slow_bins(text, 8192)


def test_held_out_accuracy(docs, model):
    rows = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 250
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) < 0.05 * len(rows)


def test_held_out_documents_are_not_learned_from(docs, model):
    changed = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))) \
        .withColumn("text", F.when(langid.held_out(F.col("doc_id")), F.lit("zzz")).otherwise(F.col("text")))
    other = langid.fit(changed)
    assert other.languages == model.languages and np.array_equal(other.centroids, model.centroids)


def test_prediction_uses_text_only(docs, model):
    a = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    b = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("?")), model).collect()
    assert a == {r.doc_id: r.lang_pred for r in b}


def test_sample_is_bounded(docs):
    got = langid.sample(docs, "text", "lang", "doc_id", 20).groupBy("lang").count().collect()
    assert {r["count"] for r in got} == {20}


def test_far_text_is_rejected(model):
    out = model.predict(["Жили были дед и баба, ели кашу с молоком", "123 !!", "", None, "12 a"])
    assert out[0][2] and out[1][:2] == out[2][:2] == out[3][:2] == ("und", 0.0) and out[4][0] in model.languages


def test_odd(odd, clashing, model):
    for docs in (odd, clashing):
        rows = langid.identify(docs, model).collect()
        assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or "")) for r in rows if r.doc_id not in (None, 7))
    assert langid.identify(odd.limit(0), langid.fit(odd.limit(0))).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(odd.limit(0))).collect()} == {"und"}
    assert langid.fit(clashing).languages


def slow_fit_and_predict(sample, texts, dims, clusters):
    """TF-IDF, spherical k-means and nearest cosine, term by term with dictionaries."""
    import math
    from collections import Counter

    def tf(text):
        return {b: 1 + math.log(n) for b, n in Counter(slow_bins(text, dims)).items()}

    def unit(v):
        size = math.sqrt(sum(x * x for x in v.values()))
        return {b: x / size for b, x in v.items()} if size else v

    def cos(a, b):
        return sum(x * b.get(k, 0.0) for k, x in a.items())
    rows = [(lang, tf(t)) for lang, t in sample]
    df = Counter(b for _, v in rows for b in v)
    idf = lambda b: math.log((1 + len(rows)) / (1 + df.get(b, 0))) + 1
    weigh = lambda v: unit({b: x * idf(b) for b, x in v.items()})
    centroids = []
    for lang in sorted({lang for lang, _ in rows}):
        own = [weigh(v) for x, v in rows if x == lang]
        centres = [own[np.random.default_rng(langid.SEED).integers(len(own))]]
        while len(centres) < min(clusters, len(own)):
            likes = [max(cos(v, c) for c in centres) for v in own]
            centres.append(own[likes.index(min(likes))])
        for _ in range(langid.ROUNDS):
            member = [max(range(len(centres)), key=lambda c: (cos(v, centres[c]), -c)) for v in own]
            sums = []
            for c in range(len(centres)):
                total = Counter()
                for v, m in zip(own, member):
                    if m == c:
                        total.update(v)
                sums.append(unit(dict(total)) if total else centres[c])
            centres = sums
        centroids += [(lang, c) for c in centres]
    out = []
    for t in texts:
        v = weigh(tf(t))
        best = max(((cos(v, c), -i) for i, (_, c) in enumerate(centroids)))
        out.append((centroids[-best[1]][0], best[0]))
    return out


def test_fit_and_prediction_against_a_slow_version(docs):
    """The whole method on 8 documents a language, compared number by number."""
    few = docs.filter("lang is not null and length(text) between 40 and 900")
    chosen = langid.sample(few, "text", "lang", "doc_id", 8).orderBy("lang", "r").collect()
    texts = [r.text for r in few.limit(60).collect() if any(c.isalpha() for c in r.text)]
    model = langid.fit(few, per_language=8, clusters=3)
    slow = slow_fit_and_predict([(r.lang, r.text) for r in chosen], texts, langid.DIMS, 3)
    for (lang, score, _), (want, cosine) in zip(model.predict(texts), slow):
        assert lang == want and abs(score - cosine) < 1e-2      # the sample travels in half precision


def test_any_number_of_languages(spark, monkeypatch):
    """300 languages: fewer centroids and rows each; more than centroids: the frequent ones."""
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    rows = [(k * 20 + i, "".join(letters[3 * k:3 * k + 3]) * (3 + i), f"l{k:03d}") for k in range(300) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert len(model.languages) == 300 and len(model.owner) <= langid.MAX_CENTROIDS
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.filter("lang_pred = lang").count() > 0.97 * len(rows)
    monkeypatch.setattr(langid, "MAX_CENTROIDS", 100)
    model = langid.fit(docs)
    assert len(model.languages) == 100 == len(model.owner)
    assert langid.identify(docs, model).count() == len(rows)


def test_ties_go_to_the_first_language():
    """Two languages with the same centroid."""
    centroid = langid.normalised(langid.weights("same words here", 64)[None, :])
    model = langid.Model(["a", "b"], np.ones(64, np.float32), np.vstack([centroid, centroid]), np.array([0, 1]), np.zeros(2))
    assert [p[0] for p in model.predict(["same words", "here"])] == ["a", "a"]
