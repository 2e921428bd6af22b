import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts(spark, odd, make):
    rng = random.Random(2)
    more = make([(100 + i, "".join(rng.choice(["a ", "b ", "c\n", "d\t", "é ", "\n", "# ", "|", "x\x0b", "\r\n", "\x1c"])
                                   for _ in range(rng.randrange(120)))) for i in range(80)])
    docs = odd.unionByName(more)
    rows = quality.score(docs, F.col("text"), ["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = brute(r.text)
        assert tuple(r[c] for c in quality.BASE) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def brute_em(patterns):
    """patterns: votes -> n. Posterior per pattern."""
    k = len(next(iter(patterns)))
    prior, good, bad = quality.PRIOR_GOOD, [quality.GOOD_ON_GOOD] * k, [quality.BAD_ON_BAD] * k

    def posterior(v):
        x = math.log(prior) - math.log(1 - prior)
        for i in range(k):
            x += {1: math.log(good[i]) - math.log(1 - bad[i]), -1: math.log(1 - good[i]) - math.log(bad[i]), 0: 0}[v[i]]
        return 1 / (1 + math.exp(-x))
    for _ in range(quality.ROUNDS):
        g = {v: posterior(v) for v in patterns}
        n = sum(patterns.values())
        new_prior = (sum(m * g[v] for v, m in patterns.items()) + quality.PSEUDO * quality.PRIOR_GOOD) / (n + quality.PSEUDO)
        rate = lambda i, hit, w, e: ((sum(m * w(g[v]) for v, m in patterns.items() if v[i] == hit) + quality.PSEUDO * e)
                                     / (sum(m * w(g[v]) for v, m in patterns.items() if v[i]) + quality.PSEUDO))
        good, bad = ([rate(i, 1, lambda p: p, quality.GOOD_ON_GOOD) for i in range(k)],
                     [rate(i, -1, lambda p: 1 - p, quality.BAD_ON_BAD) for i in range(k)])
        prior = new_prior
    return {v: posterior(v) for v in patterns}


def test_em_matches_brute_force(spark):
    rng, k = random.Random(5), len(quality.RULES)
    patterns = {tuple(rng.choice([1, 1, 1, 0, -1]) for _ in range(k)): rng.randrange(1, 500) for _ in range(40)}
    rows = spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<int>, n long")
    fitted = quality.fit(rows).select(F.explode("rows").alias("r"), "model")
    got = {tuple(r.v): r.q for r in fitted.select("r.v", quality._posterior(F.col("r.v"), F.col("model")).alias("q")).collect()}
    want = brute_em(patterns)
    assert got == {v: pytest.approx(q, abs=1e-9) for v, q in want.items()}


def test_no_python_and_no_text_shuffle(spark, odd):
    plan = quality.counts(odd, F.col("text"), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_filter(odd, clashing):
    kept = quality.filter_quality(clashing)
    assert kept.columns == clashing.columns
    kept.collect()
    assert quality.filter_quality(odd.limit(0)).count() == 0


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score(docs, F.col("text"), ["doc_id"]).filter("not base_failed").drop("quality") \
        .join(labels, "doc_id").groupBy(F.col("quality")).agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()
    share = {r["quality"]: r.k for r in rows}
    assert share[1] == 1.0 and share[0] < 0.05
