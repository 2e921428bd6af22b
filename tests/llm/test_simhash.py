import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quire.llm import simhash


def brute_fingerprint(text, size=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, bits=3):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clustered_prints(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out | {0, (1 << 64) - 1, 1, 3, 7, 15})


def test_fingerprints_match_brute_force():
    rng = random.Random(3)
    texts = [None, "", " \n", "One", "one TWO", "a b c", "ÄÖ É a\x0bb\x0cc", "a\x1fb\x85c d", "İ K ſ a b"]
    texts += [" ".join(rng.choice(["a", "B", "c\n", "dé", "E F"]) for _ in range(rng.randrange(400))) for _ in range(30)]
    got = simhash.fingerprints_of([None if t is None else t.encode() for t in texts], 3)
    assert [int(x) & (1 << 64) - 1 for x in got] == [brute_fingerprint(t) for t in texts]


def test_long_text_is_counted_in_parts(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(3000))
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 100)
    assert int(simhash.fingerprints_of([text.encode()], 3)[0]) & (1 << 64) - 1 == brute_fingerprint(text)


def test_trie_join_links_all_pairs():
    fps = clustered_prints(300, 1)
    values = np.array(fps, np.uint64)
    got = simhash.join_tries(values, np.array([0]), 0, 3)
    assert got.tolist() == brute_classes(fps)


def test_small_frontier_gives_the_same(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 7)
    fps = clustered_prints(200, 2)
    assert simhash.join_tries(np.array(fps, np.uint64), np.array([0]), 0, 3).tolist() == brute_classes(fps)


def test_classes_whole_and_split(spark):
    fps = clustered_prints(400, 4)
    want = brute_classes(fps)
    rows = spark.createDataFrame([(signed(x), 1000 + i) for i, x in enumerate(fps)], "fp long, id long")
    for hot in (20_000, 8):
        got = {r.fp: r.component_id for r in simhash.classes(rows, hot=hot).collect()}
        assert [got[signed(x)] for x in fps] == [1000 + w for w in want]


def test_chain_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}
    assert simhash.components(edges.limit(0)).count() == 0


def test_documents(odd, clashing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r.fp == 0]
    assert {r.component_id for r in empty} == {min(r.id for r in empty if r.id is not None)}
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    assert sorted({int(r.fp) & (1 << 64) - 1 for r in rows}) == sorted({brute_fingerprint(t) for _, t in texts})
    kept = simhash.deduplicate(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len(set(brute_classes([brute_fingerprint(t) for _, t in texts])))
    assert kept.groupBy("doc_id", "text").count().filter("count > 1").count() == 0


def test_null_ids_alone(make):
    docs = make([(None, "a b c d"), (None, "a b c d"), (None, "something else entirely, with other words")])
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {None}
    assert simhash.deduplicate(docs).count() == 2


def test_empty(odd):
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    assert simhash.deduplicate(odd.limit(0)).count() == 0


def test_hex(spark):
    row = spark.createDataFrame([(-1,), (0,), (255,)], "fp long").select(simhash.as_hex(F.col("fp")).alias("h")).collect()
    assert [r.h for r in row] == ["f" * 16, "0" * 16, "0" * 14 + "ff"]


def test_rows_that_go_are_anti_joined(spark, make):
    """Documents are not shuffled: the numbers of those that go are broadcast."""
    docs = make([(i, f"one two three {i % 7} four five six") for i in range(60)])
    kept = simhash.deduplicate(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in simhash.near_duplicates(docs).collect()})


def test_walk_has_partitions_by_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "WALKED", 20)
    fps = [signed(x) for x in random.Random(8).sample(range(1 << 40), 100)]
    distinct = spark.createDataFrame([(x,) for x in fps], "fp long")
    assert simhash.links(distinct).rdd.getNumPartitions() >= 20
