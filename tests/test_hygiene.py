from pyspark.sql import functions as F

from quire.operators.hygiene import dedup_exact, dup_groups, java_string_hash, top_terms
from quire.operators.index import build_index


def _java_hash(s):
    h = 0
    for unit in s.encode("utf-16-be").hex(" ", 2).split() if s else []:
        h = (31 * h + int(unit, 16)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_java_hash(spark):
    texts = ["", "a", "hello world", "ßtraße", "x\U0001F600y", "[a, , b]" * 500]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(java_string_hash(F.col("t"))).collect()]
    assert got == [_java_hash(t) for t in texts]
    assert got[1] == 97 and got[2] == 1794106052          # values of String.hashCode


def test_dedup_idempotent_and_groups(spark):
    docs = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (5, "x"), (4, "z")],
                                 "doc_id long, contents string")
    once = dedup_exact(docs)
    assert sorted(r["doc_id"] for r in once.collect()) == [1, 2, 4]
    assert sorted(r["doc_id"] for r in dedup_exact(once).collect()) == [1, 2, 4]
    g = sorted((r["doc_id"], r["kept_id"], r["n_copies"]) for r in dup_groups(docs).collect())
    assert g == [(1, 1, 3), (3, 1, 3), (5, 1, 3)]


def test_top_terms(spark):
    docs = spark.createDataFrame([(1, "a a b c"), (2, "a d"), (3, "")], "doc_id long, contents string")
    idx = build_index(spark, docs, "standard")
    rows = [(r["doc_id"], r["rank"], r["term"]) for r in
            top_terms(idx, 2).orderBy("doc_id", "rank").collect()]
    # N = 3 documents (the empty one counts): a = 2*log10(3/2) = 0.35,
    # b = c = d = log10(3) = 0.48 (ties by term)
    assert rows == [(1, 1, "b"), (1, 2, "c"), (2, 1, "d"), (2, 2, "a")]
