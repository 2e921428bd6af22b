"""Property tests on small random corpora (few examples: each runs Spark jobs)."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators.evaluation import metrics
from quire.operators.index import merge_postings, term_counts, term_stats
from quire.operators.ranking import rank

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]
corpus = st.lists(st.lists(st.sampled_from(WORDS), min_size=0, max_size=8), min_size=2, max_size=8)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _docs(spark, texts):
    return spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)],
                                 "doc_id long, contents string")


@SETTINGS
@given(texts=corpus)
def test_merge_of_partial_indexes_equals_one_build(spark, texts):
    docs = _docs(spark, texts)
    whole = {tuple(r) for r in term_stats(term_counts(docs)).collect()}
    parts = [term_counts(docs.filter(F.col("doc_id") % 2 == k)) for k in (0, 1)]
    merged = {tuple(r) for r in term_stats(merge_postings(*parts)).collect()}
    assert merged == whole


@SETTINGS
@given(texts=corpus, q=st.lists(st.sampled_from(WORDS), min_size=1, max_size=3))
def test_metrics_bounded_and_recall_monotone(spark, texts, q):
    from quire.operators.index import build_index
    docs = _docs(spark, texts)
    idx = build_index(spark, docs, "standard")
    queries = spark.createDataFrame([(1, " ".join(q))], "query_id long, text string")
    qrels = spark.createDataFrame([(1, i) for i in range(0, len(texts), 2)],
                                  "query_id long, doc_id long")
    prev = -1.0
    for cut in (1, 3, 10):
        m = metrics(rank(idx, queries, "bm25", None, cut), qrels, queries).first()
        for c in ("p", "ap", "recall", "rr"):
            assert 0.0 <= m[c] <= 1.0
        assert m["recall"] >= prev
        prev = m["recall"]
    for model, p in (("jm", 1.0), ("dirichlet", 0.0)):
        assert all(r["score"] == 0 for r in rank(idx, queries, model, p, 10).collect())


def test_streaming_upsert(spark, tmp_dir):
    from quire.streaming.upsert_stream import upsert_stream
    src = os.path.join(tmp_dir, "src")
    schema = "doc_id long, contents string, turn long"
    spark.createDataFrame([(1, "a", -1), (2, "b", -1)], schema).write.mode("append").parquet(src)
    spark.createDataFrame([(2, "b2", 5), (3, "c", 1)], schema).write.mode("append").parquet(src)
    spark.createDataFrame([(2, "b-old", 3)], schema).write.mode("append").parquet(src)
    out = upsert_stream(spark, src, spark.createDataFrame([], schema).schema,
                        os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "ckpt"),
                        key="doc_id", order_col="turn", max_files_per_batch=1)
    got = sorted((r["doc_id"], r["contents"]) for r in out.collect())
    assert got == [(1, "a"), (2, "b2"), (3, "c")]       # the older late update lost


def test_stream_rewrites_touched_buckets_once(spark, tmp_dir):
    """A batch rewrites the buckets of its keys alone; one that is delivered again is skipped."""
    import glob

    from quire.streaming.upsert_stream import current_table, upsert_epoch
    root, schema = os.path.join(tmp_dir, "t"), "doc_id long, contents string"
    files = lambda: set(glob.glob(f"{root}/rows/*/*.parquet"))
    old = spark.createDataFrame([(i, f"old {i}") for i in range(300)], schema)
    assert current_table(spark, root) is None and upsert_epoch(spark, root, old, "c", 0, "doc_id")
    before = files()
    new = spark.createDataFrame([(7, "new")], schema)
    assert upsert_epoch(spark, root, new, "c", 1, "doc_id")
    after = files()
    assert len(before - after) == 1 and len(before & after) >= 20
    assert not upsert_epoch(spark, root, spark.createDataFrame([(7, "again")], schema), "c", 1, "doc_id") and files() == after
    assert upsert_epoch(spark, root, new.limit(0), "c", 2, "doc_id") and files() == after
    assert upsert_epoch(spark, root, spark.createDataFrame([(900, "x")], schema), "other", 1, "doc_id")    # another stream's number 1
    rows = {r.doc_id: r.contents for r in current_table(spark, root).collect()}
    assert rows == {**{i: f"old {i}" for i in range(300)}, 7: "new", 900: "x"}


def test_sketches_of_parts_estimate_the_whole(spark):
    from quire.operators.index import SKETCH_ERROR, approximate_terms, build_index, term_sketch
    terms = spark.range(20000).selectExpr("concat('t', id) as term")
    parts = [term_sketch(terms.filter(f"substring(term, 2) % 3 {c}")) for c in ("< 2", "> 0")]        # a third is in both
    r = approximate_terms(*parts).first()
    assert r.error == SKETCH_ERROR and abs(r.n_terms - 20000) < 4 * r.error * 20000
    docs = spark.createDataFrame([(1, "red fox"), (2, "red dog")], "doc_id long, contents string")
    a, b = build_index(spark, docs.limit(1)), build_index(spark, docs)
    assert approximate_terms(a.sketch, b.sketch).first().n_terms == 3 and approximate_terms(a.sketch).first().n_terms == 2


def test_stream_merges_in_proportion(spark, tmp_dir, monkeypatch):
    """Seven micro-batches rewrite the table fewer times, and leave what upserting them one
    after the other does: late, equal and missing order values, keys that are null."""
    from quire.streaming import upsert_stream as us

    schema, merges = "doc_id long, contents string, turn long", []
    whole = us.merge_pending
    monkeypatch.setattr(us, "merge_pending", lambda s, root, *a: (merges.append(us._read(s, f"{root}/pending") is not None), whole(s, root, *a)))
    for order, n in (("turn", 7), (None, 3)):
        src, one, many = (os.path.join(tmp_dir, f"{x}-{order}") for x in ("src", "one", "many"))
        for i in range(n):
            rows = [(k, f"{i} {k} " + "x" * 50, None if (i + k) % 7 == 0 else (i * 5 + k) % 11) for k in range(i % 3, 30, 3)] + [(None, f"{i}", i)]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
            us.upsert_epoch(spark, one, spark.createDataFrame(rows, schema), "c", i, "doc_id", order, 4)
        merges.clear()
        got = us.upsert_stream(spark, src, spark.createDataFrame([], schema).schema, many, os.path.join(tmp_dir, f"ck-{order}"),
                               "doc_id", order, max_files_per_batch=1, buckets=4)
        assert sum(merges) < min(n, 6)
        assert sorted(map(str, got.collect())) == sorted(map(str, us.current_table(spark, one).collect()))
