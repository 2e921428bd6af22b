"""End-to-end workflows on files written by Spark from the smoke tables."""

import os

import pytest

from pyspark.sql import functions as F

from quire.plans import workflows as wf
from quire.sources.sinks import write_collection, write_qrels, write_tree
from quire.sources.tables import benchmark_queries, derived_qrels, documents
from quire.operators.index import build_index

SF = "/root/testdata/sf0.001"


def test_collection_search_tune_compare(spark, tmp_dir):
    docs = documents(spark, SF)
    q = benchmark_queries(spark, SF)
    coll = write_collection(docs, os.path.join(tmp_dir, "coll"))
    qfile = write_collection(q, os.path.join(tmp_dir, "queries"), "query_id", "text")
    idx_std = build_index(spark, docs, "standard")
    qrels = write_qrels(derived_qrels(q, idx_std.postings), os.path.join(tmp_dir, "qrels"))
    stats = wf.index_collection(spark, coll, os.path.join(tmp_dir, "ix")).first()
    assert stats["n_docs"] == docs.count()
    run, rep = wf.search_eval(spark, os.path.join(tmp_dir, "ix"), qfile, qrels,
                              os.path.join(tmp_dir, "out"), cut=10, top=5, across_files=True)
    assert rep.filter(F.col("query") == "average").count() == 1
    assert os.path.isdir(os.path.join(tmp_dir, "out", "metrics"))
    for model, out in (("jm", "tj"), ("dirichlet", "td")):
        matrix, test = wf.train_test(spark, os.path.join(tmp_dir, "ix"), qfile, qrels,
                                     os.path.join(tmp_dir, out), model, train=(0, 19),
                                     test=(20, 39), metric="MAP", across_files=True)
        assert test.filter(F.col("query") != "avg").count() == 20
    res = wf.compare(spark, os.path.join(tmp_dir, "tj", "test"), os.path.join(tmp_dir, "td", "test"),
                     "wilcoxon").first()
    assert res["n"] == 20 and res["p_exact"] is not None
    # results of another metric or cut, or without a header, are refused
    for name, head in (("other", "query,P@10"), ("cut", "query,MAP@5"), ("bare", "1,0.5")):
        path = os.path.join(tmp_dir, name)
        os.makedirs(path)
        with open(os.path.join(path, "part-0.txt"), "w") as f:
            f.write(head + "\n20,0.5\n")
        with pytest.raises(ValueError, match="metrics"):
            wf.compare(spark, os.path.join(tmp_dir, "tj", "test"), path)


def test_files_and_duplicates(spark, tmp_dir):
    docs = documents(spark, SF)
    root = write_tree(docs, os.path.join(tmp_dir, "tree"))
    idx = wf.index_files(spark, root, os.path.join(tmp_dir, "fix"), contents_stored=True,
                         content_lines=0)
    assert idx.docs.count() == docs.count()
    rep = {r["stage"]: r for r in wf.remove_duplicates(spark, os.path.join(tmp_dir, "fix"),
                                                       os.path.join(tmp_dir, "dedup")).collect()}
    distinct_texts = docs.select("contents").distinct().count()
    assert rep["after"]["n_docs"] == distinct_texts <= rep["before"]["n_docs"]
    tt = wf.top_terms_report(spark, os.path.join(tmp_dir, "fix"), os.path.join(tmp_dir, "tt"), 3)
    assert tt.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
