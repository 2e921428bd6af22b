import os

import pytest
from pyspark.sql import functions as F

from quire.sources.collection import (read_collection, read_qrels, read_query_lines,
                                      read_run_csv, read_stopwords)
from quire.sources.files import java_list_lines, scan_files


def _write(path, text, mode="w", newline=""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, newline=newline, encoding="utf-8") as f:
        f.write(text)


def test_record_splitting(spark, tmp_dir):
    p = os.path.join(tmp_dir, "coll", "a.txt")
    _write(p, "1\nalpha beta\n/\n\n2\ngamma\n  \ndelta\n/\n1\nlast wins\n/\nx9\nbad\n/\n")
    good, bad = read_collection(spark, os.path.dirname(p), with_rejects=True)
    got = {r["doc_id"]: r["contents"] for r in good.collect()}
    assert got == {1: "last wins ", 2: "gamma delta "}
    assert [r["_id"] for r in bad.collect()] == ["x9"]


def test_unterminated_tail(spark, tmp_dir):
    """What follows the last separator is no record, file by file."""
    texts = {"a": "1\nalpha\n/\n2\nbeta\n", "b": "3\ngamma/4\ndelta é/", "c": "5\nopen", "d": "\ufeff6\nmark\n/\n7\nopen",
             "e": "8\nlast/\n", "f": ""}
    for name, text in texts.items():
        _write(os.path.join(tmp_dir, "tail", f"{name}.txt"), text)
    got = {r["doc_id"]: r["contents"] for r in read_collection(spark, os.path.join(tmp_dir, "tail")).collect()}
    assert got == {1: "alpha ", 3: "gamma ", 4: "delta é ", 6: "mark ", 8: "last "}


def test_tail_of_split_files(spark, tmp_dir):
    """The size rule counts a whole file, also when tasks read parts of it."""
    _write(os.path.join(tmp_dir, "split", "a.txt"), "".join(f"{i}\ntext {i}\n/\n" for i in range(400)) + "999\nopen")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = {r["doc_id"]: r["contents"] for r in read_collection(spark, os.path.join(tmp_dir, "split")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: f"text {i} " for i in range(400)}


def test_qrels_and_query_lines(spark, tmp_dir):
    q = os.path.join(tmp_dir, "qrels", "r.txt")
    _write(q, "1\n 10 20\n30\n/\n2 7 7\n/\n1 40\n/\n")
    got = sorted((r["query_id"], r["doc_id"]) for r in read_qrels(spark, os.path.dirname(q)).collect())
    assert got == [(1, 40), (2, 7), (2, 7)]
    ql = os.path.join(tmp_dir, "ql", "q.txt")
    _write(ql, "first query\n  second  \n\nafter blank\n")
    rows = read_query_lines(spark, os.path.dirname(ql)).orderBy("query_id").collect()
    assert [(r["query_id"], r["text"]) for r in rows] == [(1, "first query"), (2, "second"),
                                                           (3, "after blank")]
    rows = read_query_lines(spark, os.path.dirname(ql), stop_at_blank=True).collect()
    assert sorted(r["text"] for r in rows) == ["first query", "second"]


def test_stopwords_and_run_csv(spark, tmp_dir):
    s = os.path.join(tmp_dir, "stop", "s.txt")
    _write(s, " the\nof\n\nthe\n")
    assert sorted(r["word"] for r in read_stopwords(spark, os.path.dirname(s)).collect()) == ["of", "the"]
    c = os.path.join(tmp_dir, "csv", "jm.test.csv")
    _write(c, "query,P@10\nvalue=0.0\n6,0.2\n7,0.3\n8,0.0\navg,0.16666667\n")
    rows = read_run_csv(spark, os.path.dirname(c)).orderBy("query_id").collect()
    assert [(r["query_id"], r["value"]) for r in rows] == [(6, 0.2), (7, 0.3), (8, 0.0)]
    assert rows[0]["run_id"] == "jm.test.csv"


def test_tree_rules(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tree")
    _write(os.path.join(root, "root.c"), "top\n")
    _write(os.path.join(root, "s1", "a.c"), "a\n\nb\n")
    _write(os.path.join(root, "s1", "deep", "B.JAVA"), "upper\n")
    _write(os.path.join(root, "s1", "deep", "er", "z.java"), "l1\r\nl2\r\n")
    all_files = scan_files(spark, root).select("rel_path", "depth", "subfolder").collect()
    assert {r["rel_path"] for r in all_files} == {"root.c", "s1/a.c", "s1/deep/B.JAVA",
                                                  "s1/deep/er/z.java"}
    sub = scan_files(spark, root, by_subfolder=True, max_depth=2)
    assert sorted(r["rel_path"] for r in sub.collect()) == ["s1/a.c", "s1/deep/B.JAVA"]
    only = scan_files(spark, root, by_subfolder=True, only_ext=["java"])
    assert [r["rel_path"] for r in only.collect()] == ["s1/deep/er/z.java"]   # case-sensitive
    nott = scan_files(spark, root, not_ext=[".c"])
    assert sorted(r["rel_path"] for r in nott.collect()) == ["s1/deep/B.JAVA", "s1/deep/er/z.java"]
    with pytest.raises(ValueError):
        scan_files(spark, root, only_ext=["c"], not_ext=["java"])
    lines = {r["rel_path"]: r["contents"]
             for r in scan_files(spark, root, content_lines=0).collect()}
    assert lines["s1/a.c"] == "[a, , b]"
    assert lines["s1/deep/er/z.java"] == "[l1, l2]"
    two = {r["rel_path"]: r["contents"] for r in scan_files(spark, root, content_lines=2).collect()}
    assert two["s1/a.c"] == "[a, ]"
    assert scan_files(spark, root, max_depth=0).count() == 0


def test_list_lines_edge_cases(spark):
    df = spark.createDataFrame([("",), ("\n",), ("x",), ("a\rb\r",)], "t string")
    got = [r[0] for r in df.select(java_list_lines(F.col("t"))).collect()]
    assert got == ["[]", "[]", "[x]", "[a, b]"]


def _lines(path):
    import glob
    return [x for f in sorted(glob.glob(f"{path}/part-*")) for x in open(f, encoding="utf-8").read().splitlines()]


def test_report_layouts(spark, tmp_dir):
    from quire.operators.evaluation import eval_report
    from quire.operators.tuning import tuning_matrix
    from quire.sources.sinks import write_eval_csv, write_training_csv
    m = spark.createDataFrame([(10, 2, 0.5, 0.25, 1.0, 1.0), (9, 2, 0.0, 0.0, 0.0, 0.0)],
                              "query_id long, n_hits long, p double, ap double, recall double, rr double")
    write_eval_csv(eval_report(m, 10), f"{tmp_dir}/eval")
    assert _lines(f"{tmp_dir}/eval") == ["queryID,P@10,AP@10,recall@10,rr,cut=10", "9,0.0,0.0,0.0,0.0", "10,0.5,0.25,1.0,1.0",
                                         "average,0.25,0.125,0.5,0.5"]
    t = spark.createDataFrame([("jm", p, q, p * q) for p in (0.0, 0.5) for q in (10, 9)],
                              "model string, param double, query_id long, value double")
    write_training_csv(tuning_matrix(t, "jm", [0.0, 0.5]), f"{tmp_dir}/train", "P@10", [0.0, 0.5])
    assert _lines(f"{tmp_dir}/train") == ["P@10,0,0.5", "9,0.0,4.5", "10,0.0,5.0", "avg,0.0,4.75"]


def test_judgements_over_lines_tasks_and_files(spark, tmp_dir):
    """One query with a million judgements, written to several files and read by many tasks."""
    from quire.sources.sinks import write_qrels
    many = spark.range(1_000_000).selectExpr("2L as query_id", "id * 3 as doc_id")
    few = spark.createDataFrame([(1, 5), (1, 4), (3, 9), (3, 9)], "query_id long, doc_id long")
    path = write_qrels(many.unionByName(few), os.path.join(tmp_dir, "big"), partitions=6)
    files = sorted(f for f in os.listdir(path) if f.startswith("part"))
    assert sum(os.path.getsize(os.path.join(path, f)) > 100_000 for f in files) >= 4
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        got = read_qrels(spark, path, across_files=True)
        r = got.filter("query_id = 2").agg(F.count("doc_id"), F.countDistinct("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
        assert tuple(r) == (1_000_000, 1_000_000, 0, 2_999_997)
        assert sorted(map(tuple, got.filter("query_id != 2").collect())) == [(1, 4), (1, 5), (3, 9)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_judgement_records_anywhere_in_lines(spark, tmp_dir):
    for name, text in {"a": "1 2 3/4 5\n6\n/ 7\n\n 8 / 9 10", "b": "/ /\n1 20 /", "c": "", "d": "11"}.items():
        _write(os.path.join(tmp_dir, "odd", f"{name}.txt"), text)
    got = sorted(map(tuple, read_qrels(spark, os.path.join(tmp_dir, "odd")).collect()))
    assert got == [(1, 20), (4, 5), (4, 6), (7, 8)]                  # 9 and 11 are open; 1 has its last record
    got = sorted(map(tuple, read_qrels(spark, os.path.join(tmp_dir, "odd"), across_files=True).collect()))
    assert got == [(1, 20), (4, 5), (4, 6), (7, 8), (9, 10)]


def test_header_of_a_run_names_its_metric(spark, tmp_dir):
    from quire.sources.collection import run_metric
    for name, text in {"a": "query,P@10\nvalue=0.0\n6,0.2\navg,0.2\n", "b": "6,0.2\n"}.items():
        _write(os.path.join(tmp_dir, name, "r.csv"), text)
    assert run_metric(spark, os.path.join(tmp_dir, "a")) == "P@10" and run_metric(spark, os.path.join(tmp_dir, "b")) is None
    assert [tuple(r) for r in read_run_csv(spark, os.path.join(tmp_dir, "a"), "x").collect()] == [("x", "P@10", 6, 0.2)]
    _write(os.path.join(tmp_dir, "a", "s.csv"), "query,MAP@10\n7,0.1\n")
    with pytest.raises(ValueError):
        run_metric(spark, os.path.join(tmp_dir, "a"))


def test_tree_files_written_by_tasks(spark, tmp_dir):
    """One file per row and nothing beside it (no checksum file, whose making starts a process),
    folders and texts as Spark's own writer has them, an older tree gone."""
    from quire.sources.sinks import write_tree

    rows = [("web", "a\nb"), ("web", "a\nb"), ("a/b=c %", "é"), (None, "x"), ("", "y"), ("web", None), ("web", "")]
    docs = spark.createDataFrame(rows, "source string, contents string").repartition(3)
    root, plain = os.path.join(tmp_dir, "tree"), os.path.join(tmp_dir, "plain")
    write_tree(spark.createDataFrame([("old", "old")], "source string, contents string"), root)
    write_tree(docs, root)
    docs.write.option("maxRecordsPerFile", 1).partitionBy("source").text(plain)

    def files(top, name):
        return sorted((os.path.basename(d), open(os.path.join(d, f), "rb").read()) for d, _, names in os.walk(top) for f in names if name(f))
    assert files(root, lambda f: True) == files(plain, lambda f: f.startswith("part-"))
    assert len(files(root, lambda f: True)) == len(rows)
    assert scan_files(spark, "file://" + root, only_ext=["txt"]).count() == len(rows)


def test_tree_is_listed_and_read_by_tasks(spark, tmp_dir):
    """The driver plans no file of a mounted tree, and the rows are those of Spark's reader:
    hidden, empty, linked, compressed and damaged files, and odd names."""
    import bz2
    import gzip
    from pyspark.sql import functions as F
    root = os.path.join(tmp_dir, "plain")
    texts = {f"s{i % 3}/d{i % 2}/f{i}.txt": f"text {i}\n".encode() for i in range(60)} | {
        "top.txt": b"t", "a b/é%41# .txt": b"x\r\ny", "s0/back\\slash{1}.txt": b"b", "s0/new\nline": b"n", "s0/none.txt": b"", "s0/bytes.txt": b"\xff\xfe ok",
        "_h/x.txt": b"h", "_h=1/x.txt": b"1", ".h/x.txt": b"h", "_metadata/y.txt": b"m", "_metadata.txt": b"m", "s1/_f.txt": b"f", "s1/_f=3": b"3",
        "s1/z._COPYING_": b"c", "s1/c:d.txt": b"c", "z/a.gz": gzip.compress(b"one") + gzip.compress(b"two"), "z/B.BZ2": bz2.compress(b"bz"), "z/bad.gz": b"no",
        "z/q[1].gz": gzip.compress(b"q"), "k/bad.txt": b"hello", "k/.bad.txt.crc": b"crc\0\0\0\2\0\0\0\0\0", "k/odd.txt": b"odd", "k/.odd.txt.crc": b"?"}
    for name, data in texts.items():
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)
    spark.createDataFrame([("good " * 500,)], "value string").coalesce(1).write.text(os.path.join(root, "k", "sums"))
    os.symlink(os.path.join(root, "s2"), os.path.join(root, "link"))
    os.symlink("/nowhere", os.path.join(root, "s2", "broken.txt"))
    m = "_metadata.file_"
    want = spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).text(root, wholetext=True).select(
        F.col(m + "path").alias("path"), F.col(m + "size").alias("size"), F.col(m + "modification_time").alias("modified"), F.hex("value").alias("h"))
    got = scan_files(spark, root)
    rows = sorted(map(tuple, got.select("path", "size", "modified", F.hex("contents")).collect()))
    assert rows == sorted(map(tuple, want.collect())) and len(rows) > 90
    assert len(got.filter("ext = 'txt'").inputFiles()) < 30 < len(want.inputFiles())
    bare = scan_files(spark, root, contents_stored=False)
    assert sorted(r.path for r in bare.select("path").collect()) == [r[0] for r in rows]
    assert bare.select("path", "partition").distinct().count() == len(rows) and bare.filter("partition IS NULL").count() == 0
    os.makedirs(os.path.join(tmp_dir, "bare", "folder"))
    assert scan_files(spark, os.path.join(tmp_dir, "bare")).count() == 0
    assert scan_files(spark, os.path.join(root, "to*.txt")).count() == 1
    assert scan_files(spark, os.path.join(root, "top.txt")).count() == 1
