import glob
import os
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.operators import index
from quire.operators.index import (index_delete, index_exists, index_from_postings, index_stats, index_update, open_index,
                                   spread, term_counts, write_index)
from quire.operators.ranking import query_terms, rank
from quire.operators.upsert import latest_per_key, upsert


@pytest.fixture(autouse=True)
def four_parts(spark):
    """Small indexes in four partitions, so that updates have some to leave alone."""
    spark.conf.set("quire.index.parts", "4")
    yield
    spark.conf.unset("quire.index.parts")


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, contents string")


def stats(idx):
    return tuple(index_stats(idx).first()), sorted(map(tuple, idx.terms.collect()))


A, B, C = [(1, "red fox"), (2, "red dog")], [(3, "blue fox fox")], [(9, "green")]


def test_create_append_create(spark, tmp_dir):
    p = f"{tmp_dir}/i"
    with pytest.raises(FileNotFoundError):
        write_index(spark, docs(spark, A), p, "append")
    write_index(spark, docs(spark, A), p, "create_or_append")
    two = write_index(spark, docs(spark, B), p, "create_or_append")
    assert stats(two) == stats(write_index(spark, docs(spark, A + B), f"{tmp_dir}/whole"))
    again = write_index(spark, docs(spark, C), p, "create")
    assert stats(again) == stats(open_index(spark, p)) == ((1, 1, 1, 1), [("green", 1, 1)])


def test_unfinished_index_is_none(spark, tmp_dir):
    p = f"{tmp_dir}/i"
    docs(spark, B).write.parquet(f"{p}/docs")
    docs(spark, B).write.parquet(f"{p}/terms")
    assert not index_exists(spark, p)
    with pytest.raises(FileNotFoundError):
        open_index(spark, p)
    write_index(spark, docs(spark, A), p)
    assert index_exists(spark, p) and index_stats(open_index(spark, p)).first().n_docs == 2


def files(path):
    import glob
    import os
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_update_rewrites_touched_partitions_only(spark, tmp_dir):
    p = f"{tmp_dir}/i"
    write_index(spark, docs(spark, [(i, f"red fox {i}") for i in range(200)]), p)
    before = {t: files(f"{p}/{t}") for t in ("postings", "docs")}
    index_update(spark, docs(spark, [(7, "blue dog")]), p)
    for t, old in before.items():
        kept = set(old) & set(files(f"{p}/{t}"))
        gone = {f.split("part=")[1].split("/")[0] for f in set(old) - kept}
        assert len(gone) == 1 and kept and all(old[f] == files(f"{p}/{t}")[f] for f in kept)
    # an append rewrites nothing
    before = files(f"{p}/postings")
    write_index(spark, docs(spark, [(500, "green")]), p, "append")
    assert before.items() <= files(f"{p}/postings").items()


def test_partitions_may_become_empty(spark, tmp_dir):
    p = f"{tmp_dir}/i"
    write_index(spark, docs(spark, A + B), p)
    assert stats(index_update(spark, docs(spark, [(1, ""), (2, None)]), p)) == ((3, 1, 3, 2), [("blue", 1, 1), ("fox", 1, 2)])
    none = index_delete(spark, p, docs(spark, A + B))
    assert stats(none) == ((0, 0, 0, 0), []) and none.docs.count() == none.postings.count() == 0
    assert stats(write_index(spark, docs(spark, C), p, "append")) == ((1, 1, 1, 1), [("green", 1, 1)])


def test_delete_in_place(spark, tmp_dir):
    p = f"{tmp_dir}/i"
    write_index(spark, docs(spark, [(i, f"red fox w{i}") for i in range(40)]), p, stored=("contents",))
    idx = index_delete(spark, p, docs(spark, [(i, "") for i in range(0, 40, 2)] + [(99, "")]))
    fresh = write_index(spark, docs(spark, [(i, f"red fox w{i}") for i in range(1, 40, 2)]), f"{tmp_dir}/fresh")
    assert stats(idx) == stats(fresh) and sorted(r.contents for r in idx.docs.collect()) == sorted(f"red fox w{i}" for i in range(1, 40, 2))


def test_positions_stay_with_the_index(spark, tmp_dir):
    p = f"{tmp_dir}/i"
    write_index(spark, docs(spark, [(1, "red fox red")]), p, positions=True)
    write_index(spark, docs(spark, [(2, "dog red")]), p, "append")
    idx = index_update(spark, docs(spark, [(3, "fox fox")]), p)
    assert idx.positions and {(r.doc_id, r.term): r.positions for r in idx.postings.collect()} == {
        (1, "red"): [0, 2], (1, "fox"): [1], (2, "dog"): [0], (2, "red"): [1], (3, "fox"): [0, 1]}


def test_build_shuffles_counted_terms_not_texts(spark, tmp_dir):
    """Many splits: one exchange, of arrays of counted terms; no text passes it."""
    d = docs(spark, [(i, f"red fox {i}") for i in range(64)]).repartition(32)
    d.write.parquet(f"{tmp_dir}/texts")
    source = spark.read.parquet(f"{tmp_dir}/texts")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        assert spread(source, 8) is source and spread(docs(spark, A), 8).rdd.getNumPartitions() == 8
        for analyzer in ("standard", "simple", "shingle2"):
            plan = term_counts(source, analyzer, buckets=8)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1, plan
            line = next(x for x in plan.splitlines() if "Exchange" in x)
            below = plan[plan.index(line):]
            assert "_c#" in below.splitlines()[1] and "contents#" not in below.splitlines()[1], plan
            assert "Exchange" not in term_counts(source, analyzer, positions=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_update_equals_rebuild(spark, tmp_dir):
    p = f"{tmp_dir}/i"
    write_index(spark, docs(spark, A), p)
    write_index(spark, docs(spark, B), p, "append")
    for new, rows in (([(2, "white cat"), (4, "new dog")], [(1, "red fox"), (2, "white cat"), (3, "blue fox fox"), (4, "new dog")]),
                      ([(2, "grey cat cat")], [(1, "red fox"), (2, "grey cat cat"), (3, "blue fox fox"), (4, "new dog")])):
        idx = index_update(spark, docs(spark, new), p)
        fresh = write_index(spark, docs(spark, rows), f"{tmp_dir}/{rows[1][1][:2]}")
        assert stats(idx) == stats(fresh)
        assert sorted(map(tuple, idx.postings.select("doc_id", "term", "tf", "dl").collect())) == \
            sorted(map(tuple, fresh.postings.select("doc_id", "term", "tf", "dl").collect()))
        assert idx.docs.count() == 4


def test_analyzer_and_stop_words_stay_with_the_index(spark, tmp_dir):
    p = f"{tmp_dir}/i"
    stops = spark.createDataFrame([("red",), ("the",)], "word string")
    write_index(spark, docs(spark, A), p, analyzer="simple", stop_words=stops)
    idx = write_index(spark, docs(spark, [(3, "The red moose 1")]), p, "append")
    assert idx.analyzer == "simple" and {r.term for r in idx.terms.collect()} == {"fox", "dog", "moose"}
    with pytest.raises(ValueError):
        open_index(spark, p, "standard")
    with pytest.raises(ValueError):
        write_index(spark, docs(spark, B), p, "append", analyzer="standard")
    q = spark.createDataFrame([(1, "RED dog the"), (2, "the red")], "query_id long, text string")
    idx = open_index(spark, p)
    assert [(r.query_id, r.term) for r in query_terms(q, idx.analyzer, stop_words=idx.stop_words).collect()] == [(1, "dog")]
    assert [(r.query_id, r.doc_id) for r in rank(idx, q, "bm25", None, 5).collect()] == [(1, 2)]
    copy = index_from_postings(spark, idx.postings, idx.docs, f"{tmp_dir}/copy", idx.analyzer, idx.stop_words)
    assert stats(copy) == stats(idx) and copy.stop_words.count() == 2


@pytest.mark.parametrize("analyzer", ["standard", "simple", "english", "spanish", "keyword"])
def test_texts_are_read_once(spark, tmp_dir, analyzer):
    """Whatever the analyzer, a build scans the texts once for its postings."""
    docs(spark, A + B).write.parquet(f"{tmp_dir}/texts")
    source = spark.read.parquet(f"{tmp_dir}/texts")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    write_index(spark, source.mapInArrow(count, source.schema).select("doc_id", "contents"), f"{tmp_dir}/i", analyzer=analyzer)
    # once for the postings, once for the stored ids
    assert seen.value == 2 * len(A + B)


def test_repeated_update_keys(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "z", 1)], "k long, v string, t long")
    new = spark.createDataFrame([(1, "b", 5), (1, "c", 5), (3, "d", 1)], "k long, v string, t long")
    for order in (None, "t"):
        got = sorted((r.k, r.v) for r in upsert(old, new, "k", order).collect())
        assert got == [(1, "c"), (2, "z"), (3, "d")]
    assert latest_per_key(new, "k").count() == 2


def test_ranking_groups_without_an_exchange(spark, tmp_dir):
    """Between the postings scan and the partial top-k nothing is shuffled; also in a
    session that has to declare the table itself."""
    p = f"{tmp_dir}/i"
    idx = write_index(spark, docs(spark, [(i, f"red fox {i % 7} dog") for i in range(50)]), p)
    q = spark.createDataFrame([(1, "red 3"), (2, "dog 5")], "query_id long, text string")
    other = spark.newSession()
    name = next(t.name for t in other.catalog.listTables() if t.name.startswith("quire_"))
    assert name
    for index in (idx, open_index(spark, p)):
        run = rank(index, q, "bm25", None, 3)
        assert {(r.query_id, r.rk, r.doc_id) for r in run.collect()} >= {(1, 1, 3), (2, 1, 5)}
        plan = run._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("FileScan")]
        shuffles = [x for x in above.splitlines() if "Exchange hashpartitioning" in x]
        assert all("query_id" in x and "doc_id" not in x for x in shuffles), plan


def test_update_reads_whole_texts(spark):
    """Terms after character 200 of updated documents count, once each."""
    from quire.plans.q_sources import index_update_q
    sf = "/root/testdata/sf0.001"
    got = {r.term: (r.df, r.cf) for r in index_update_q(spark, sf).collect()}
    d = spark.read.parquet(f"{sf}/documents.parquet")
    new = d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" updated")))
                   .otherwise(F.col("text")).alias("contents"))
    assert d.filter("doc_id % 3 = 0 and length(text) > 200").count()
    tf = new.select("doc_id", F.explode(F.regexp_extract_all(F.lower("contents"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("term")) \
        .groupBy("doc_id", "term").count()
    want = {r.term: (r.df, r.cf) for r in tf.groupBy("term").agg(F.count("doc_id").alias("df"), F.sum("count").alias("cf")).collect()}
    assert got == want


# rows with what an index must keep apart: a null text, an empty one, an id twice, a null id
MIXED = [(1, "B a b, a-b"), (2, None), (3, "..."), (4, "x"), (1, "b b"), (None, "é É a b"), (5, "a b a b c a b")]


def brute(analyzer):
    out = Counter()
    for i, text in MIXED:
        words = re.findall(r"\w+", (text or "").lower())
        if analyzer == "shingle2":
            words = [f"{a} {b}" for a, b in zip(words, words[1:])]
        out.update((i, t, n, len(words)) for t, n in Counter(words).items())
    return out


def test_terms_counted_beside_the_text(spark, monkeypatch):
    """Counts of Arrow batches, cut anywhere, equal those by hand; no array is sorted."""
    got = term_counts(docs(spark, MIXED), "standard")
    assert "sort_array" not in got._jdf.queryExecution().executedPlan().toString()
    assert Counter(map(tuple, got.collect())) == brute("standard")
    lists = [["a", "b", "a", "b"], None, [], ["x"], ["a", "b", "c", "a", "b"], ["b"]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(lists, pa.list_(pa.string()))], ["id", "_toks"])
    for at_once in (1, 3, 100):
        monkeypatch.setattr(index, "COUNTED", at_once)
        out = [r for b in index.counted(iter([batch, batch.slice(2, 3)])) for r in b.to_pylist()]
        assert [(r["dl"], dict(zip(r["_c"]["term"], r["_c"]["tf"]))) for r in out] == \
            [(None if x is None else len(x), Counter(x)) for x in lists + lists[2:5]]


def test_pairs_counted_as_numbers(spark):
    """Word pairs are counted before a text is made of them."""
    got = term_counts(docs(spark, MIXED), "shingle2")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "sort_array" not in plan and "zip_with" not in plan
    assert Counter(map(tuple, got.collect())) == brute("shingle2")


def test_postings_written_without_sort(spark, tmp_dir, monkeypatch):
    """The files of a bucket's partitions are written side by side, one for each; the setting is put back."""
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(key, None)
    part = index._part
    monkeypatch.setattr(index, "_part", lambda parts: (seen.append(spark.conf.get(key, None)), part(parts))[1])
    many = [(i, f"w{i % 7} x{i % 3} y") for i in range(200)]
    p = f"{tmp_dir}/i"
    write_index(spark, docs(spark, many[:120]), p)
    files = [os.path.basename(f).split("_")[1] for f in glob.glob(f"{p}/postings/part=0/*.parquet")]
    assert "5" in seen and len(files) == len(set(files))
    both = write_index(spark, docs(spark, many[120:]), p, "append")
    assert spark.conf.get(key, None) == before
    assert stats(both) == stats(write_index(spark, docs(spark, many), f"{tmp_dir}/whole"))
    assert both.postings.count() == 600
