"""The shuffle fallbacks taken when a query-side table exceeds the broadcast
bound must give the same answers as the broadcast plans."""

from quire.operators.index import build_index
from quire.operators.joins import CONF_MAX_ROWS
from quire.operators.ranking import rank
from quire.operators.upsert import upsert


def test_salted_ranking_equals_broadcast(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(["the"] * (i % 5 + 1) + [f"w{i % 7}", f"x{i % 3}"])) for i in range(60)],
        "doc_id long, contents string")
    idx = build_index(spark, docs, "standard")
    q = spark.createDataFrame([(1, "the w1"), (2, "x2 w3 the"), (3, "w6")], "query_id long, text string")
    want = sorted(map(tuple, rank(idx, q, "bm25", None, 5).collect()))
    spark.conf.set(CONF_MAX_ROWS, "0")          # nothing may be broadcast by count
    try:
        plan = rank(idx, q, "bm25", None, 5)._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, rank(idx, q, "bm25", None, 5).collect()))
    finally:
        spark.conf.unset(CONF_MAX_ROWS)
    assert got == want
    assert "_salt" in plan


def test_upsert_keeps_newer_rows(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 1)], "k long, v string, ts long")
    upd = spark.createDataFrame([(1, "old", 3), (2, "new", 2), (2, "newer", 4), (3, "c", 0)],
                                "k long, v string, ts long")
    for conf in (None, "0"):
        if conf:
            spark.conf.set(CONF_MAX_ROWS, conf)
        try:
            got = sorted(map(tuple, upsert(old, upd, "k", "ts").collect()))
        finally:
            spark.conf.unset(CONF_MAX_ROWS)
        assert got == [(1, "a", 5), (2, "newer", 4), (3, "c", 0)]


def test_broadcast_bound_counts_bytes(spark):
    from quire.operators.joins import CONF_MAX_BYTES, fits_broadcast
    long = spark.range(20).selectExpr("id", "repeat('x', 1000) as t")
    assert fits_broadcast(long)
    spark.conf.set(CONF_MAX_BYTES, "10000")
    try:
        assert not fits_broadcast(long)
        assert fits_broadcast(long.limit(5)) and fits_broadcast(spark.range(100))
    finally:
        spark.conf.unset(CONF_MAX_BYTES)


def test_salts_spread_any_id(spark):
    from quire.operators.joins import salted_join
    big = spark.range(640).selectExpr("id * 32 as doc_id", "concat('d', id) as name", "1 as k")
    small = spark.createDataFrame([(1, "v")], "k int, v string")
    for col in ("doc_id", "name"):
        j = salted_join(big, small, "k", salts=32, spread_col=col)
        assert j.count() == 640
        salts = big.selectExpr(f"pmod(xxhash64({col}), 32) as s").groupBy("s").count().collect()
        assert len(salts) == 32 and max(r["count"] for r in salts) < 60


def test_hot_cold_join_beyond_the_bound(spark):
    from pyspark.sql import functions as F
    from quire.operators.joins import join_hot_cold
    big = spark.range(300).selectExpr("id", "if(id % 3 = 0, 'hot', concat('t', id % 50)) as term")
    dim = big.groupBy("term").agg(F.count("id").alias("df"))
    want = sorted(map(tuple, big.join(dim, "term").select("id", "term", "df").collect()))
    spark.conf.set(CONF_MAX_ROWS, "0")
    try:
        j = join_hot_cold(big, dim, "term", F.col("df") > 50)
        plan = j._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, j.select("id", "term", "df").collect()))
    finally:
        spark.conf.unset(CONF_MAX_ROWS)
    assert got == want and plan.count("_salt") > 4


def test_ordered_ids(spark):
    from quire.sources.collection import ordered_ids
    df = spark.range(1000).selectExpr("concat('p', lpad(cast(id * 7 % 1000 as string), 4, '0')) as path")
    rows = ordered_ids(df, "path", "n").orderBy("path").collect()
    assert [r.n for r in rows] == list(range(1, 1001))
