import random

import pytest
from pyspark.sql import functions as F

from quire.llm import revisits


@pytest.mark.parametrize("url,want", [
    ("http://www.Example.com:80/a/?b=2&a=1&utm_source=x#frag", "example.com/a?a=1&b=2"), ("HTTPS://example.com", "example.com"),
    ("example.com/A/B//", "example.com/A/B"), ("http://m.example.com/?page=2&", "m.example.com?page=2"),
    ("http://www2.example.com:443/x?sid=1", "example.com/x"), ("", ""), (None, None), (" http://a.b/ ", "a.b")])
def test_canonical(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(revisits.canonical(F.col("u"))).first()[0] == want


def brute(records):
    out = []
    for r in records:
        if r["warc_type"] != "revisit":
            continue
        past = [] if r["url"] is None or r["warc_date"] is None else \
            [p for p in records if p["warc_type"] == "response" and p["url"] == r["url"] and p["warc_date"] is not None
             and (p["warc_date"], p["record_id"]) < (r["warc_date"], r["record_id"])]
        h, result = r["headers"] or {}, ("no_response", None, r["headers"] or {})
        if past:
            p = max(past, key=lambda p: (p["warc_date"], p["record_id"]))
            stored, tag = p["headers"] or {}, lambda x: x.get("etag") and x["etag"].removeprefix("W/")
            if tag(h) and tag(stored):
                ok = "resolved" if tag(h) == tag(stored) else "mismatch"
            elif h.get("last-modified") and stored.get("last-modified"):
                ok = "resolved" if h["last-modified"] == stored["last-modified"] else "mismatch"
            else:
                ok = "no_validator"
            merged = stored | {k: v for k, v in h.items() if k in revisits.PERMITTED} if ok == "resolved" else h
            result = (ok, p["record_id"] if ok == "resolved" else None, merged)
        out.append((r["record_id"], *result))
    return sorted(out, key=str)


SCHEMA = "record_id long, warc_type string, target_uri string, warc_date long, headers map<string,string>"


def make(rng, n):
    rows = []
    for i in range(n):
        url = rng.choice([None, "a.com", "a.com", "a.com", "b.com/x", "c.com"])
        headers = {k: rng.choice(v) for k, v in (("etag", ['"1"', 'W/"1"', '"2"']), ("last-modified", ["m", "n"]), ("date", ["d1", "d2"]),
                                                 ("content-length", ["1", "2"]), ("cache-control", ["x"])) if rng.random() < 0.5}
        rows.append(dict(record_id=i, warc_type=rng.choice(["response", "revisit", "revisit", "request"]), url=url,
                         target_uri=None if url is None else rng.choice(["http://", "https://www."]) + url,
                         warc_date=rng.choice([None, *[rng.randrange(50)] * 9]), headers=headers if rng.random() < 0.9 else None))
    return rows


@pytest.fixture
def slices(spark):
    """So many slices, as many as asked for, however small."""
    keys = {"spark.sql.shuffle.partitions": None, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}

    def of(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield of
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("n", [1, 7, 40])
def test_as_of(spark, slices, n):
    slices(n)
    records = make(random.Random(n), 400)
    df = spark.createDataFrame([tuple(r[c] for c in ("record_id", "warc_type", "target_uri", "warc_date", "headers")) for r in records], SCHEMA)
    rows = revisits.resolve(df.withColumn("url", F.lit(1)).withColumn("slice", F.lit(2)).withColumn("near", F.lit(3))).collect()
    assert sorted([(r.record_id, r.outcome, r.response_id, r.headers) for r in rows], key=str) == brute(records)
    assert {r.outcome for r in rows} == {"resolved", "mismatch", "no_validator", "no_response"}
    assert sum(r.outcome == "resolved" for r in rows) > 10


def test_hot_url_of_one_second_is_spread(spark, slices, monkeypatch):
    """20,000 records of one URL and second share the slices; records without URL or date
    and other kinds take no place in them."""
    slices(8)
    written = []
    keep = revisits.materialize
    monkeypatch.setattr(revisits, "materialize", lambda df, name: written.append(keep(df, name)) or written[-1])
    hot = spark.range(20_000).selectExpr("id as record_id", "if(id % 10 = 0, 'response', 'revisit') as warc_type", "'a.com' as target_uri",
                                         "5L as warc_date", "map('etag', cast(id - id % 10 as string)) as headers")
    lost = spark.range(3000).selectExpr("id + 50000 as record_id", "if(id % 3 = 0, 'request', 'revisit') as warc_type",
                                        "if(id % 2 = 0, null, 'a.com') as target_uri", "if(id % 2 = 0, 5L, null) as warc_date", "map('x', 'y') as headers")
    rows = revisits.resolve(hot.unionByName(lost))
    n = {(r.outcome, r.response_id is None): r["count"] for r in rows.groupBy("outcome", F.col("response_id").isNull().alias("none"))
         .agg(F.count("*").alias("count"), F.max("response_id").alias("response_id")).collect()}
    assert n == {("resolved", False): 18_000, ("no_response", True): 2000}
    sizes = [r["count"] for r in written[0].groupBy("slice").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 5000


def test_payload_repeats_and_empty(spark):
    rows = [(1, "response", "a.com", 1, {"etag": "x"}), (2, "revisit", "a.com", 2, {"etag": "x"}), (2, "revisit", "a.com", 2, {"etag": "x"})]
    df = spark.createDataFrame(rows, SCHEMA)
    got = revisits.with_payload(revisits.resolve(df), df.withColumn("payload", F.lit("body"))).collect()
    assert [(r.record_id, r.payload) for r in got] == [(2, "body"), (2, "body")]
    assert revisits.resolve(df.limit(0)).count() == 0
