"""Revisit records of web archives: what a "not modified" answer stood for.

A revisit is joined, by canonical URL, to the latest earlier full response (as-of). If
their validators agree (entity tags by weak comparison, else modification dates), the
revisit becomes that response with the headers that a 304 answer may update.

The as-of join is two windows over slices: records are range-partitioned by (URL, date,
id) and written with their slice. Inside a slice each revisit takes the last response of
its URL before it; what a slice ends with is one row per URL, carried over the later
slices of that URL and joined to the revisits that found none in theirs. So a URL with a
third of all captures, also of one day or second, is spread over its slices. Records
that have no URL or date, and other kinds of records, stay out of it. Payloads stay out
of the join; ``with_payload`` fetches them by record id.

Defined results: records without URL or date neither resolve nor are resolved to
("no_response"); records at the same time are ordered by record id; repeated rows are
resolved alike; null headers are no headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import materialize

DAY = 86_400
#: The header fields that a 304 answer carries to update a stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not change what a URL shows.
IGNORED = r"^(utm_[a-z]+|gclid|fbclid|phpsessid|jsessionid|sessionid|sid)="
ORIGIN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?"


def canonical(url: Column) -> Column:
    """Host (lower case, without www and standard port), path without a last slash, and
    sorted query parameters that matter."""
    u = F.btrim(url)
    host = F.regexp_replace(F.lower(F.regexp_extract(u, ORIGIN + r"([^/?#]*)", 1)), r"^www[0-9]*\.", "")
    host = F.regexp_replace(host, r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, ORIGIN + r"[^/?#]*([^?#]*)", 1), r"/+$", "")
    params = F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&")
    query = F.array_join(F.array_sort(F.filter(params, lambda p: (p != "") & ~F.rlike(p, F.lit(IGNORED)))), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def outcome(response: Column, headers: Column) -> Column:
    """Whether a response (struct with headers) is what the revisit's headers name."""
    ours, theirs = _tag(headers), _tag(response["headers"])
    since, modified = headers["last-modified"], response["headers"]["last-modified"]
    return (F.when(response.isNull(), "no_response")
            .when(ours.isNotNull() & theirs.isNotNull(), F.when(ours == theirs, "resolved").otherwise("mismatch"))
            .when(since.isNotNull() & modified.isNotNull(), F.when(since == modified, "resolved").otherwise("mismatch"))
            .otherwise("no_validator"))


def merged(stored: Column, update: Column) -> Column:
    """Stored headers with those permitted ones that the 304 brings."""
    new = F.map_filter(update, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter(stored, lambda k, v: ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


def resolve(records: DataFrame) -> DataFrame:
    """Records (record_id, warc_type, target_uri, warc_date in seconds, headers with
    lower-case names) to one row per revisit: record_id, url, warc_date, outcome,
    response_id and headers (merged if resolved, else the revisit's own)."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = records.filter(F.col("warc_type").isin("response", "revisit")).select(
        "record_id", "warc_type", canonical(F.col("target_uri")).alias("url"), "warc_date", F.coalesce("headers", none).alias("headers"))
    placed = F.col("url").isNotNull() & F.col("warc_date").isNotNull()
    # written once: both windows must see the same slices
    sliced = materialize(rows.filter(placed).repartitionByRange("url", "warc_date", "record_id")
                         .withColumn("slice", F.spark_partition_id()), "revisit-slices")
    answer = F.struct("record_id", "headers")
    full = F.when(F.col("warc_type") == "response", answer)
    before = Window.partitionBy("slice", "url").orderBy("warc_date", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    here = sliced.withColumn("near", F.last(full, ignorenulls=True).over(before)).filter("warc_type = 'revisit'")
    # what each slice of a URL ends with, carried to the later ones
    when = F.when(F.col("warc_type") == "response", F.struct("warc_date", "record_id"))
    ends = sliced.groupBy("slice", "url").agg(F.max_by(full, when).alias("last"))
    earlier = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("slice", "url", F.last("last", ignorenulls=True).over(earlier).alias("far"))
    found = here.join(carried, ["slice", "url"], "left").withColumn("response", F.coalesce("near", "far")) \
        .withColumn("outcome", outcome(F.col("response"), F.col("headers")))
    done = F.col("outcome") == "resolved"
    resolved = found.select("record_id", "url", "warc_date", "outcome",
                            F.when(done, F.col("response.record_id")).alias("response_id"),
                            F.when(done, merged(F.col("response.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"))
    kinds = dict(resolved.dtypes)
    lost = rows.filter(~placed & (F.col("warc_type") == "revisit")).select(
        "record_id", "url", "warc_date", F.lit("no_response").alias("outcome"),
        F.lit(None).cast(kinds["response_id"]).alias("response_id"), "headers")
    return resolved.unionByName(lost)


def with_payload(resolved: DataFrame, records: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Resolved revisits with the payload of their response."""
    payloads = records.filter("warc_type = 'response'").select(F.col("record_id").alias("response_id"),
                                                               F.col(payload_col).alias("payload"))
    return resolved.join(payloads, "response_id", "left")


def captures(pages: DataFrame) -> DataFrame:
    """Capture records that a crawl of the given pages leaves: a full answer per page, a
    later "not modified" answer under another spelling of its URL (with the page's tag,
    its date, another tag, or no validator), one before the page was ever fetched for
    every seventh, and the front page of its host, every fifth time in full."""
    n, at = F.col("page_id"), F.col("page_id") * 60
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    day = F.concat(F.lit("day "), F.floor(at / DAY).cast("string"))
    length = F.length(F.coalesce("html", F.lit(""))).cast("string")
    other = F.concat(F.regexp_replace("url", "^https?:", "HTTP:"),
                     F.when(F.col("url").contains("?"), "&utm_medium=again").otherwise("?utm_medium=again"))
    other = F.when(F.col("url").contains("#"), F.col("url")).otherwise(other)
    front = F.concat(F.regexp_extract("url", ORIGIN + r"[^/?#]*", 0), F.lit("/"))
    version = F.concat(F.lit('"v'), F.floor(n / 20).cast("string"), F.lit('"'))

    def headers(*pairs: tuple[str, Column]) -> Column:
        return F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[v for _, v in pairs]))

    def record(k: int, kind: Column, url: Column, date: Column, fields: Column) -> Column:
        return F.struct((n * 4 + k).alias("record_id"), kind.alias("warc_type"), url.alias("target_uri"),
                        date.alias("warc_date"), fields.alias("headers"))
    then = (at + DAY).cast("string")
    again = (F.when(n % 4 == 0, headers(("etag", F.concat(F.lit("W/"), tag)), ("date", then), ("cache-control", F.lit("max-age=60"))))
             .when(n % 4 == 1, headers(("last-modified", day), ("date", then), ("expires", F.lit("soon")), ("content-length", F.lit("0"))))
             .when(n % 4 == 2, headers(("etag", F.lit('"other"')), ("date", then)))
             .otherwise(headers(("date", then))))
    made = F.array(
        record(0, F.lit("response"), F.col("url"), at, headers(("content-type", F.lit("text/html")), ("content-length", length),
                                                               ("etag", tag), ("last-modified", day), ("date", at.cast("string")))),
        record(1, F.lit("revisit"), other, at + DAY, again),
        record(2, F.when(n % 5 == 0, "response").otherwise("revisit"), front, at + 30,
               headers(("etag", version), ("date", (at + 30).cast("string")))),
        record(3, F.when(n % 7 == 0, "revisit"), F.col("url"), at - 10, headers(("etag", tag))))
    return pages.select(F.explode(F.filter(made, lambda r: r["warc_type"].isNotNull())).alias("r")).select("r.*")
