"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (annperm, fim, langid, licenses, mixing, packing, pii, quality, revisits, secrets, simhash, tokenfiles,
                       whitening)
from quire.llm.common import table
from quire.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


_OP1 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, (1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)::BIGINT AS weight,
         3 * source_size AS cap
  FROM sources),
ratios AS (SELECT *, cap::DOUBLE / weight AS ratio FROM weighted),
leveled AS (
  SELECT *, (sum(source_size) OVER () - sum(cap) OVER upto + cap)::BIGINT::DOUBLE
            / (sum(weight) OVER () - sum(weight) OVER upto + weight)::BIGINT::DOUBLE AS own_level
  FROM ratios
  WINDOW upto AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
targets AS (
  SELECT source, source_size,
         least(cap::DOUBLE, max(CASE WHEN own_level <= ratio THEN own_level END) OVER () * weight) AS target
  FROM leveled),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(3.0::DOUBLE, t.target / t.source_size::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix:20:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""


@register("op1_mixing", _OP1)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to target weights; words taken of each document."""
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select("_row.doc_id", "size", "source_size", "target",
                          (F.col("copies") * F.col("size")).alias("taken"))


@register("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


_OP3 = r"""
WITH p AS (
  SELECT page_id AS n, page_id * 60 AS t, url,
         '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag,
         'day ' || (floor(page_id * 60 / 86400.0)::BIGINT)::VARCHAR AS day,
         length(coalesce(html, ''))::VARCHAR AS len
  FROM pages),
r AS (
  SELECT n * 4 AS record_id, 'response' AS kind, url AS uri, t AS date, tag AS etag, day AS modified,
         'text/html' AS ctype, len AS clen, t::VARCHAR AS dated, NULL AS cache, NULL AS expires
  FROM p
  UNION ALL
  SELECT n * 4 + 1, 'revisit',
         CASE WHEN contains(url, '#') THEN url
              ELSE regexp_replace(url, '^https?:', 'HTTP:')
                   || CASE WHEN contains(url, '?') THEN '&utm_medium=again' ELSE '?utm_medium=again' END END,
         t + 86400, CASE n % 4 WHEN 0 THEN 'W/' || tag WHEN 2 THEN '"other"' END,
         CASE n % 4 WHEN 1 THEN day END, NULL, CASE n % 4 WHEN 1 THEN '0' END, (t + 86400)::VARCHAR,
         CASE n % 4 WHEN 0 THEN 'max-age=60' END, CASE n % 4 WHEN 1 THEN 'soon' END
  FROM p
  UNION ALL
  SELECT n * 4 + 2, CASE WHEN n % 5 = 0 THEN 'response' ELSE 'revisit' END,
         regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*', 0) || '/', t + 30,
         '"v' || (floor(n / 20.0)::BIGINT)::VARCHAR || '"', NULL, NULL, NULL, (t + 30)::VARCHAR, NULL, NULL
  FROM p
  UNION ALL
  SELECT n * 4 + 3, 'revisit', url, t - 10, tag, NULL, NULL, NULL, NULL, NULL, NULL FROM p WHERE n % 7 = 0),
c AS (
  SELECT r.*, regexp_replace(regexp_replace(lower(regexp_extract(trim(uri), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)', 1)),
                  '^www[0-9]*\.', ''), ':(80|443)$', '')
           || regexp_replace(regexp_extract(trim(uri), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)', 1), '/+$', '') AS head,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(trim(uri), '^[^?#]*\?([^#]*)', 1), '&'),
             lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|phpsessid|jsessionid|sessionid|sid)='))), '&') AS query
  FROM r),
u AS (SELECT *, head || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS curl FROM c),
w AS (
  SELECT *, last_value(CASE WHEN kind = 'response' THEN
           {'id': record_id, 'etag': etag, 'modified': modified, 'ctype': ctype, 'clen': clen, 'dated': dated} END IGNORE NULLS)
         OVER (PARTITION BY curl ORDER BY date, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s
  FROM u),
o AS (
  SELECT *, CASE WHEN s IS NULL THEN 'no_response'
                 WHEN etag IS NOT NULL AND s.etag IS NOT NULL THEN
                   CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(s.etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
                 WHEN modified IS NOT NULL AND s.modified IS NOT NULL THEN
                   CASE WHEN modified = s.modified THEN 'resolved' ELSE 'mismatch' END
                 ELSE 'no_validator' END AS outcome
  FROM w WHERE kind = 'revisit')
SELECT record_id, curl AS url, date AS warc_date, outcome,
       CASE WHEN outcome = 'resolved' THEN s.id END AS response_id,
       CASE WHEN outcome = 'resolved' THEN coalesce(etag, s.etag) ELSE etag END AS etag,
       CASE WHEN outcome = 'resolved' THEN coalesce(modified, s.modified) ELSE modified END AS last_modified,
       CASE WHEN outcome = 'resolved' THEN s.ctype ELSE ctype END AS content_type,
       CASE WHEN outcome = 'resolved' THEN s.clen ELSE clen END AS content_length,
       CASE WHEN outcome = 'resolved' THEN coalesce(dated, s.dated) ELSE dated END AS date,
       cache AS cache_control, expires
FROM o
"""


@register("op3_revisits", _OP3)
def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits among the captures of all pages, resolved to their responses."""
    found = revisits.resolve(revisits.captures(table(spark, sf_dir, "pages")))
    return found.select("record_id", "url", "warc_date", "outcome", "response_id",
                        *[F.col("headers")[k].alias(k.replace("-", "_")) for k in
                          ("etag", "last-modified", "content-type", "content-length", "date", "cache-control", "expires")])


@register("op4_langid")
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


@register("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 1024 ids."""
    placed = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), size=1024)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op6_permutation")
def op6_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest of every vector whose id is divisible by 20."""
    return annperm.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, votes, posterior quality and verdict of every document."""
    scored = quality.score(table(spark, sf_dir, "documents"), F.col("text"), ["doc_id"])
    return scored.select("doc_id", *quality.BASE, "base_failed", "kept", "quality")


@register("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"), F.col("text"), ["doc_id"])
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secrets.written(F.col("base_spans")), 256).alias("base_sha256"),
                        secrets.written(F.col("all_spans")).alias("spans"))


@register("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.scan(table(spark, sf_dir, "documents"), F.col("text"), ["doc_id"])
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")


@register("op10_tokenfiles")
def op10_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as token files and read back."""
    path = scratch_path(spark, "token-files")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), spaced=False)
    return tokenfiles.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", tokenfiles.ids_crc32("ids").alias("ids_crc32"))


@register("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors whitened on the first 16 components."""
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors, components=16)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    rows = whitening.components(whitening.whiten(vectors, model), model)
    return rows.select("_row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


@register("op12_licenses")
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("_row.doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


_OP13 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
c AS (
  SELECT doc_id, text, length(text)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
p AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@register("op13_fim", _OP13)
def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed, and restored from what came out."""
    made = fim.restore(fim.fill_in_middle(table(spark, sf_dir, "documents"), seed=1, cut=90, suffix_first=20))
    return made.select("_row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))
