"""Registered queries: sources and sinks.

File-based sources read files that Spark first writes from the driver's
tables into the shared folder (collection files, judgement files, query
lines, a directory tree, a result CSV), so every check covers the whole
table, written and parsed back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators.index import index_stats, index_update, open_index, write_index
from quire.operators.tuning import test_report
from quire.operators.upsert import upsert
from quire.plans.indexes import corpus_index, corpus_tune
from quire.plans.registry import register
from quire.plans.sqlparts import INDEX_CTES, WORD, qrels_cte, tuning_sql
from quire.session import scratch_path
from quire.sources.collection import (read_collection, read_qrels, read_query_lines,
                                      read_run_csv, read_stopwords)
from quire.sources.files import filter_paths, java_list_lines, path_columns, scan_files, time_columns
from quire.sources.sinks import (write_collection, write_qrels, write_query_lines, write_tree,
                                 write_test_csv)
from quire.sources.tables import benchmark_queries, derived_qrels, documents, table
from quire.functions.analysis import token_array
from quire.operators.index import explode_terms


@register("read_collection", r"""
SELECT doc_id,
       array_to_string(list_filter(string_split(text, chr(10)),
                                   lambda l: NOT regexp_full_match(l, '[ \t]*')), ' ') || ' ' AS contents
FROM documents""")
def read_collection_q(spark, sf_dir):
    """Documents written as a '/'-delimited collection file and parsed
    back (blank lines dropped, line ends become spaces)."""
    path = write_collection(documents(spark, sf_dir), scratch_path(spark, "collection"))
    return read_collection(spark, path)


@register("read_qrels", f"""
WITH {INDEX_CTES},
{qrels_cte(0.4)}
SELECT query_id, doc_id FROM qrels""")
def read_qrels_q(spark, sf_dir):
    """The derived judgements written as judgement files, whose records may go on in
    the next one, and parsed back."""
    q = benchmark_queries(spark, sf_dir)
    qrels = derived_qrels(q, corpus_index(spark, sf_dir).postings)
    return read_qrels(spark, write_qrels(qrels, scratch_path(spark, "qrels")), across_files=True)


@register("read_query_lines", r"""
SELECT row_number() OVER (ORDER BY item_id)::BIGINT AS query_id,
       trim(regexp_replace(text, '[\r\n]+', ' ', 'g')) AS text
FROM benchmark""")
def read_query_lines_q(spark, sf_dir):
    """The passages written one per line and read back (line number = id)."""
    path = write_query_lines(benchmark_queries(spark, sf_dir), scratch_path(spark, "querylines"))
    return read_query_lines(spark, path)


_COMMON_SQL = f"""
WITH {INDEX_CTES},
stops AS (SELECT term FROM tstat, corp WHERE tstat.df * 2 >= corp.n_docs),
v AS (SELECT unnest(regexp_extract_all(lower(text), '{WORD}')) AS term FROM documents)
SELECT term, count(*)::BIGINT AS cf FROM v WHERE term NOT IN (SELECT term FROM stops)
GROUP BY term"""


@register("tok_stop_file", _COMMON_SQL)
def tok_stop_file(spark, sf_dir):
    """A stop-word file (terms in at least half of the documents),
    written, read back and removed with a size-checked broadcast anti join."""
    idx = corpus_index(spark, sf_dir)
    n = idx.corpus.select("n_docs").scalar()
    stops = idx.terms.filter(F.col("df") * 2 >= n).select("term")
    path = scratch_path(spark, "stopwords")
    stops.write.mode("overwrite").text(path)
    words = read_stopwords(spark, path)
    d = documents(spark, sf_dir).select("doc_id", token_array("contents", "standard").alias("_toks"))
    toks = explode_terms(d, [])
    from quire.functions.analysis import remove_stop_words
    return (remove_stop_words(toks, words).groupBy("term")
            .agg(F.count(F.lit(1)).cast("bigint").alias("cf")))


@register("read_run_csv", tuning_sql("jm", "P", """
SELECT 'jm.test.csv' AS run_id, 'P@10' AS metric, query_id, value FROM test"""))
def read_run_csv_q(spark, sf_dir):
    """The tuned test report written in the per-query CSV layout and
    read back (header, value= and avg lines skipped)."""
    _, _, test_m = corpus_tune(spark, sf_dir, ("jm",), "P", 10)
    rep = test_report(test_m.select("query_id", "value", "best_param"))
    path = write_test_csv(rep, scratch_path(spark, "testcsv"), "P@10")
    return read_run_csv(spark, path, run_id="jm.test.csv")


_TREE_SQL = """
SELECT 'source=' || source AS subfolder, count(*)::BIGINT AS n_files,
       sum(strlen(text) + 1)::BIGINT AS n_bytes, max(1)::BIGINT AS max_depth
FROM documents GROUP BY source"""


def _tree(spark, sf_dir):
    return write_tree(documents(spark, sf_dir), scratch_path(spark, "tree"))


@register("scan_files", _TREE_SQL)
def scan_files_q(spark, sf_dir):
    """Documents written as a directory tree (one file each) and
    scanned back recursively with file metadata."""
    f = scan_files(spark, _tree(spark, sf_dir), only_ext=["txt"])
    return f.groupBy("subfolder").agg(F.count(F.lit(1)).cast("bigint").alias("n_files"),
                                      F.sum("size").cast("bigint").alias("n_bytes"),
                                      F.max(F.col("depth") - 1).cast("bigint").alias("max_depth"))


@register("scan_by_folder", _TREE_SQL)
def scan_by_folder_q(spark, sf_dir):
    """Sub-folders as units of work, depth counted from the sub-folder."""
    f = scan_files(spark, _tree(spark, sf_dir), by_subfolder=True, max_depth=1)
    return f.groupBy("subfolder").agg(F.count(F.lit(1)).cast("bigint").alias("n_files"),
                                      F.sum("size").cast("bigint").alias("n_bytes"),
                                      F.max(F.col("depth") - 1).cast("bigint").alias("max_depth"))


@register("provenance")
def provenance_q(spark, sf_dir):
    """Which task read each file (host names are not exposed by Spark)."""
    f = scan_files(spark, _tree(spark, sf_dir), contents_stored=False)
    return f.select("rel_path", "partition", "size_kb", "modified_ms", "last_modified",
                    "last_modified_sortable")


@register("provenance_counts", """
SELECT 'source=' || source AS subfolder, count(*)::BIGINT AS n_files, count(*)::BIGINT AS n_with_task, true AS one_task_each
FROM documents GROUP BY source""")
def provenance_counts_q(spark, sf_dir):
    """Every file of the tree names the task that read it, and one task only."""
    f = scan_files(spark, _tree(spark, sf_dir), contents_stored=False)
    per_file = f.groupBy("subfolder", "rel_path").agg(F.count("partition").alias("n"), F.countDistinct("partition").alias("tasks"))
    return per_file.groupBy("subfolder").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).cast("bigint").alias("n_with_task"),
        (F.max("tasks") == 1).alias("one_task_each"))


# URL paths of `pages` as relative file paths (scheme, host, query, fragment dropped)
_URL_PATH_SQL = r"""
WITH u AS (SELECT page_id, regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '^/', '') AS rel_path FROM pages),
pc AS (SELECT page_id, rel_path, string_split(rel_path, '/') AS seg FROM u),
p AS (SELECT page_id, rel_path, seg[len(seg)] AS file_name,
             regexp_extract(seg[len(seg)], '\.([^.]*)$', 1) AS ext,
             len(seg)::BIGINT AS depth,
             CASE WHEN len(seg) > 1 THEN seg[1] END AS subfolder FROM pc)"""


def _url_paths(spark, sf_dir):
    u = table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_replace(F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), "^/", "")
        .alias("rel_path"))
    return path_columns(u)


@register("filter_ext_in", _URL_PATH_SQL + "\nSELECT page_id, rel_path, ext FROM p WHERE ext IN ('html')")
def filter_ext_in(spark, sf_dir):
    """Keep paths whose last extension is listed (case-sensitive)."""
    return filter_paths(_url_paths(spark, sf_dir), only_ext=["html"]).select("page_id", "rel_path", "ext")


@register("filter_ext_not_in", _URL_PATH_SQL + "\nSELECT page_id, rel_path, ext FROM p WHERE ext NOT IN ('html')")
def filter_ext_not_in(spark, sf_dir):
    """Drop paths whose last extension is listed."""
    return filter_paths(_url_paths(spark, sf_dir), not_ext=["html"]).select("page_id", "rel_path", "ext")


@register("filter_ext_both", _URL_PATH_SQL + """
SELECT 'only' AS prefer, page_id, rel_path, ext FROM p WHERE ext IN ('html', 'php')
UNION ALL SELECT 'not', page_id, rel_path, ext FROM p WHERE ext NOT IN ('html', 'txt')""")
def filter_ext_both(spark, sf_dir):
    """Both extension lists given; the explicit choice says which one applies."""
    both = [filter_paths(_url_paths(spark, sf_dir), only_ext=["html", "php"], not_ext=["html", "txt"], prefer=which)
            .select(F.lit(which).alias("prefer"), "page_id", "rel_path", "ext") for which in ("only", "not")]
    return both[0].unionByName(both[1])


@register("scan_depth", _URL_PATH_SQL + """
SELECT subfolder, count(*)::BIGINT AS n FROM p WHERE subfolder IS NOT NULL AND depth - 1 <= 1
GROUP BY subfolder""")
def scan_depth(spark, sf_dir):
    """S2/S3 on URL paths: language folders as units, at most one level deep."""
    f = filter_paths(_url_paths(spark, sf_dir), by_subfolder=True, max_depth=1)
    return f.groupBy("subfolder").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("first_n_lines", r"""
SELECT doc_id,
  '[' || array_to_string(list_slice(string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''),
                                                        '\r\n|\r|\n'), 1, 2), ', ') || ']' AS contents
FROM documents""")
def first_n_lines(spark, sf_dir):
    """The first two lines in the stored list form ``[l1, l2]``."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", java_list_lines(F.col("contents"), 2).alias("contents"))


@register("time_format", """
SELECT event_id, (epoch_us(ts) // 1000)::BIGINT AS modified_ms,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_modified,
       strftime(ts, '%Y%m%d%H%M%S%g') AS last_modified_sortable
FROM events""")
def time_format(spark, sf_dir):
    """Epoch milliseconds and the two timestamp string formats."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", *time_columns(F.col("ts")))


@register("modified_range", """
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' AND ts < TIMESTAMP '2024-01-05 00:00:00'""")
def modified_range(spark, sf_dir):
    """A range filter on a time column, pushed into the parquet scan."""
    e = table(spark, sf_dir, "events")
    return e.filter((F.col("ts") >= F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
                    & (F.col("ts") < F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
                    ).select("event_id", "ts")


@register("semi_lookup", """
SELECT doc_id, source FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def semi_lookup(spark, sf_dir):
    """Exact-key lookup as a semi join."""
    keys = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")
    return documents(spark, sf_dir).join(keys, "doc_id", "left_semi").select("doc_id", "source")


_UPSERT_SQL = """
WITH upd AS (
  SELECT conv_id AS doc_id, arg_max(text, turn) AS contents FROM conversations GROUP BY conv_id),
old AS (SELECT doc_id, text AS contents FROM documents)
SELECT doc_id, length(contents)::BIGINT AS n_chars, 'old' AS origin FROM old
WHERE doc_id NOT IN (SELECT doc_id FROM upd)
UNION ALL
SELECT doc_id, length(contents)::BIGINT, 'new' FROM upd"""


@register("upsert_docs", _UPSERT_SQL)
def upsert_docs(spark, sf_dir):
    """K2: conversations as updates keyed by id (latest turn wins) replace
    documents with the same id; other documents are kept."""
    old = documents(spark, sf_dir).select("doc_id", "contents").withColumn("origin", F.lit("old"))
    conv = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("text").alias("contents"), "turn",
        F.lit("new").alias("origin"))
    out = upsert(old, conv, "doc_id", order_col="turn")
    return out.select("doc_id", F.length("contents").cast("bigint").alias("n_chars"), "origin")


@register("write_index", f"""
WITH {INDEX_CTES}
SELECT c.n_docs, c.n_docs_nonempty, c.n_tokens, (SELECT count(*) FROM tstat)::BIGINT AS n_terms
FROM corp c""")
def write_index_q(spark, sf_dir):
    """K1/K4: create an index from the English documents, append the others;
    the statistics of the appended index equal those of one build."""
    d = documents(spark, sf_dir)
    path = scratch_path(spark, "index-append")
    write_index(spark, d.filter(F.col("lang") == "en"), path, "create")
    idx = write_index(spark, d.filter((F.col("lang") != "en") | F.col("lang").isNull()), path,
                      "append")
    return index_stats(idx)


@register("write_index_again", f"""
WITH {INDEX_CTES}
SELECT c.n_docs, c.n_docs_nonempty, c.n_tokens, (SELECT count(*) FROM tstat)::BIGINT AS n_terms
FROM corp c""")
def write_index_again_q(spark, sf_dir):
    """K1: create, append, create on one path; the last create alone is in force."""
    d = documents(spark, sf_dir)
    path = scratch_path(spark, "index-again")
    write_index(spark, d.filter(F.col("lang") == "en"), path, "create")
    write_index(spark, d.filter(F.col("lang") == "fr"), path, "append")
    return index_stats(write_index(spark, d, path, "create"))


_NEW_TEXT = "(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' updated' ELSE text END AS text FROM documents)"


@register("index_update", f"""
WITH {INDEX_CTES.replace("FROM documents),", "FROM " + _NEW_TEXT + "),", 1)}
SELECT term, df::BIGINT AS df, cf::BIGINT AS cf FROM tstat""")
def index_update_q(spark, sf_dir):
    """K2: an index brought up to date by key, with the whole text of every document in the
    update; its term statistics are those of a rebuild. The id rule only chooses which documents change; half of them are new to the index, the
    others replace postings that would count twice if they stayed."""
    d = documents(spark, sf_dir)
    path = scratch_path(spark, "index-update")
    third = F.col("doc_id") % 3 == 0
    write_index(spark, d.filter(~third | (F.col("doc_id") % 2 == 0)), path, "create")
    new = d.filter(third).withColumn("contents", F.concat("contents", F.lit(" updated")))
    return index_update(spark, new, path).terms.select("term", "df", "cf")


@register("stored_contents", """
SELECT doc_id, text AS contents, lang, source FROM documents""")
def stored_contents_q(spark, sf_dir):
    """A10: contents and fields kept in the index, read back from an opened one."""
    path = scratch_path(spark, "index-stored")
    write_index(spark, documents(spark, sf_dir), path, stored=("lang", "source"), contents_stored=True)
    return open_index(spark, path).docs.select("doc_id", "contents", "lang", "source")


@register("upsert_stream", """
WITH upd AS (
  SELECT conv_id AS doc_id, arg_max(text, turn) AS contents FROM conversations GROUP BY conv_id),
old AS (SELECT doc_id, text AS contents FROM documents)
SELECT doc_id, length(contents)::BIGINT AS n_chars, 'old' AS origin FROM old
WHERE doc_id NOT IN (SELECT doc_id FROM upd)
UNION ALL
SELECT doc_id, length(contents)::BIGINT, 'new' FROM upd""")
def upsert_stream_q(spark, sf_dir):
    """K3: documents, then every conversation turn, arrive as files; a file
    stream (availableNow, a few files per micro-batch) upserts them into a table
    bucket by bucket -- the newest turn per id wins whatever the batch order."""
    from quire.streaming.upsert_stream import upsert_stream
    src = scratch_path(spark, "stream-src")
    docs = documents(spark, sf_dir).select(
        "doc_id", "contents", F.lit(-1).cast("bigint").alias("turn"), F.lit("old").alias("origin"))
    conv = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("text").alias("contents"),
        F.col("turn").cast("bigint").alias("turn"), F.lit("new").alias("origin"))
    docs.write.mode("append").parquet(src)
    conv.write.mode("append").parquet(src)
    t = upsert_stream(spark, src, docs.schema, scratch_path(spark, "stream-table"),
                      scratch_path(spark, "stream-ckpt"), key="doc_id", order_col="turn",
                      max_files_per_batch=2, buckets=8)
    return t.select("doc_id", F.length("contents").cast("bigint").alias("n_chars"), "origin")
