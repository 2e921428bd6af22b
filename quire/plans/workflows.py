"""End-to-end workflows: the command-line jobs of the replaced tools, as
functions composed from the operators (files in, parquet tables and CSV
reports out). Everything stays distributed; only the small summary rows the
caller asks for are returned as DataFrames.

================  ==========================================================
index_collection  '/'-delimited collection -> index (create/append)
search_eval       queries + judgements files -> runs, metrics, reports
train_test        tune lambda or mu on a query range, report on another
compare           two per-query result CSVs -> t or Wilcoxon test
index_files       directory tree -> index with file metadata (sub-folder units)
top_terms_report  tf-idf top terms for a document id range -> CSV
remove_duplicates exact-content dedup of an index into a new index
search_pages      BM25 search of a field with paging (the demo searcher)
================  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.evaluation import eval_report, metrics, ranked_list
from quire.operators.hygiene import kept_ids, top_terms
from quire.operators.index import (Index, delete_docs, index_from_postings, index_stats,
                                   open_index, write_index)
from quire.operators.ranking import hits_with_fields, page, rank, select_queries
from quire.operators.significance import checked_pairs, t_test, wilcoxon_test
from quire.operators.tuning import GRIDS, best_param, test_report, training_metrics, tuning_matrix
from quire.operators.tuning import test_metrics
from quire.session import materialize
from quire.sources.collection import ordered_ids, read_collection, read_qrels, read_run_csv, read_stopwords, run_metric
from quire.sources.files import scan_files
from quire.sources.sinks import (write_eval_csv, write_report_csv, write_test_csv,
                                 write_training_csv)


def index_collection(spark: SparkSession, collection_path: str, index_path: str,
                     analyzer: str | None = None, mode: str = "create",
                     stop_words_path: str | None = None) -> DataFrame:
    """Parse a collection file and index it; returns the index statistics. The
    analyzer and the words of a stop-word file are kept with the index: appending
    and searching use them."""
    docs = read_collection(spark, collection_path)
    stops = read_stopwords(spark, stop_words_path) if stop_words_path else None
    idx = write_index(spark, docs, index_path, mode, analyzer, text_col="contents",
                      contents_stored=True, stop_words=stops)
    return index_stats(idx)


def search_eval(spark: SparkSession, index_path: str, queries_path: str, qrels_path: str,
                out_dir: str, analyzer: str | None = None, model: str = "jm",
                param: float | None = 0.5, cut: int = 10, top: int = 10,
                first_query: int | None = None, last_query: int | None = None, across_files: bool = False):
    """Rank the selected queries, evaluate at ``cut``; writes the ranked list
    (first ``top`` hits) and the per-query/average CSV. Returns (run, report)."""
    idx = open_index(spark, index_path, analyzer)
    queries = select_queries(read_collection(spark, queries_path, id_col="query_id",
                                             text_col="text"), first_query, last_query)
    qrels = read_qrels(spark, qrels_path, across_files)
    run = rank(idx, queries, model, param, cut)
    report = eval_report(metrics(run, qrels, queries), cut)
    write_report_csv(ranked_list(run, qrels, min(top, cut)), f"{out_dir}/ranked_list")
    write_eval_csv(report, f"{out_dir}/metrics")
    return run, report


def train_test(spark: SparkSession, index_path: str, queries_path: str, qrels_path: str,
               out_dir: str, model: str = "jm", train=(None, None), test=(None, None),
               metric: str = "P", cut: int = 10, analyzer: str | None = None, across_files: bool = False):
    """Tune on the training id range, report on the test range with the best
    value; writes the training matrix and the test CSV. Returns both tables."""
    idx = open_index(spark, index_path, analyzer)
    queries = read_collection(spark, queries_path, id_col="query_id", text_col="text")
    qrels = read_qrels(spark, qrels_path, across_files)
    tr = select_queries(queries, *train)
    te = select_queries(queries, *test)
    # written once: the matrix and the best value both read it
    tm = materialize(training_metrics(idx, tr, qrels, model, metric, cut), "training")
    matrix = tuning_matrix(tm, model)
    rep = test_report(test_metrics(idx, te, qrels, best_param(tm), model, metric, cut))
    write_training_csv(matrix, f"{out_dir}/training", f"{metric}@{cut}", GRIDS[model])
    write_test_csv(rep, f"{out_dir}/test", f"{metric}@{cut}")
    return matrix, rep


def compare(spark: SparkSession, run_a_path: str, run_b_path: str, test: str = "t",
            alpha: float = 0.05) -> DataFrame:
    """Paired significance test of two per-query result CSVs. Raises ValueError
    unless both name the same metric and cut and hold the same queries."""
    named = [run_metric(spark, p) for p in (run_a_path, run_b_path)]
    if None in named or named[0] != named[1]:
        raise ValueError(f"results of different metrics cannot be compared: {named[0]} / {named[1]}")
    runs = (read_run_csv(spark, run_a_path, run_id="a", metric=named[0])
            .unionByName(read_run_csv(spark, run_b_path, run_id="b", metric=named[1])))
    pairs = checked_pairs(runs, "a", "b")
    if test == "t":
        return t_test(pairs, alpha)
    if test == "wilcoxon":
        return wilcoxon_test(pairs, alpha)
    raise ValueError("test must be 't' or 'wilcoxon'")


def index_files(spark: SparkSession, root: str, index_path: str, by_subfolder: bool = True,
                max_depth: int = -1, only_ext=None, not_ext=None, prefer: str | None = None,
                content_lines: int = 0, contents_stored: bool = False, with_hash: bool = False) -> Index:
    """Index a directory tree: path, metadata and the list-form contents. Ids are
    1, 2, ... in path order. ``with_hash`` adds the Java string hash of the
    contents (a Python function over every text)."""
    files = scan_files(spark, root, by_subfolder, max_depth, only_ext, not_ext, prefer,
                       content_lines=content_lines, with_hash=with_hash)
    docs = ordered_ids(files, "path", "doc_id")
    stored = ("path", "rel_path", "subfolder", "size_kb", "modified_ms", "last_modified",
              "last_modified_sortable", *(["contents_hash"] if with_hash else []))
    return write_index(spark, docs, index_path, "create", "standard", text_col="contents",
                       stored=stored, contents_stored=contents_stored)


def top_terms_report(spark: SparkSession, index_path: str, out_path: str, n: int = 10,
                     first_doc: int | None = None, last_doc: int | None = None) -> DataFrame:
    idx = open_index(spark, index_path)
    rep = top_terms(idx, n, first_doc, last_doc)
    write_report_csv(rep, out_path)
    return rep


def remove_duplicates(spark: SparkSession, index_path: str, out_path: str,
                      text_col: str = "contents") -> DataFrame:
    """Copy an index without exact-content duplicates (the input stays
    untouched); returns documents and distinct terms before and after."""
    idx = open_index(spark, index_path)
    if text_col not in idx.docs.columns:
        raise ValueError("the index must store the contents to find duplicates")
    dropped = idx.docs.select("doc_id").join(kept_ids(idx.docs, text_col), "doc_id", "left_anti")
    postings, docs = delete_docs(idx, dropped)
    new = index_from_postings(spark, postings, docs, out_path, idx.analyzer, idx.stop_words)
    before = index_stats(idx).select(F.lit("before").alias("stage"), "n_docs", "n_terms")
    after = index_stats(new).select(F.lit("after").alias("stage"), "n_docs", "n_terms")
    return before.unionByName(after)


def search_pages(spark: SparkSession, index: Index, queries: DataFrame, page_no: int = 1,
                 page_size: int = 10, fields=("doc_id",)) -> DataFrame:
    """BM25 (the demo searcher's default) with paging and stored fields."""
    run = rank(index, queries, "bm25", None, page_no * page_size)
    return hits_with_fields(page(run, page_no, page_size), index.docs, [f for f in fields if f != "doc_id"])
