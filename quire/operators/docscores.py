"""Documents against a batch of queries, a few documents at a time.

A query of frequent words matches nearly every document, so that joining postings with the
terms of all queries makes far more rows than there are postings. Here a posting meets the
distinct terms of the queries once; the postings of a document come together in one row
(no exchange on a table bucketed by document), and a task multiplies some documents' weights
with the table of query terms. What leaves the task is only what the caller keeps.

The table of query terms goes to the tasks whole, so it is bounded (``query_table``);
beyond the bound the callers join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.joins import fits_broadcast, max_broadcast_rows
from quire.session import ship_package

#: (query, term) rows, and cells of the queries x terms table, that are sent to the tasks.
MAX_QUERY_ROWS, MAX_QUERY_CELLS = 500_000, 8_000_000
#: Documents that are multiplied at once, and scores that a task holds.
DOCS_AT_ONCE, SCORES_AT_ONCE = 32, 2_000_000


class QueryTable:
    """Queries, their distinct terms, and how often which query has which term."""

    def __init__(self, rows: pa.Table):
        self.id_type = rows.schema.field("query_id").type
        ids, terms = rows["query_id"].combine_chunks(), rows["term"].combine_chunks().dictionary_encode()
        ids = ids.dictionary_encode(null_encoding="encode")
        self.ids, self.terms = ids.dictionary, terms.dictionary.to_pylist()
        self.query, self.term = ids.indices.to_numpy(), terms.indices.to_numpy()
        self.times = rows["qtf"].to_numpy()

    def counts(self) -> np.ndarray:
        """terms x queries; rows of one query and term add up."""
        out = np.zeros((len(self.terms), len(self.ids)))
        np.add.at(out, (self.term, self.query), self.times)
        return out


def query_table(qterms: DataFrame) -> QueryTable | None:
    """The rows (query_id, term, qtf) of a query batch, None if there are too many to send."""
    if not fits_broadcast(qterms, min(MAX_QUERY_ROWS, max_broadcast_rows(qterms))):
        return None
    table = QueryTable(qterms.select("query_id", "term", "qtf").toArrow())
    return table if len(table.terms) * len(table.ids) <= MAX_QUERY_CELLS else None


def numbered_terms(like: DataFrame, table: QueryTable) -> DataFrame:
    """(term, _t): the terms of a query table and their rows in it."""
    return like.sparkSession.createDataFrame(pa.table({"term": pa.array(table.terms, pa.string()),
                                                       "_t": pa.array(range(len(table.terms)), pa.int32())}))


def by_document(feats: DataFrame, weights: list[Column]) -> DataFrame:
    """(doc_id, _p): per document its postings as structs of ``_t`` and the weights, the
    last of them 1, so that their sum tells a match from a score of 0."""
    fields = [w.cast("double").alias(f"_w{i}") for i, w in enumerate([*weights, F.lit(1.0)])]
    return feats.select("doc_id", F.struct("_t", *fields).alias("_p")).groupBy("doc_id").agg(F.collect_list("_p").alias("_p"))


def blocks(batches: Iterator[pa.RecordBatch], counts: np.ndarray, n_weights: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, sums, matches) of a few documents at a time, by rising id: sums are weights x
    documents x queries, matches documents x queries."""
    n_queries = counts.shape[1]
    at_once = max(1, SCORES_AT_ONCE // (n_queries * (n_weights + 1)))
    for batch in batches:
        order = pc.sort_indices(batch.column(0), null_placement="at_start")
        ids, lists = batch.column(0).take(order), batch.column(1).take(order)
        flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        terms = flat.field("_t").to_numpy()
        values = [flat.field(f"_w{i}").to_numpy(zero_copy_only=False) for i in range(n_weights + 1)]
        for lo in range(0, len(ids), at_once):
            hi = min(lo + at_once, len(ids))
            sums = np.empty((n_weights + 1, hi - lo, n_queries))
            for a in range(lo, hi, DOCS_AT_ONCE):
                b = min(a + DOCS_AT_ONCE, hi)
                span = slice(ends[a], ends[b])
                used, col = np.unique(terms[span], return_inverse=True)
                cell = np.repeat(np.arange(b - a), np.diff(ends[a:b + 1])) * len(used) + col
                dense = np.concatenate([np.bincount(cell, v[span], (b - a) * len(used)) for v in values])
                some = dense.reshape(-1, len(used)) @ counts[used]
                sums[:, a - lo:b - lo] = some.reshape(n_weights + 1, b - a, n_queries)
            yield ids.slice(lo, hi - lo), sums[:-1], sums[-1]


def _each_block(rows: DataFrame, table: QueryTable, n_weights: int, schema: T.StructType,
                keep: Callable) -> DataFrame:
    """``keep(ids, sums, matches, seen)`` of every block; ``seen`` is the task's own dict."""
    ship_package(rows.sparkSession)
    def run(batches):
        counts, seen = table.counts(), {}
        for ids, sums, matches in blocks(batches, counts, n_weights):
            yield keep(ids, sums, matches, seen)
    return rows.mapInArrow(run, schema)


def _best(rank: np.ndarray, cut: int, seen: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(spec, doc, query) of the least ``cut`` ranks of a block (specs x documents x queries)
    for each spec and query, of equal ones the first documents; without infinite ones and
    those above the ``cut``-th of an earlier block."""
    bound = seen.get("bound", np.inf)
    if rank.shape[1] >= cut:
        bound = seen["bound"] = np.minimum(np.partition(rank, cut - 1, axis=1)[:, cut - 1:cut], bound)
    spec, doc, query = np.nonzero((rank <= bound) & (rank < np.inf))
    # of equal scores at the bound only the first documents
    group = spec * rank.shape[2] + query
    order = np.lexsort((doc, rank[spec, doc, query], group))
    spec, doc, query, group = spec[order], doc[order], query[order], group[order]
    first = np.arange(len(group)) - np.searchsorted(group, group) < cut
    return spec[first], doc[first], query[first]


def best_scores(feats: DataFrame, table: QueryTable, id_type: T.DataType, weights: list[Column], cut: int,
                decimals: int) -> DataFrame:
    """(spec, query_id, doc_id, score): rounded sums per weight, of which the best ``cut`` of
    a query are all there (higher score first, then smaller id), few others are. A task
    gives the best of each block, without those below the ``cut``-th of an earlier block."""
    rows = by_document(feats, weights)
    schema = T.StructType([T.StructField("spec", T.IntegerType()), T.StructField("query_id", id_type),
                           T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])
    m = float(10 ** decimals)

    def keep(ids, sums, matches, seen):
        scores = np.sign(sums) * np.floor(np.abs(sums) * m + 0.5) / m
        # last what does not match; a null score before it
        rank = np.where(matches > 0, -np.where(np.isnan(scores), -1e300, scores), np.inf)
        spec, doc, query = _best(rank, cut, seen)
        return pa.RecordBatch.from_arrays(
            [pa.array(spec.astype(np.int32)), table.ids.take(pa.array(query)), ids.take(pa.array(doc)),
             pa.array(scores[spec, doc, query], from_pandas=True)], ["spec", "query_id", "doc_id", "score"])
    return _each_block(rows, table, len(weights), schema, keep)


def shared_terms(postings: DataFrame, table: QueryTable, id_type: T.DataType, min_share: float) -> DataFrame:
    """(query_id, doc_id): documents with at least a share of a query's terms, and one."""
    rows = by_document(postings.select("doc_id", "term").join(F.broadcast(numbered_terms(postings, table)), "term"), [])
    schema = T.StructType([T.StructField("query_id", id_type), T.StructField("doc_id", rows.schema["doc_id"].dataType)])

    def keep(ids, sums, matches, seen):
        if "need" not in seen:
            seen["need"] = min_share * np.bincount(table.query, table.times, len(table.ids))
        doc, query = np.nonzero((matches > 0) & (matches >= seen["need"]))
        return pa.RecordBatch.from_arrays([table.ids.take(pa.array(query)), ids.take(pa.array(doc))], ["query_id", "doc_id"])
    return _each_block(rows, table, 0, schema, keep)


def mask_blocks(batches: Iterator[pa.RecordBatch], words: int, at_once: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, masks) of a few documents at a time, by rising id: masks are documents x words.
    A word that a document has several times is united."""
    for batch in batches:
        order = pc.sort_indices(batch.column(0), null_placement="at_start")
        ids, lists = batch.column(0).take(order), batch.column(1).take(order)
        flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        word, mask = flat.field("_word").to_numpy(), flat.field("_mask").to_numpy().view(np.uint64)
        for lo in range(0, len(ids), at_once):
            hi = min(lo + at_once, len(ids))
            span, masks = slice(ends[lo], ends[hi]), np.zeros((hi - lo, words), np.uint64)
            np.bitwise_or.at(masks, (np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1])), word[span]), mask[span])
            yield ids.slice(lo, hi - lo), masks


def most_bits(hits: DataFrame, wants: pa.Table, id_type: T.DataType, cut: int) -> DataFrame:
    """(query_id, doc_id, score): how many bits of a query's masks (rows query_id, _word,
    _want) a document's (rows doc_id, _word, _mask) share, where any; the best ``cut`` of a
    query are all there (more bits first, then smaller id), few others are."""
    rows = hits.groupBy("doc_id").agg(F.collect_list(F.struct("_word", "_mask")).alias("_p"))
    schema = T.StructType([T.StructField("query_id", id_type), T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           T.StructField("score", T.DoubleType())])
    coded = wants["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    ids, query, word = coded.dictionary, coded.indices.to_numpy(), wants["_word"].to_numpy()
    want, words = wants["_want"].to_numpy().view(np.uint64), int(word.max(initial=-1)) + 1
    order = np.argsort(word, kind="stable")
    of_word = np.split(order, np.searchsorted(word[order], np.arange(1, words)))
    at_once = max(1, SCORES_AT_ONCE // max(1, len(ids), words))
    ship_package(rows.sparkSession)

    def run(batches):
        seen = {}
        for docs, masks in mask_blocks(batches, words, at_once):
            bits = np.zeros((len(docs), len(ids)), np.int32)
            for w, some in enumerate(of_word):
                bits[:, query[some]] += np.bitwise_count(masks[:, w, None] & want[some])
            _, doc, asker = _best(np.where(bits > 0, -bits.astype(np.float64), np.inf)[None], cut, seen)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(asker)), docs.take(pa.array(doc)), pa.array(bits[doc, asker].astype(np.float64))],
                                             ["query_id", "doc_id", "score"])
    return rows.mapInArrow(run, schema)
