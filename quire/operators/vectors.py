"""Positional term vectors and phrase matching.

Term vectors are made inside the row of a document: tokens with their positions (and
offsets) are sorted and equal ones gathered there, so nothing is shuffled.

Two-word phrases are matched against a shingle index (analyzer ``shingle2``: adjacent
word pairs as terms). Phrases of any length are matched against the positions that an
index keeps with its postings: pieces of a phrase meet the runs of neighbouring words
that the positions show. No query reads a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.analysis import NOT_WORD, WORD, shingles, token_array
from quire.operators.index import Index, term_counts
from quire.operators.joins import join_small
from quire.session import materialize, ship_package


def term_vectors(docs: DataFrame, analyzer: str = "standard", text_col: str = "contents",
                 offsets: bool = False) -> DataFrame:
    """(doc_id, term, freq, positions[, start_offsets, end_offsets]):
    positions 0-based, ascending; offsets are character offsets into the
    original text (end exclusive), listed in position order. The lists of
    one (document, term) are bounded by the document's length."""
    if offsets:
        return _term_vectors_with_offsets(docs, text_col)
    rows = term_counts(docs, analyzer, "doc_id", text_col, positions=True)
    return rows.select("doc_id", "term", F.col("tf").alias("freq"), F.col("positions").cast("array<bigint>").alias("positions"))


def _term_vectors_with_offsets(docs: DataFrame, text_col: str) -> DataFrame:
    """Standard analyzer with offsets. Splitting the text on word runs gives
    the separators (one before every token, plus a trailing one); a token
    ends at the running sum of separator and token lengths up to it. The tokens of some
    documents at a time are then gathered by document and term (``gathered``)."""
    x = F.col(text_col)
    d = docs.select("doc_id", F.array_remove(F.split(x, NOT_WORD), "").alias("_t"), F.split(x, WORD).alias("_s"))
    # separators beyond the tokens' are the trailing one
    d = d.select("doc_id", F.transform("_t", lambda t: F.lower(t)).alias("_l"), F.transform("_t", lambda t: F.length(t)).alias("_w"),
                 F.zip_with("_t", F.slice("_s", 1, F.size("_t")), lambda t, s: F.length(t) + F.length(s)).alias("_n"))
    lists = [T.StructField(k, T.ArrayType(T.LongType())) for k in OFFSET_FIELDS]
    ship_package(docs.sparkSession)
    return d.mapInArrow(gathered, T.StructType([d.schema["doc_id"], T.StructField("term", T.StringType()),
                                                T.StructField("freq", T.LongType()), *lists]))


OFFSET_FIELDS = ("positions", "start_offsets", "end_offsets")
#: Documents whose tokens are gathered at once.
GATHERED = 500


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and term from rows of an id, lower-cased tokens, their lengths,
    and these with the separators before them."""
    for batch in batches:
        for at in range(0, batch.num_rows, GATHERED):
            ids, tokens, widths, steps = batch.slice(at, GATHERED).columns
            sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
            row, before = np.repeat(np.arange(len(ids)), sizes), np.repeat(np.cumsum(sizes) - sizes, sizes)
            if not len(row):
                continue
            every = np.concatenate([[0], np.cumsum(steps.flatten().to_numpy(), dtype=np.int64)])
            ends = every[1:] - every[before]
            coded = tokens.flatten().dictionary_encode()
            code = coded.indices.to_numpy()
            key = row * len(coded.dictionary) + code
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            cuts = pa.array(np.append(first, len(order)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(v[order], pa.int64()))
                     for v in (np.arange(len(row)) - before, ends - widths.flatten().to_numpy(), ends)]
            one = order[first]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row[one])), coded.dictionary.take(pa.array(code[one])),
                 pa.array(np.diff(cuts.to_numpy()), pa.int64()), *lists], ["doc_id", "term", "freq", *OFFSET_FIELDS])


def phrase_matches(pair_postings: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id, n_phrases): how many of the query's distinct adjacent
    word pairs occur as adjacent words in the document (documents with none
    are not returned). ``pair_postings`` is the postings table of a ``shingle2``
    index (doc_id, term, ...)."""
    qb = (queries.select("query_id", token_array(F.lower("text"), "shingle2").alias("_w"))
          .select("query_id", F.array_distinct(shingles(F.col("_w"))).alias("_t"))
          .select("query_id", F.explode_outer("_t").alias("term"))
          .filter(F.col("term").isNotNull()))
    return (join_small(pair_postings.select("doc_id", "term"), qb, "term").groupBy("query_id", "doc_id")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_phrases")))


#: Words of a piece of a phrase.
PIECE = 4


def phrase_places(index: Index, phrases: DataFrame, analyzer: str | None = None) -> DataFrame:
    """R15 for phrases of any length: (phrase_id, doc_id, n_places), how often each
    phrase (phrase_id, text) occurs as consecutive words of a document of an index with
    positions.

    Phrases are cut into pieces of PIECE words, the last one ending with the phrase. The
    words of phrases in a document, put in order by their positions, give its runs of
    neighbours of the same lengths; these meet the pieces by equality, so that the rows are
    at most the document's places for each length, however many phrases share a frequent
    word. A place that all pieces of a phrase name is an occurrence."""
    if not index.positions:
        raise ValueError("phrases need an index with positions")
    words = phrases.select("phrase_id", token_array(F.lower("text"), analyzer or index.analyzer).alias("_w")) \
        .filter(F.size("_w") > 0).select("phrase_id", "_w", F.size("_w").alias("need"))
    postings = index.postings.select("doc_id", "term", "positions")
    one = words.filter(F.col("need") == 1).select("phrase_id", F.col("_w")[0].alias("term"))
    single = join_small(postings, one, "term").select("phrase_id", "doc_id", F.size("positions").cast("bigint").alias("n_places"))

    size = F.least(F.col("need"), F.lit(PIECE))
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0), F.floor((F.col("need") - 1) / PIECE).cast("int")),
                                          lambda i: F.least(i * PIECE, F.col("need") - size)))
    pieces = words.filter(F.col("need") > 1).select("phrase_id", F.size(starts).alias("_pieces"), F.explode(F.transform(
        starts, lambda at: F.struct(at.alias("offset"), F.slice("_w", at + 1, size).alias("piece")))).alias("_p")) \
        .select("phrase_id", "_pieces", "_p.*")
    pieces = materialize(pieces, "phrase-pieces")
    sizes = sorted(r[0] for r in pieces.select(F.size("piece")).distinct().collect())       # at most PIECE - 1 numbers
    asked = pieces.select(F.explode("piece").alias("term")).distinct()

    # (at, term) of the phrases' words of a document, by place
    own = join_small(postings, asked, "term", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("term", "positions")).alias("_t"))
    placed = F.flatten(F.transform("_t", lambda t: F.transform(t["positions"], lambda p: F.struct(p.alias("at"), t["term"].alias("term")))))
    own = own.select("doc_id", F.array_sort(placed).alias("_o"))

    def runs_of(k: int) -> Column:
        made = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_o") - k, F.lit(0))), lambda i: F.struct(
            F.get("_o", i)["at"].alias("at"), (F.get("_o", i + k - 1)["at"] - F.get("_o", i)["at"]).alias("wide"),
            F.transform(F.slice("_o", i + 1, k), lambda o: o["term"]).alias("piece")))
        return F.filter(made, lambda r: r["wide"] == k - 1)
    every = F.concat(*[runs_of(k) for k in sizes]) if sizes else F.array().cast("array<struct<at:int,wide:int,piece:array<string>>>")
    found = own.select("doc_id", F.explode_outer(every).alias("_r")).filter(F.col("_r").isNotNull()).select("doc_id", "_r.at", "_r.piece")
    votes = join_small(found, pieces, "piece").select("phrase_id", "_pieces", "doc_id", (F.col("at") - F.col("offset")).alias("place"))
    whole = (votes.groupBy("phrase_id", "_pieces", "doc_id", "place").agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") == F.col("_pieces")).groupBy("phrase_id", "doc_id").agg(F.count(F.lit(1)).alias("n_places")))
    return whole.unionByName(single)
