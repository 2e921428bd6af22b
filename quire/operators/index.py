"""Inverted index as parquet tables.

Tables (all keyed by plain columns, no engine-specific storage):

=========  ==============================================================
postings   doc_id, term, tf, dl[, positions], part -- dl (document length) is
                                     carried on every posting so scoring needs
                                     one large scan and only small joins
doclen     doc_id, dl             -- documents with at least one term
terms      term, df, cf           -- collection statistics
corpus     one row: n_docs, n_docs_nonempty, n_tokens, avgdl, a mergeable
           sketch of the distinct terms, and how the index was made
           (analyzer, stop_words, positions, buckets, parts, columns)
docs       doc_id + stored fields (contents optional), part
=========  ==============================================================

``postings`` is one table, partitioned by ``part`` (a hash of the document id) and
bucketed by ``doc_id``. Creating overwrites it, appending inserts into it, updating
rewrites the partitions that hold a changed document (``INSERT OVERWRITE`` of these
partitions alone): the old rows without the changed ids, and the new ones. Statistics
are grouped from the table afterwards. A scan is partitioned by document, so what ranking
groups by (query, document) needs no exchange: only the best few rows per task and query
are shuffled.

Terms are counted beside the text that they come from, for some documents at a time in
Arrow batches (``counted``); with positions, and where a text is one term, by built-in
functions in its row. Texts stay where they are read; what is shuffled, once and into the
buckets, is one pair of arrays (terms and how often each) per document. A task of the shuffle
has one bucket and writes the files of its partitions side by side, without sorting postings.
Tokenisation happens once per build: statistics are derived from the written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.analysis import (remove_stop_words, runs, shingles, stemmed, stemmed_term,
                                      stemmer_for, token_array)
from quire.operators.joins import broadcast_if_small, join_small
from quire.session import files_side_by_side, materialize, overwriting_partitions, scratch_path, ship_package


@dataclass
class Index:
    postings: DataFrame
    doclen: DataFrame
    terms: DataFrame
    corpus: DataFrame
    docs: DataFrame
    analyzer: str
    path: str | None = None
    stop_words: DataFrame | None = None
    positions: bool = False
    sketch: DataFrame | None = None


# ---------------------------------------------------------------- analysis

def spread(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents of an input of fewer files than the cluster has cores, dealt by id first:
    what a file holds in one row group is read by one task, however long its texts. An input
    of more files stays as it is. (Counted in the JVM: the names do not come to Python.)"""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(buckets, "doc_id") if len(docs._jdf.inputFiles()) < cores else docs


def explode_terms(df: DataFrame, keep: list[str], arr_col: str = "_toks") -> DataFrame:
    """One row per token. ``explode_outer`` + a null filter instead of
    ``explode``: for ``explode`` the optimizer infers ``size(arr) > 0`` and
    pushes it below the projection, which inlines the tokeniser and runs the
    regular expression twice per text."""
    return (df.select(*keep, F.explode_outer(arr_col).alias("term"))
            .filter(F.col("term").isNotNull()))


def term_counts(df: DataFrame, analyzer: str = "standard", id_col: str = "doc_id",
                text_col: str = "contents", stop_words: DataFrame | None = None,
                stop_list: tuple[str, ...] | None = None, positions: bool = False,
                buckets: int | None = None, united: bool = True) -> DataFrame:
    """(id, term, tf, dl[, positions]): term frequencies of each text, its length and,
    if asked, where each term stands (from 0, rising).

    Counted row by row, so nothing is shuffled unless ``buckets`` asks for rows
    dealt by id: then the counted terms are, never the texts. Words are stemmed before
    they are counted; texts of one id and length are then counted together, unless
    ``united`` is false (for sums over all texts, which come out the same). Stop words of a
    table are joined after counting, one row per different term of a text, and stems made
    then; lengths without stop words are grouped by id."""
    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(buckets, id_col) if buckets else rows

    words = df.select(F.col(id_col), token_array(F.col(text_col), analyzer, stop_list).alias("_toks"))
    pairs, in_row = analyzer == "shingle2", positions or analyzer == "keyword"
    if pairs and in_row:
        words = words.select(id_col, shingles(F.col("_toks")).alias("_toks"))
    stem, late = stemmer_for(analyzer), stop_words is not None
    if stem and not late:
        words = words.select(id_col, stemmed(F.col("_toks"), analyzer).alias("_toks"))
    if in_row:
        rows, each = _counted(words, id_col, positions), F.col("_c")
    else:
        rows, each = _counted_together(words, id_col, pairs), F.arrays_zip(F.col("_c.term"), F.col("_c.tf"))
    rows = (rows if late else dealt(rows)).select(id_col, "dl", F.explode_outer(each).alias("_c")) \
        .filter(F.col("_c").isNotNull()).select(id_col, "dl", "_c.*")
    if late:
        rows = dealt(remove_stop_words(rows, stop_words))
        if stem:
            rows = rows.withColumn("term", stemmed_term(F.col("term"), analyzer))
    if stem and (late or united):
        where = [F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions")] if positions else []
        rows = rows.groupBy(id_col, "dl", "term").agg(F.sum("tf").alias("tf"), *where)
    if late:
        rows = rows.withColumn("dl", F.sum("tf").over(Window.partitionBy(id_col)))
    return rows.select(id_col, "term", F.col("tf").cast("bigint").alias("tf"), F.col("dl").cast("bigint").alias("dl"),
                       *(["positions"] if positions else []))


def _counted(words: DataFrame, id_col: str, positions: bool) -> DataFrame:
    """(id, dl, _c): the array ``_toks`` as counted terms. The sorted array is a column of
    its own, so that no function of it sorts again."""
    toks = F.col("_toks")
    if positions:
        ordered = F.sort_array(F.transform(toks, lambda w, i: F.struct(w.alias("term"), i.cast("int").alias("positions"))))
    else:
        ordered = F.sort_array(toks)
    rows = words.select(id_col, F.size("_toks").alias("dl"), ordered.alias("_s"))
    return rows.select(id_col, "dl", runs(F.col("_s"), ("positions",) if positions else ()).alias("_c"))


#: Tokens that are counted at once (a longer document alone).
COUNTED = 1_000_000


def _counted_together(words: DataFrame, id_col: str, pairs: bool = False) -> DataFrame:
    """(id, dl, _c): the array ``_toks`` (without null elements) as a pair of arrays, of its
    different terms and of how often each is there. With ``pairs`` the terms are "w1 w2"
    of neighbouring elements (``shingles``), of which no text is made before they are counted."""
    ship_package(words.sparkSession)
    return words.mapInArrow(lambda batches: counted(batches, pairs), T.StructType([
        words.schema[id_col], T.StructField("dl", T.IntegerType()), T.StructField("_c", T.StructType([
            T.StructField("term", T.ArrayType(T.StringType())), T.StructField("tf", T.ArrayType(T.IntegerType()))]))]))


def counted(batches: Iterator[pa.RecordBatch], pairs: bool = False) -> Iterator[pa.RecordBatch]:
    """One row per row of an id and an array of words: the id, the number of terms (null for
    null), and a struct of the different terms and how often each is there."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column(1))
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        if pairs:
            sizes = pc.max_element_wise(pc.subtract(sizes, 1), 0, skip_nulls=False)
        lo = 0
        while lo < len(ends):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + COUNTED, side="right")))
            row = np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi], prepend=before))
            coded = batch.column(1).slice(lo, hi - lo).flatten().dictionary_encode()
            word, width = coded.indices.to_numpy(), max(1, len(coded.dictionary))
            if pairs:
                same = row[1:] == row[:-1]
                row, word, width = row[1:][same], (word[:-1].astype(np.int64) * width + word[1:])[same], width * width
            # a number per row and term
            key, times = np.unique(row * width + word, return_counts=True)
            cuts = pa.array(np.searchsorted(key, np.arange(hi - lo + 1) * width), pa.int32())
            term = key % width
            if pairs:
                first, second = np.divmod(term, max(1, len(coded.dictionary)))
                terms = pc.binary_join_element_wise(coded.dictionary.take(pa.array(first)), coded.dictionary.take(pa.array(second)), " ")
            else:
                terms = coded.dictionary.take(pa.array(term))
            both = pa.StructArray.from_arrays([pa.ListArray.from_arrays(cuts, a) for a in (terms, pa.array(times, pa.int32()))],
                                              ["term", "tf"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), sizes.slice(lo, hi - lo).cast(pa.int32()), both],
                [batch.schema.names[0], "dl", "_c"])
            lo = hi


# ---------------------------------------------------------------- statistics

def doc_lengths(postings: DataFrame) -> DataFrame:
    """(doc_id, dl) for documents with at least one term (partial aggregate)."""
    return postings.groupBy("doc_id").agg(F.max("dl").alias("dl"))


def term_stats(postings: DataFrame) -> DataFrame:
    """(term, df, cf): document and collection frequency. A frequent term is
    pre-aggregated map-side, so its skew never reaches one reducer whole."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"),
                                        F.sum("tf").alias("cf"))


#: Registers of a sketch, as a power of two, and the relative standard error that they give.
SKETCH_LG_K = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LG_K / 2)


def term_sketch(terms: DataFrame) -> DataFrame:
    """One row (sketch): a HyperLogLog sketch of the distinct terms."""
    return terms.agg(F.hll_sketch_agg("term", F.lit(SKETCH_LG_K)).alias("sketch"))


def approximate_terms(*sketches: DataFrame) -> DataFrame:
    """G6/K4 at scale: the number of distinct terms of several indexes together, from their
    sketches alone, one row (n_terms, error): an estimate and its relative standard error.
    No term is read, and terms that indexes share count once."""
    every = reduce(lambda a, b: a.unionByName(b), sketches)
    return every.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_terms")) \
        .select("n_terms", F.lit(SKETCH_ERROR).alias("error"))


def corpus_stats(docs: DataFrame, doclen: DataFrame) -> DataFrame:
    """One row: documents (all), documents with a term, tokens, mean length."""
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    lens = doclen.agg(F.count(F.lit(1)).alias("n_docs_nonempty"),
                      F.coalesce(F.sum("dl"), F.lit(0)).cast("bigint").alias("n_tokens"))
    return lens.select(
        n_docs.alias("n_docs"), "n_docs_nonempty", "n_tokens",
        F.try_divide(F.col("n_tokens").cast("double"),
                     F.col("n_docs_nonempty").cast("double")).alias("avgdl"))


# ---------------------------------------------------------------- build / io

CONF_BUCKETS = "quire.index.buckets"
CONF_PARTS = "quire.index.parts"
#: Buckets that make a partition worth having, and partitions at most.
BUCKETS_PER_PART, MAX_PARTS = 32, 64
META = ("analyzer", "stop_words", "positions", "buckets", "parts", "columns")


def _buckets(spark: SparkSession) -> int:
    """Number of buckets of a new index: a setting, else the shuffle partitions."""
    return int(spark.conf.get(CONF_BUCKETS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def _parts(spark: SparkSession) -> int:
    """Number of partitions of a new index, the units that an update rewrites: a setting,
    else by its buckets, as each bucket has a file in every partition."""
    return int(spark.conf.get(CONF_PARTS, None) or min(MAX_PARTS, 1 + _buckets(spark) // BUCKETS_PER_PART))


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part")


def _table(path: str) -> str:
    """One catalog name per path, whatever is written there."""
    return "quire_" + hashlib.sha1(path.rstrip("/").encode()).hexdigest()[:16]


def _columns(meta) -> list[str]:
    return ["doc_id", "term", "tf", "dl", *(["positions"] if meta["positions"] else []), "part"]


def build_index(spark: SparkSession, docs: DataFrame, analyzer: str = "standard",
                path: str | None = None, text_col: str = "contents",
                stored: tuple[str, ...] = (), contents_stored: bool = False,
                stop_words: DataFrame | None = None, positions: bool = False) -> Index:
    """Tokenise once, write postings, derive everything else from them.

    ``docs`` needs ``doc_id`` and ``text_col``. ``stored`` names extra columns
    kept in the ``docs`` table (fetched later for hits only). ``stop_words``
    (column ``word``) are kept with the index and hold for queries too.
    ``positions`` keeps with every posting where its term stands.
    """
    path = path or scratch_path(spark, f"index-{analyzer}")
    if stop_words is not None:
        stop_words = _write_stop_words(stop_words, path)
    buckets = _buckets(spark)
    postings = term_counts(spread(docs, buckets), analyzer, "doc_id", text_col, stop_words, positions=positions, buckets=buckets)
    fields = docs.select("doc_id", *stored, *([text_col] if contents_stored else []))
    return _write(spark, path, postings, fields, analyzer, stop_words is not None, positions)


def _write_stop_words(stop_words: DataFrame, path: str) -> DataFrame:
    stop_words.select("word").distinct().write.mode("overwrite").parquet(f"{path}/stop_words")
    return stop_words.sparkSession.read.parquet(f"{path}/stop_words")


def _write(spark: SparkSession, path: str, postings: DataFrame, fields: DataFrame, analyzer: str, stops: bool,
           positions: bool) -> Index:
    """Postings (dealt by doc_id) and stored fields as a new index."""
    buckets, parts = _buckets(spark), _parts(spark)
    with files_side_by_side(spark, parts):
        (postings.withColumn("part", _part(parts)).write.format("parquet").mode("overwrite").option("path", f"{path}/postings")
         .partitionBy("part").bucketBy(buckets, "doc_id").saveAsTable(_table(path)))
    fields.withColumn("part", _part(parts)).write.mode("overwrite").partitionBy("part").parquet(f"{path}/docs")
    kinds = ", ".join(f"`{c}` {t}" for c, t in postings.dtypes)
    meta = {"analyzer": analyzer, "stop_words": stops, "positions": positions, "buckets": buckets, "parts": parts,
            "columns": kinds}
    _write_stats(spark, path, meta)
    return open_index(spark, path)


def _write_stats(spark: SparkSession, path: str, meta) -> None:
    """Statistics grouped from the written tables; the row of ``corpus`` last."""
    postings, docs = _postings(spark, path, meta), _docs(spark, path)
    doc_lengths(postings).write.mode("overwrite").parquet(f"{path}/doclen")
    term_stats(postings).write.mode("overwrite").parquet(f"{path}/terms")
    sketch = term_sketch(spark.read.parquet(f"{path}/terms")).scalar()
    corpus = corpus_stats(docs, spark.read.parquet(f"{path}/doclen")).select(
        "*", sketch.alias("sketch"), *[F.lit(meta[k]).alias(k) for k in META])
    corpus.coalesce(1).write.mode("overwrite").parquet(f"{path}/corpus")


def _postings(spark: SparkSession, path: str, meta) -> DataFrame:
    """The postings table; declared to a session that has not seen it."""
    name = _table(path)
    if not spark.catalog.tableExists(name):
        at = f"{path}/postings".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({meta['columns']}, part int) USING parquet PARTITIONED BY (part) "
                  f"CLUSTERED BY (doc_id) INTO {meta['buckets']} BUCKETS LOCATION '{at}'")
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _docs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/docs").drop("part")


def _meta(spark: SparkSession, path: str):
    """How the index at a path was made, or None where none was finished."""
    try:
        return spark.read.parquet(f"{path}/corpus").select(*META).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def index_exists(spark: SparkSession, path: str) -> bool:
    return _meta(spark, path) is not None


def open_index(spark: SparkSession, path: str, analyzer: str | None = None) -> Index:
    """An index as it was written, with its analyzer and stop words. Asking
    for another analyzer is an error: queries would be analysed differently from
    the documents."""
    m = _meta(spark, path)
    if m is None:
        raise FileNotFoundError(f"no index at {path}")
    if analyzer is not None and analyzer != m["analyzer"]:
        raise ValueError(f"the index at {path} was built with analyzer {m['analyzer']!r}, not {analyzer!r}")
    for folder in ("docs", "doclen", "terms", "corpus"):
        spark.catalog.refreshByPath(f"{path}/{folder}")
    return Index(
        postings=_postings(spark, path, m), doclen=spark.read.parquet(f"{path}/doclen"),
        terms=spark.read.parquet(f"{path}/terms"), corpus=spark.read.parquet(f"{path}/corpus"),
        docs=_docs(spark, path), analyzer=m["analyzer"], path=path, positions=m["positions"],
        sketch=spark.read.parquet(f"{path}/corpus").select("sketch"),
        stop_words=spark.read.parquet(f"{path}/stop_words") if m["stop_words"] else None)


def write_index(spark: SparkSession, docs: DataFrame, path: str, mode: str = "create",
                analyzer: str | None = None, text_col: str = "contents",
                stored: tuple[str, ...] = (), contents_stored: bool = False,
                stop_words: DataFrame | None = None, positions: bool = False) -> Index:
    """K1: create | append | create_or_append.

    create replaces the tables; append inserts into them with the index's own
    analyzer and stop words (no posting is rewritten) and needs an existing
    index. Either groups the statistics anew.
    """
    exists = index_exists(spark, path)
    if mode == "create_or_append":
        mode = "append" if exists else "create"
    if mode == "create":
        return build_index(spark, docs, analyzer or "standard", path, text_col, stored, contents_stored, stop_words,
                           positions)
    if mode != "append":
        raise ValueError("mode must be create, append or create_or_append")
    if stop_words is not None:
        raise ValueError("append uses the stop words of the index")
    old, m = open_index(spark, path, analyzer), _meta(spark, path)
    new = _analysed(docs, old, m, text_col)
    with files_side_by_side(spark, m["parts"]):
        new.write.mode("append").insertInto(_table(path))
    fields = docs.select("doc_id", *stored, *([text_col] if contents_stored else [])).withColumn("part", _part(m["parts"]))
    fields.write.mode("append").partitionBy("part").parquet(f"{path}/docs")
    _write_stats(spark, path, m)
    return open_index(spark, path)


def _analysed(docs: DataFrame, index: Index, meta, text_col: str) -> DataFrame:
    """Postings of documents as an existing index has them, in its column order."""
    rows = term_counts(spread(docs, meta["buckets"]), index.analyzer, "doc_id", text_col, index.stop_words, positions=index.positions,
                       buckets=meta["buckets"])
    return rows.withColumn("part", _part(meta["parts"])).select(*_columns(meta))


def index_update(spark: SparkSession, docs: DataFrame, path: str, text_col: str = "contents",
                 stored: tuple[str, ...] = (), contents_stored: bool = False) -> Index:
    """K2: documents replace those with the same ``doc_id`` or are added; the
    statistics are those of a rebuild. ``docs`` has one row per id
    (``upsert.latest_per_key`` makes it so). Only the partitions that hold one of its
    ids are rewritten: their rows without these ids, and the new ones."""
    old, m = open_index(spark, path), _meta(spark, path)
    fields = docs.select("doc_id", *stored, *([text_col] if contents_stored else []))
    _replace(spark, path, m, docs.select("doc_id").distinct(), _analysed(docs, old, m, text_col), fields)
    return open_index(spark, path)


def index_delete(spark: SparkSession, path: str, doc_ids: DataFrame) -> Index:
    """D3 in place: the documents go, only the partitions that hold one are rewritten."""
    old, m = open_index(spark, path), _meta(spark, path)
    none = old.postings.select(*_columns(m)).limit(0)
    _replace(spark, path, m, doc_ids.select("doc_id").distinct(), none, old.docs.limit(0))
    return open_index(spark, path)


def _replace(spark: SparkSession, path: str, meta, ids: DataFrame, postings: DataFrame, fields: DataFrame) -> None:
    """Rewrite the partitions of ``ids``: postings and stored fields without these ids, with
    the given rows added. What takes their place is written first, so that it is whole
    before anything is overwritten."""
    ids = materialize(ids.withColumn("part", _part(meta["parts"])), "changed-ids")
    gone = broadcast_if_small(ids.select("doc_id"))
    touched = [r["part"] for r in ids.select("part").distinct().collect()]     # at most ``parts`` numbers
    columns, name = _columns(meta), _table(path)
    kept = _postings(spark, path, meta).filter(F.col("part").isin(touched)).join(gone, "doc_id", "left_anti").select(*columns)
    merged = materialize(kept.unionByName(postings), "merged-postings")
    with overwriting_partitions(spark), files_side_by_side(spark, meta["parts"]):
        merged.repartition(meta["buckets"], "doc_id").write.mode("overwrite").insertInto(name)
    # a partition without rows is not among those written: it is emptied by name
    left = {r["part"] for r in merged.select("part").distinct().collect()}
    for part in set(touched) - left:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (part = {part}) "
                  f"SELECT {', '.join(columns[:-1])} FROM {{none}}", none=merged.limit(0))
    rows = spark.read.parquet(f"{path}/docs")
    kept = rows.filter(F.col("part").isin(touched)).join(gone, "doc_id", "left_anti")
    merged = materialize(kept.unionByName(fields.withColumn("part", _part(meta["parts"])), allowMissingColumns=True), "merged-docs")
    with overwriting_partitions(spark):
        merged.write.mode("overwrite").partitionBy("part").parquet(f"{path}/docs")
    left = {r["part"] for r in merged.select("part").distinct().collect()}
    for part in set(touched) - left:
        merged.limit(0).drop("part").write.mode("overwrite").parquet(f"{path}/docs/part={part}")
    _write_stats(spark, path, meta)


def index_from_postings(spark: SparkSession, postings: DataFrame, docs: DataFrame,
                        path: str, analyzer: str = "standard", stop_words: DataFrame | None = None) -> Index:
    """Persist given postings/docs (e.g. after a merge or delete) as a new index."""
    if stop_words is not None:
        _write_stop_words(stop_words, path)
    positions = "positions" in postings.columns
    rows = postings.select("doc_id", "term", "tf", "dl", *(["positions"] if positions else []))
    return _write(spark, path, rows.repartition(_buckets(spark), "doc_id"), docs, analyzer, stop_words is not None, positions)


def index_stats(index: Index) -> DataFrame:
    """Documents, documents with a term, tokens, distinct terms."""
    n_terms = index.terms.agg(F.count(F.lit(1))).scalar()
    return index.corpus.select("n_docs", "n_docs_nonempty", "n_tokens", n_terms.alias("n_terms"))


# ---------------------------------------------------------------- maintenance

def merge_postings(*postings: DataFrame) -> DataFrame:
    """K4: union of partial indexes (document sets assumed disjoint)."""
    out = postings[0]
    for p in postings[1:]:
        out = out.unionByName(p)
    return out


def delete_docs(index: Index, doc_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D3: postings and docs without the given documents. The ids are size-checked: few are
    broadcast into both scans, many meet the postings bucket by bucket."""
    keys = broadcast_if_small(doc_ids.select("doc_id").distinct())
    return (index.postings.join(keys, "doc_id", "left_anti"),
            index.docs.join(keys, "doc_id", "left_anti"))
