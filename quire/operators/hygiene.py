"""Corpus hygiene: exact deduplication, duplicate groups, deletes, tf-idf top terms
(D1-D6, T1-T3, K5).

Skew: a group of copies may hold a large share of all documents. Dedup is
therefore an aggregate (min id per content hash, pre-aggregated map-side)
followed by a semi join on doc_id -- never a window over the hash, which
would sort a hot group in one task -- and duplicate groups are reported one
row per member, never as a collected list.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.index import Index
from quire.operators.joins import broadcast_if_small, join_hot_cold, join_small
from quire.session import materialize

TFIDF_DECIMALS = 7
HOT_TERM_SHARE = 1000     # a term in >= 1/HOT_TERM_SHARE of the documents is "hot"


def content_key(text_col: str = "contents", mode: str = "sha256"):
    """Hash of the content: sha-256 (default) or the 32-bit Java string hash
    (compatibility: equal hashes are then taken as equal contents)."""
    if mode == "java":
        return java_string_hash(F.col(text_col))
    return F.sha2(F.col(text_col), 256)


def content_keys(docs: DataFrame, text_col: str = "contents", mode: str = "sha256") -> DataFrame:
    """(doc_id, h), written once: every text is hashed a single time, and what
    follows reads some 80 bytes a document. Null contents are equal contents."""
    key = F.coalesce(content_key(text_col, mode).cast("string"), F.lit("null"))
    return materialize(docs.select("doc_id", key.alias("h")), "content-keys")


def _kept(keys: DataFrame) -> DataFrame:
    return keys.groupBy("h").agg(F.min("doc_id").alias("doc_id")).select("doc_id")


def kept_ids(docs: DataFrame, text_col: str = "contents", mode: str = "sha256") -> DataFrame:
    """(doc_id) of the first (lowest id) document of each content."""
    return _kept(content_keys(docs, text_col, mode))


def _groups(keys: DataFrame) -> DataFrame:
    g = (keys.groupBy("h").agg(F.min("doc_id").alias("kept_id"),
                               F.count(F.lit(1)).alias("n_copies"))
         .filter(F.col("n_copies") > 1))
    # one group of copies may hold a large share of all documents: the group
    # table goes by broadcast when small, else the join is salted by doc_id
    return join_small(keys, g, "h", spread_col="doc_id").select(
        "doc_id", "kept_id", F.col("n_copies").cast("bigint"))


def dedup_exact(docs: DataFrame, text_col: str = "contents", mode: str = "sha256") -> DataFrame:
    """Documents without exact copies; the lowest id of each content is kept.
    The ids that go, fewer than those that stay, are anti-joined: broadcast when
    they are checked to be few, so that texts are not shuffled."""
    gone = _groups(content_keys(docs, text_col, mode)).filter("doc_id != kept_id").select("doc_id")
    return docs.join(broadcast_if_small(gone), "doc_id", "left_anti")


def dup_groups(docs: DataFrame, text_col: str = "contents", mode: str = "sha256") -> DataFrame:
    """One row per document that has copies: (doc_id, kept_id, n_copies)."""
    return _groups(content_keys(docs, text_col, mode))


def delete_by_key(docs: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """D3: rows whose key is not listed (anti join; keys de-duplicated)."""
    return docs.join(keys.select(key).distinct(), key, "left_anti")


def tfidf(index: Index) -> DataFrame:
    """(doc_id, term, tf, df, tfidf) with tfidf = tf * log10(N / df), raw
    tf, N = all documents (including those without a term)."""
    n = index.corpus.select(F.col("n_docs").cast("double")).scalar()
    # postings x vocabulary is a large-large join on a skewed key: frequent
    # terms (in >= 1/1000 of the documents) are few and go by broadcast
    hot = F.col("df") * F.lit(HOT_TERM_SHARE) >= n
    p = join_hot_cold(index.postings.select("doc_id", "term", "tf"),
                      index.terms.select("term", "df"), "term", hot)
    return p.select(
        "doc_id", "term", "tf", "df",
        F.round(F.col("tf") * F.log10(n / F.col("df")), TFIDF_DECIMALS).alias("tfidf"))


def top_terms(index: Index, n: int = 10, first_doc=None, last_doc=None) -> DataFrame:
    """The ``n`` highest tf-idf terms of each document in an
    inclusive id range (ties: term ascending). df comes from the whole
    collection; the range only selects the documents reported."""
    w = tfidf(index)
    if first_doc is not None:
        w = w.filter(F.col("doc_id") >= first_doc)
    if last_doc is not None:
        w = w.filter(F.col("doc_id") <= last_doc)
    win = Window.partitionBy("doc_id").orderBy(F.desc("tfidf"), F.asc("term"))
    return (w.withColumn("rank", F.row_number().over(win).cast("bigint"))
            .filter(F.col("rank") <= n)
            .select("doc_id", "rank", "term", "tf", "df", "tfidf"))


# ------------------------------------------------------------- Java hash

def _java_hash_one(s: str | None):
    if s is None:
        return None
    units = np.frombuffer(s.encode("utf-16-be"), dtype=">u2").astype(np.uint32)
    k = len(units)
    if k == 0:
        return 0
    powers = np.full(k, 31, dtype=np.uint32)
    powers[-1] = 1
    powers = np.cumprod(powers[::-1], dtype=np.uint32)[::-1]   # 31^(k-1-i) mod 2^32
    h = int(np.sum(units * powers, dtype=np.uint32))
    return h - (1 << 32) if h >= (1 << 31) else h


@F.pandas_udf(T.IntegerType())
def _java_hash_udf(s: pd.Series) -> pd.Series:
    return s.map(_java_hash_one).astype("Int32")


def java_string_hash(col):
    """Java ``String.hashCode`` (31-polynomial over UTF-16 units, signed
    32 bit); vectorised per text with numpy inside an Arrow-batched UDF."""
    return _java_hash_udf(col)
