"""The driver's parquet tables mapped onto the engine's data model.

=============  =========================================================
documents      -> docs(doc_id, contents, lang, source, n_chars)
benchmark      -> queries(query_id, text)  (the whole passage is the query)
(derived)      -> qrels(query_id, doc_id): judgements computed by Spark
                  from the same tables (there are none in the data)
=============  =========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.analysis import token_array
from quire.operators.docscores import query_table, shared_terms
from quire.operators.joins import broadcast_if_small, join_small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("contents"), "lang", "source", "n_chars")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), "text")


def derived_qrels(queries: DataFrame, postings: DataFrame, min_share: float = 0.4,
                  analyzer: str = "standard") -> DataFrame:
    """(query_id, doc_id): a document is relevant when it contains at least
    ``min_share`` of the query's distinct terms (standard analyzer).

    Counted for some documents and all queries at a time (``docscores``) where the query
    terms can be sent to the tasks. Otherwise an equi join on term between the query terms
    (size-checked broadcast) and the postings, then a count per (query, document) with
    partial aggregation; no pair is formed unless they share a term.
    """
    qt = (queries.select("query_id", F.explode_outer(F.array_distinct(
            token_array(F.lower("text"), analyzer))).alias("term"))
          .filter(F.col("term").isNotNull()))
    known = qt.filter(F.col("query_id").isNotNull()).withColumn("qtf", F.lit(1))
    table = query_table(known)
    if table is not None:
        return shared_terms(postings, table, qt.schema["query_id"].dataType, min_share)
    nq = qt.groupBy("query_id").agg(F.count(F.lit(1)).alias("nq"))
    hits = (join_small(postings.select("doc_id", "term"), qt, "term")
            .groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("m")))
    return (hits.join(broadcast_if_small(nq), "query_id")
            .filter(F.col("m").cast("double") >= F.lit(min_share) * F.col("nq"))
            .select("query_id", "doc_id"))


def verbatim_qrels(queries: DataFrame, docs: DataFrame, postings: DataFrame) -> DataFrame:
    """(query_id, doc_id): the document contains the passage verbatim.

    Candidates are the documents holding every distinct term of the passage
    (exact pre-filter through the postings join), then ``instr`` on the text of
    those candidates only.
    """
    cand = derived_qrels(queries, postings, min_share=1.0)
    return (cand.join(broadcast_if_small(queries.select("query_id", "text")), "query_id")
            .join(docs.select("doc_id", "contents"), "doc_id")
            .filter(F.instr(F.col("contents"), F.col("text")) > 0)
            .select("query_id", "doc_id"))
