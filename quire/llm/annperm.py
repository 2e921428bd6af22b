"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots (the first ``prefix`` of
``pivots``). The index posts every vector under each of those pivots with its place.
A query adds up, over the files of its own pivots, what two orders have in common; that
is the footrule distance of the two prefixes up to a constant. The best share of each
block is then reranked by the exact inner product in double precision, and with it every
vector whose order is nearly the query's (members of a large cluster of near copies, among
which places of pivots say little).

For vectors of different lengths the largest inner product is turned into the smallest
angle: one more coordinate brings every vector to the largest length, and queries have 0
there. Pivots come from a bounded sample (``SAMPLE`` vectors, those with the smallest
hashes of their ids), in which a vector too like an earlier pivot is passed over, so that
a large cluster does not take most of them; every vector is indexed.

Scale: the table is read and indexed once (written: id, vector, order). Index and queries
meet in blocks of at most ``block_rows`` vectors and ``block_queries`` queries, each pair
of blocks in one task with about ``pivots * block_rows`` bytes of files. Blocks are dealt
by a hash of the id, so equal vectors are spread evenly. A task returns at most ``k`` rows
per query; the last cut is a windowed top-k, which Spark limits before its shuffle.

Defined results: null ids, and vectors that are null, zero, of another dimension than
most, or hold null or non-finite components, take no part. Of rows with the same id the
largest vector (in array order) counts. Ties go to the smaller id. Without queries or
candidates there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import materialize, ship_package

PIVOTS = 256
PREFIX = 128
K = 20
SAMPLE = 2048
ALIKE = 0.8
BLOCK_ROWS = 1 << 14
BLOCK_QUERIES = 1 << 12
LEAST_CANDIDATES = 500
CANDIDATE_SHARE = 0.04
#: Reranked as well, however many: all whose order has this share of the most in common.
CLOSE = 0.7


def usable(vector: Column) -> Column:
    """Whether a vector has only finite numbers, and one that is not 0."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def orders(x: np.ndarray, largest: float, pivots: np.ndarray, prefix: int, query: bool) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    square = (x * x).sum(1)
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(largest ** 2 - square, 0))
    near = np.column_stack([x, extra]) @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.uint16)


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """n rows of a sample: in order, those that are not alike first."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen, passed = [], []
    for i in range(len(unit)):
        if len(chosen) < n and (not chosen or (unit[chosen] @ unit[i]).max() < ALIKE):
            chosen.append(i)
        else:
            passed.append(i)
    return sample[[*chosen, *passed][:n]]


def index(vectors: DataFrame, id_col: str, vector_col: str, pivots: int, prefix: int) -> DataFrame:
    """Written table of vec_id, vector and both orders (as indexed, and as a query)."""
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")) \
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    one = rows.groupBy("vec_id").agg(F.max("vector").alias("vector"))
    top = rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").first()
    if top is None:
        return rows.select("vec_id", "vector", F.lit(None).cast("binary").alias("placed"), F.lit(None).cast("binary").alias("asked"))
    dims = top["dims"]
    own = one.filter(F.size("vector") == dims)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    largest = rows.filter(F.size("vector") == dims).agg(F.sqrt(F.max(square))).first()[0]
    chosen = rows.filter(F.size("vector") == dims).orderBy(F.xxhash64(F.lit("pivot"), "vec_id"), "vec_id").limit(SAMPLE).collect()
    at = spread(np.array([r["vector"] for r in chosen], np.float64), pivots)
    at = np.column_stack([at, np.sqrt(np.maximum(largest ** 2 - (at * at).sum(1), 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = as_matrix(b.column(1), dims)
            both = [orders(x, largest, at, prefix, query) for query in (False, True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array([o.tobytes() for o in os], pa.binary())
                                                                          for os in both]], ["vec_id", "vector", "placed", "asked"])
    return materialize(own.mapInArrow(run, "vec_id long, vector array<double>, placed binary, asked binary"), "permutation-index")


def files(placed: np.ndarray, pivots: int) -> np.ndarray:
    """One row per pivot: for every vector of the block prefix - place, or 0 if it is not
    posted there."""
    n, prefix = placed.shape
    out = np.zeros((pivots, n), np.uint16)
    for place in range(prefix):
        out[placed[:, place], np.arange(n)] = prefix - place
    return out


def search_block(ids: np.ndarray, x: np.ndarray, placed: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 asked: np.ndarray, pivots: int, k: int) -> pd.DataFrame:
    """The k best of a block for each query. With places a and b of a shared pivot, the
    footrule distance of two prefixes of length m is m(m+1) - 2 * sum(m - max(a, b))."""
    by_id = np.argsort(ids, kind="stable")
    ids, x, placed = ids[by_id], x[by_id], placed[by_id]
    posted, n, prefix = files(placed, pivots), len(ids), placed.shape[1]
    wanted = min(n, LEAST_CANDIDATES + int(CANDIDATE_SHARE * n))
    found = []
    for q, vector, order in zip(query_ids, queries, asked):
        if wanted < n:
            common = np.zeros(n, np.uint32)
            for place, pivot in enumerate(order):
                common += np.minimum(posted[pivot], np.uint16(prefix - place))
            rank = common.astype(np.int64) * n + np.arange(n - 1, -1, -1)      # ties to the smaller id
            best = np.argpartition(-rank, wanted - 1)[:wanted]
            close = np.flatnonzero(common >= CLOSE * prefix * (prefix + 1) / 2)
            if len(close) > wanted // 2:
                best = np.union1d(best, close)
        else:
            best = np.arange(n)
        best = best[ids[best] != q]
        score = np.einsum("ij,j->i", x[best], vector)
        first = np.lexsort((ids[best], -score))[:k]
        found.append((np.full(len(first), q), ids[best][first], score[first]))
    q, v, s = (np.concatenate(z) for z in zip(*found)) if found else ([], [], [])
    return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
           pivots: int = PIVOTS, prefix: int = PREFIX, block_rows: int = BLOCK_ROWS,
           block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found. ``is_query`` is a condition
    on vec_id."""
    table = index(vectors, id_col, vector_col, pivots, prefix)
    asking = table.filter(is_query)
    n, m = table.count(), asking.count()
    row_blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-m // block_queries))

    def dealt(salt: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = table.select("vec_id", "vector", F.col("placed").alias("order"), dealt("row", row_blocks).alias("rb")) \
        .withColumn("qb", every(query_blocks))
    asked = asking.select("vec_id", "vector", F.col("asked").alias("order"), dealt("query", query_blocks).alias("qb")) \
        .withColumn("rb", every(row_blocks))

    def meet(own: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        def arrays(f: pd.DataFrame) -> tuple:
            return (f["vec_id"].to_numpy(), np.stack(f["vector"].to_list()),
                    np.frombuffer(b"".join(f["order"]), np.uint16).reshape(len(f), -1))
        return search_block(*arrays(own), *arrays(q), pivots, k)

    parts = rows.groupBy("rb", "qb").cogroup(asked.groupBy("rb", "qb")) \
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
