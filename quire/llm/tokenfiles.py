"""Token ids of documents as ORC files.

Rows are documents in ascending id order: the range shuffle and the sort come before the
encoding, so each text is encoded once and a file holds one range of ids. The ids are an
integer column, which ORC run-length encodes; document ids carry row indexes and Bloom
filters, so that a reader who asks for some documents skips files, stripes and row
groups by metadata, while a full read splits files at stripes. Every row says in which
file part and how many ids after its beginning it starts, so stripes need not be read in
order to know positions.

Defined results: null text is empty (its end id alone); null ids come first; rows with
the same id keep the order in which they were written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quire.llm.common import released
from quire.llm.tokens import coder
from quire.session import ship_package

STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1000


def write_tokens(docs: DataFrame, path: str, vocabulary: str, spaced: bool, parts: int | None = None,
                 text_col: str = "text", id_col: str = "doc_id") -> None:
    """Encode ``docs`` and write doc_id, part, start (within the part), n_tokens, ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, start, part = coder(vocabulary, spaced).encode_column, 0, TaskContext.get().partitionId()
        for batch in batches:
            done = 0
            for some in encode(batch.column(1)):
                n = np.fromiter((len(ids) // 4 for ids in some), np.int64, len(some))
                ends = np.cumsum(n)
                values = pa.array(np.frombuffer(b"".join(some), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(some)), pa.array(np.full(len(some), part), pa.int32()),
                     pa.array(start + ends - n), pa.array(n), lists],
                    ["doc_id", "part", "start", "n_tokens", "ids"])
                done, start = done + len(some), start + int(ends[-1])

    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id"))
    (ordered.mapInArrow(released(run), f"doc_id {kind}, part int, start long, n_tokens long, ids array<int>")
     .write.mode("overwrite").option("compression", "zstd")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(INDEX_STRIDE))
     .option("orc.stripe.size", str(STRIPE_BYTES)).orc(path))


SCHEMA = "part int, start long, n_tokens long, ids array<int>"


def read_tokens(spark: SparkSession, path: str, doc_ids: list | None = None, id_type: str = "bigint") -> DataFrame:
    """Documents of written files with ``start`` counted over all files; only those in
    ``doc_ids``, if given, are read beyond metadata (part totals come from the files'
    narrow columns)."""
    rows = spark.read.schema(f"doc_id {id_type}, {SCHEMA}").orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per written file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    wanted = rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))
    return (wanted.join(F.broadcast(bases), "part")
            .select("doc_id", (F.col("_base") + F.col("start")).alias("start"), "n_tokens", "ids"))


@F.arrow_udf(LongType())
def ids_crc32(ids: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of a list of ids as little-endian unsigned 32-bit numbers."""
    values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<i4")
    cuts = ids.offsets.to_numpy()
    return pa.array([zlib.crc32(values[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.int64())
