"""Incremental upsert of a document table with Structured Streaming (K3).

The replaced indexer re-ran a whole "update" command by hand. Here a file
stream picks up only input files not seen before (the checkpoint remembers
them). The table is partitioned by ``bucket``, a hash of the key: a micro-batch
is upserted into the buckets that its keys fall into, and only these are
overwritten. ``trigger(availableNow=True)`` processes what is there and stops
-- the batch form of a continuous job.

A stream of many micro-batches would copy the table once for each, as their keys fall into
every bucket. So it lays them aside, one folder each, and merges them when they have grown
as large as the table and when the stream ends: what is written in all stays in proportion
to the input. The merge gives what upserting them one after the other would.

Every finished micro-batch is recorded with the checkpoint that numbered it. One
that is delivered again, as happens when a driver is lost between the write and
the commit of its number, is skipped if it was recorded, and otherwise upserted
again with the same result. State lives only in the checkpoint (source offsets)
and in the table's folder, both shared.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.joins import broadcast_if_small
from quire.operators.upsert import latest_per_key, upsert
from quire.session import delete_path, materialize, overwriting_partitions, path_bytes

BUCKETS = 32
EPOCHS = "checkpoint string, epoch long"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The table as it is now, or None."""
    rows = _read(spark, f"{root}/rows")
    return rows if rows is None else rows.drop("bucket")


def upsert_batch(spark: SparkSession, root: str, batch: DataFrame, key: str,
                 order_col: str | None = None, buckets: int = BUCKETS) -> None:
    """Upsert one batch into the table: its buckets are read, merged, written aside and
    then put in the place of the old ones."""
    new = materialize(latest_per_key(batch, key, order_col).select(*batch.columns, _bucket(key, buckets)), "stream-batch")
    old = _read(spark, f"{root}/rows")
    if old is not None:
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]      # at most ``buckets`` numbers
        merged = upsert(old.filter(F.col("bucket").isin(touched)).drop("bucket"), new.drop("bucket"), key, order_col)
        new = materialize(merged.withColumn("bucket", _bucket(key, buckets)), "stream-merged")
    with overwriting_partitions(spark):
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/rows")


def _done(spark: SparkSession, root: str, checkpoint: str, epoch: int) -> bool:
    done = _read(spark, f"{root}/epochs")
    return done is not None and not done.filter((F.col("checkpoint") == checkpoint) & (F.col("epoch") == epoch)).isEmpty()


def _record(spark: SparkSession, root: str, checkpoint: str, epoch: int) -> None:
    spark.range(1).select(F.lit(checkpoint).alias("checkpoint"), F.lit(epoch).cast("long").alias("epoch")) \
        .coalesce(1).write.mode("append").parquet(f"{root}/epochs")


def upsert_epoch(spark: SparkSession, root: str, batch: DataFrame, checkpoint: str, epoch: int, key: str,
                 order_col: str | None = None, buckets: int = BUCKETS) -> bool:
    """``upsert_batch`` unless this micro-batch of this checkpoint is recorded as done;
    whether it was carried out."""
    if _done(spark, root, checkpoint, epoch):
        return False
    if not batch.isEmpty():
        upsert_batch(spark, root, batch, key, order_col, buckets)
    _record(spark, root, checkpoint, epoch)
    return True


def _folded(pending: DataFrame, key: str, order_col: str | None) -> DataFrame:
    """One row per key: what upserting the micro-batches in turn leaves of them, and
    ``_forced``, whether it takes the place of any older row (an update without a value to
    order by does). Rows without a key never replace one another."""
    cols = [c for c in pending.columns if c not in (key, "_epoch")]
    each = F.when(F.col(key).isNull(), F.col("_epoch")).alias("_each")
    if order_col:
        w = Window.partitionBy(key, each)
        rows = pending.withColumn("_from", F.max(F.when(F.col(order_col).isNull(), F.col("_epoch"))).over(w))
        rows = rows.filter(F.col("_from").isNull() | (F.col("_epoch") >= F.col("_from")))
        first, forced = [F.col(order_col).alias("_o")], F.max("_from").isNotNull()
    else:
        rows, first, forced = pending, [], F.lit(False)
    best = F.max(F.struct(*first, F.col("_epoch"), F.struct(*[F.col(c) for c in cols]).alias("_p")))
    return (rows.groupBy(key, each).agg(best.alias("_r"), forced.alias("_forced"))
            .select(key, *[F.col(f"_r._p.{c}").alias(c) for c in cols], "_forced"))


def merge_pending(spark: SparkSession, root: str, key: str, order_col: str | None = None, buckets: int = BUCKETS) -> None:
    """Merge the micro-batches that were laid aside into the table, and drop them."""
    pending = _read(spark, f"{root}/pending")
    if pending is None:
        return
    new = materialize(_folded(pending, key, order_col).withColumn("bucket", _bucket(key, buckets)), "stream-batch")
    old = _read(spark, f"{root}/rows")
    rows = new.drop("_forced")
    if old is not None:
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]      # at most ``buckets`` numbers
        kept = old.filter(F.col("bucket").isin(touched)).drop("bucket") \
            .join(broadcast_if_small(new.filter("_forced").select(key)), key, "left_anti")
        plain = rows.drop("bucket")
        merged = upsert(kept, plain.filter(F.col(key).isNotNull()), key, order_col).unionByName(plain.filter(F.col(key).isNull()))
        rows = materialize(merged.withColumn("bucket", _bucket(key, buckets)), "stream-merged")
    with overwriting_partitions(spark):
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/rows")
    delete_path(spark, f"{root}/pending")


def lay_aside_epoch(spark: SparkSession, root: str, batch: DataFrame, checkpoint: str, epoch: int, key: str,
                    order_col: str | None = None, buckets: int = BUCKETS) -> bool:
    """Lay a micro-batch aside unless it is recorded as done, and merge what lies there once
    it is as large as the table; whether it was carried out."""
    if _done(spark, root, checkpoint, epoch):
        return False
    if not batch.isEmpty():
        latest_per_key(batch, key, order_col).select(*batch.columns).write.mode("overwrite").parquet(f"{root}/pending/_epoch={epoch}")
        if path_bytes(spark, f"{root}/pending") >= path_bytes(spark, f"{root}/rows"):
            merge_pending(spark, root, key, order_col, buckets)
    _record(spark, root, checkpoint, epoch)
    return True


def upsert_stream(spark: SparkSession, source_dir: str, schema, table_root: str,
                  checkpoint: str, key: str = "doc_id", order_col: str | None = None,
                  fmt: str = "parquet", max_files_per_batch: int = 1000, buckets: int = BUCKETS) -> DataFrame | None:
    """Process every new file of ``source_dir`` once (availableNow) and return the table
    (None if nothing ever came)."""
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_batch).load(source_dir))

    def each(batch: DataFrame, epoch: int) -> None:
        lay_aside_epoch(batch.sparkSession, table_root, batch, checkpoint, epoch, key, order_col, buckets)

    merge_pending(spark, table_root, key, order_col, buckets)            # what a lost driver left
    q = (stream.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    merge_pending(spark, table_root, key, order_col, buckets)
    return current_table(spark, table_root)
