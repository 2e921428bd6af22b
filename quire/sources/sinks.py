"""Writers: collection/judgement/query files, file trees, and report CSVs
(K5-K9 and the inputs of S1, S10-S14).

Everything is written by Spark tasks into a directory (one or more part
files); nothing is gathered on the driver. Where a format needs all lines of
one record together (a judgement record lists every relevant document of a
query), rows are range-partitioned by the record key and written as a sorted
stream of lines, so a record never spans two files and no record is built in
memory.
"""

from __future__ import annotations

import os
import re
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import delete_path, materialize, mounted


def write_collection(df: DataFrame, path: str, id_col: str = "doc_id",
                     text_col: str = "contents") -> str:
    """Records ``<id>\\n<text>\\n/`` (text must not contain ``/``)."""
    rec = F.concat(F.col(id_col).cast("string"), F.lit("\n"), F.col(text_col), F.lit("\n/"))
    df.select(rec.alias("value")).write.mode("overwrite").text(path)
    return path


def write_qrels(qrels: DataFrame, path: str, partitions: int | None = None) -> str:
    """Judgement records ``<query_id>\\n<doc_id>\\n...<doc_id>\\n/``, a line per
    document, in (query_id, doc_id) order over the part files in path order. A query of
    many judgements is dealt over several files: its record goes on in the next."""
    rows = qrels.select("query_id", "doc_id").distinct()
    ids = rows.select("query_id").distinct()

    def line(df: DataFrame, kind: int, doc, value) -> DataFrame:
        return df.select("query_id", F.lit(kind).alias("_k"), doc.alias("_d"), value.alias("value"))
    none = F.lit(None).cast(dict(rows.dtypes)["doc_id"])
    lines = line(ids, 0, none, F.col("query_id").cast("string")) \
        .unionByName(line(rows, 1, F.col("doc_id"), F.col("doc_id").cast("string"))).unionByName(line(ids, 2, none, F.lit("/")))
    order = ["query_id", "_k", "_d"]
    n = partitions or lines.sparkSession.sparkContext.defaultParallelism
    (lines.repartitionByRange(n, *order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path))
    return path


def write_query_lines(queries: DataFrame, path: str) -> str:
    """One query per line (line ends inside a query become spaces), in
    query_id order."""
    q = queries.select("query_id", F.regexp_replace("text", r"[\r\n]+", " ").alias("value"))
    q.orderBy("query_id").select("value").write.mode("overwrite").text(path)
    return path


def write_tree(docs: DataFrame, path: str, folder_col: str = "source",
               text_col: str = "contents") -> str:
    """A directory tree: one sub-folder per ``folder_col`` value, one file per
    document, named as ``partitionBy`` names folders.

    Spark's writer does it (``maxRecordsPerFile=1``), except in a folder that every
    machine mounts (``file:``): there Hadoop starts two ``chmod`` processes a file, which
    take nearly all the time, and tasks write the files themselves. Their rows are
    written once before, so that a task that is run again writes the same files."""
    local = mounted(docs.sparkSession, path)
    if local is None:
        (docs.select(folder_col, text_col).write.mode("overwrite")
         .option("maxRecordsPerFile", 1).partitionBy(folder_col).text(path))
        return path
    rows = materialize(docs.select(F.col(folder_col).cast("string").alias("folder"), F.col(text_col).alias("text")), "tree-rows")
    delete_path(docs.sparkSession, path)
    (rows.mapInArrow(lambda batches: _write_files(batches, local, folder_col), "files bigint")
     .write.format("noop").mode("overwrite").save())
    return path


def _folder_name(column: str, value: str | None) -> str:
    """``column=value`` as ``partitionBy`` writes it."""
    if not value:
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    return f"{column}=" + re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def _write_files(batches, root: str, column: str):
    """One file per row (folder, text) of this task. A file gets its name when it is whole."""
    task, made, n = TaskContext.get(), set(), 0
    for batch in batches:
        for folder, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            at = os.path.join(root, _folder_name(column, folder))
            if at not in made:
                os.makedirs(at, exist_ok=True)
                made.add(at)
            name = f"part-{task.partitionId():05d}-{n:09d}.txt"
            part = os.path.join(at, f".{name}.{task.taskAttemptId()}")
            with open(part, "wb", buffering=0) as f:
                f.write((text.as_py() or b"") + b"\n")
            os.replace(part, os.path.join(at, name))
            n += 1
    yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})


def write_report_csv(report: DataFrame, path: str, header: bool = True) -> str:
    """K5-K9: a report table as CSV part files (header per file)."""
    report.write.mode("overwrite").option("header", str(header).lower()).csv(path)
    return path


def _ordered_lines(parts: list[tuple[DataFrame, str]], path: str) -> str:
    """Lines (``value``) of each part, one part after the other and inside a part by
    an order column, written sorted: the layout holds over the part files."""
    lines = [df.select(F.lit(k).alias("_k"), F.expr(order).try_cast("bigint").alias("_q"), "value")
             for k, (df, order) in enumerate(parts)]
    (reduce(lambda a, b: a.unionByName(b), lines).orderBy("_k", "_q").select("value")
     .write.mode("overwrite").text(path))
    return path


def write_eval_csv(report: DataFrame, path: str) -> str:
    """K6 layout of an evaluation report: ``queryID,P@n,AP@n,recall@n,rr,cut=N``, a line
    per query, the ``average`` line last."""
    fields = ["query", "p", "ap", "recall", "rr"]
    line = report.withColumn("value", F.concat_ws(",", *[F.col(c).cast("string") for c in fields]))
    total = line.filter("query = 'average'")
    n = F.col("cut").cast("string")
    head = total.withColumn("value", F.concat(F.lit("queryID,P@"), n, F.lit(",AP@"), n, F.lit(",recall@"), n,
                                              F.lit(",rr,cut="), n))
    return _ordered_lines([(head, "0"), (line.filter("query != 'average'"), "query"), (total, "0")], path)


def write_training_csv(matrix: DataFrame, path: str, metric_label: str, params) -> str:
    """K7 layout of a training matrix: the metric and the parameter values, a line per
    query, the ``avg`` line last."""
    line = matrix.withColumn("value", F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in matrix.columns]))
    total = line.filter("query = 'avg'")
    head = total.withColumn("value", F.lit(",".join([metric_label, *[f"{v:g}" for v in params]])))
    return _ordered_lines([(head, "0"), (line.filter("query != 'avg'"), "query"), (total, "0")], path)


def write_test_csv(test_report: DataFrame, path: str, metric_label: str) -> str:
    """K8 layout: ``query,<metric>``, ``value=<best>``, per-query rows, ``avg``.

    The three kinds of line are unioned with an ordering key and written
    sorted, so the layout holds in the part files without a driver loop."""
    rows = test_report.filter(F.col("query") != "avg")
    avg = test_report.filter(F.col("query") == "avg")
    head = avg.select(F.lit(0).alias("_k"), F.lit(-1).cast("bigint").alias("_q"),
                      F.lit(f"query,{metric_label}").alias("value"))
    best = avg.select(F.lit(1).alias("_k"), F.lit(-1).cast("bigint").alias("_q"),
                      F.concat(F.lit("value="), F.col("best_param").cast("string")).alias("value"))
    body = rows.select(F.lit(2).alias("_k"), F.col("query").cast("bigint").alias("_q"),
                       F.concat_ws(",", "query", F.col("value").cast("string")).alias("value"))
    tail = avg.select(F.lit(3).alias("_k"), F.lit(-1).cast("bigint").alias("_q"),
                      F.concat(F.lit("avg,"), F.col("value").cast("string")).alias("value"))
    (head.unionByName(best).unionByName(body).unionByName(tail)
     .orderBy("_k", "_q").select("value").write.mode("overwrite").text(path))
    return path
