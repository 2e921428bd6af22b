"""Record-delimited test-collection files, query lines, stop words, run CSVs
(S10-S14).

Collection format: records end with a ``/`` character; in a record, blank
lines are ignored, the first line is an integer id and the remaining lines
are the text, each line end becoming one space (so the text ends with a
space). The same parser serves documents and queries. Judgement files use the
same record split; a record is a query id followed by the ids of its relevant
documents, separated by any white space.

Files are read with ``lineSep="/"`` so a large collection file is split
across tasks like any text file. What follows the last ``/`` of a file is not a
record: the bytes of all records and their separators are compared with the
size of the file, and where the last separator is missing the last record goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.joins import broadcast_if_small, join_small
from quire.session import materialize

_INT = r"^[+-]?[0-9]+$"


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, rec): terminated records in file order, line ends
    normalised to \\n."""
    recs = (spark.read.option("lineSep", "/").text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_size").alias("size"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), F.col("value").alias("rec")))
    # a byte-order mark at the beginning (3 bytes) is not part of a record
    ends = recs.groupBy("file").agg(
        (F.sum(F.octet_length("rec") + 1) - F.max("size")).alias("over"),
        F.max(F.struct("block", "seq")).alias("last"))
    opened = ends.filter(F.col("over").isin(1, -2)).select("file", F.col("last.block"), F.col("last.seq"))
    norm = F.regexp_replace(F.regexp_replace("rec", "\r\n", "\n"), "\r", "\n")
    # one row per file that ends without a separator
    return (recs.join(broadcast_if_small(opened, 200_000), ["file", "block", "seq"], "left_anti")
            .select("file", "block", "seq", norm.alias("rec")))


def read_collection(spark: SparkSession, path: str, id_col: str = "doc_id",
                    text_col: str = "contents", with_rejects: bool = False):
    """(id, text). A repeated id keeps the last record (file order); a
    record whose first line is not an integer goes to the reject table
    (``with_rejects=True`` returns (good, rejects))."""
    lines = F.filter(F.split("rec", "\n"), lambda x: F.btrim(x, F.lit(" \t")) != "")
    r = _records(spark, path).select("file", "block", "seq", lines.alias("lines")).filter(F.size("lines") > 0)
    first = F.get("lines", 0)
    rest = F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(0)))
    body = F.array_join(F.transform(rest, lambda x: F.concat(x, F.lit(" "))), "")
    parsed = r.select("file", "block", "seq", first.alias("_id"), body.alias(text_col))
    good = parsed.filter(F.col("_id").rlike(_INT))
    latest = (good.groupBy(F.col("_id").cast("bigint").alias(id_col))
              .agg(F.max_by(F.col(text_col), F.struct("file", "block", "seq")).alias(text_col)))
    if with_rejects:
        rejects = parsed.filter(~F.col("_id").rlike(_INT)).select("file", "seq", "_id")
        return latest, rejects
    return latest


def read_qrels(spark: SparkSession, path: str, across_files: bool = False) -> DataFrame:
    """Long-form judgements (query_id, doc_id); a repeated query id keeps
    its last record; repeated document ids are kept (see ``judged_counts``).

    A record may span lines, tasks and, with ``across_files`` (files in path order are one
    text, as ``write_qrels`` makes them), files: every piece between separators is numbered
    with the separators before it, a running count over the lines of its split plus the
    count of the splits before. A record's first word names its query."""
    lines = spark.read.text(path).select(
        F.lit("").alias("text") if across_files else F.col("_metadata.file_path").alias("text"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.split("value", "/").alias("pieces"))
    lines = lines.withColumn("n", F.size("pieces") - 1)
    splits = lines.groupBy("text", "file", "block").agg(F.sum("n").alias("n"))
    # one row per input split
    before = Window.partitionBy("text").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("text")
    offsets = splits.select("text", "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"),
                            F.sum("n").over(whole).alias("records"))
    inside = Window.partitionBy("text", "file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = (lines.withColumn("run", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(broadcast_if_small(offsets, 200_000), ["text", "file", "block"]))
    words = (placed.select("text", "file", "block", "seq", "records", (F.col("off") + F.col("run")).alias("at"),
                           F.posexplode("pieces").alias("j", "piece"))
             .withColumn("record", F.col("at") + F.col("j")).filter(F.col("record") < F.col("records"))     # the rest is no record
             .select("text", "record", "file", "block", "seq", F.posexplode(F.split(F.trim(F.regexp_replace("piece", r"\s+", " ")), " "))
                     .alias("k", "word")).filter(F.col("word") != ""))
    words = materialize(words, "judgement-words")
    place = F.struct("file", "block", "seq", "k")
    heads = words.groupBy("text", "record").agg(F.min(F.struct(place.alias("p"), F.col("word").cast("bigint").alias("query_id"))).alias("h"))
    last = (heads.groupBy("h.query_id").agg(F.max(F.struct("text", "record", F.col("h.p").alias("p"))).alias("r"))
            .select("query_id", "r.text", "r.record", F.col("r.p").alias("_head")))
    # a record may hold most of the words: checked and broadcast, or salted by the word
    return (join_small(words.withColumn("_p", place), last, ["text", "record"], spread_col="_p").filter(F.col("_p") != F.col("_head"))
            .select("query_id", F.col("word").cast("bigint").alias("doc_id")))


def read_query_lines(spark: SparkSession, path: str, stop_at_blank: bool = False) -> DataFrame:
    """One query per line, trimmed; query_id = 1-based line number over
    the files in path order.

    Default: blank lines are skipped. ``stop_at_blank=True`` keeps only the
    lines before the first blank one."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.trim("value").alias("text"))
    if stop_at_blank:
        stop = (lines.filter(F.col("text") == "")
                .agg(F.min(F.struct("file", "block", "seq"))).scalar())
        lines = lines.filter(stop.isNull() | (F.struct("file", "block", "seq") < stop))
    else:
        lines = lines.filter(F.col("text") != "")
    return consecutive_ids(lines, "query_id").select("query_id", "text")


def consecutive_ids(df: DataFrame, out_col: str) -> DataFrame:
    """Number rows 1..n in (file, block, seq) order without moving them to one
    task: per-block counts (one row per input split) give every split its
    offset, which is broadcast back; rows are ranked inside their split."""
    counts = df.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "block", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    wp = Window.partitionBy("file", "block").orderBy("seq")
    # one row per input split: broadcast after a row-count check (a very
    # large input falls back to a shuffle join on the split key)
    return (df.withColumn("_r", F.row_number().over(wp))
            .join(broadcast_if_small(offsets, 200_000), ["file", "block"])
            .withColumn(out_col, (F.col("_off") + F.col("_r")).cast("bigint"))
            .drop("_off", "_r"))


def ordered_ids(df: DataFrame, by: str, out_col: str) -> DataFrame:
    """Number rows 1..n in the order of a column, without one task for all: ranges
    of the column are written once, each row with its range and its place in it,
    and counts per range (one row each) give the offsets."""
    ranged = (df.repartitionByRange(by).sortWithinPartitions(by)
              .withColumn("_mono", F.monotonically_increasing_id()))
    # the id is made of the partition (high bits) and the row's place in it
    placed = materialize(ranged.withColumn("_part", F.shiftright("_mono", 33))
                         .withColumn("_place", F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1))).drop("_mono"), "ordered")
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    return (placed.join(broadcast_if_small(offsets, 200_000), "_part")
            .withColumn(out_col, F.col("_off") + F.col("_place") + 1).drop("_part", "_place", "_off"))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, trimmed, blank lines ignored -> (word)."""
    return (spark.read.text(path).select(F.trim("value").alias("word"))
            .filter(F.col("word") != "").distinct())


def run_metric(spark: SparkSession, path: str) -> str | None:
    """The metric and cut that a per-query result CSV names in its header (``query,P@10``),
    None without one. Part files of one report repeat the same header or have none."""
    named = (spark.read.text(path).select(F.trim("value").alias("line")).filter(F.col("line").startswith("query,"))
             .select(F.trim(F.split("line", ",")[1]).alias("metric")).distinct().limit(2).collect())
    if len(named) > 1:
        raise ValueError(f"{path} holds results of several metrics: {named[0][0]}, {named[1][0]}")
    return named[0][0] if named else None


def read_run_csv(spark: SparkSession, path: str, run_id: str | None = None,
                 metric: str | None = None) -> DataFrame:
    """A per-query result CSV -> (run_id, metric, query_id, value). Lines
    starting with ``query``, ``value`` or ``avg`` are headers/summary; the
    second field is the value. Without ``metric`` the header's is taken. Pairing
    with another run is by query id."""
    metric = metric if metric is not None else run_metric(spark, path)
    raw = spark.read.text(path).select(F.col("_metadata.file_name").alias("_f"),
                                       F.trim("value").alias("line"))
    rows = raw.filter(~(F.col("line").startswith("query") | F.col("line").startswith("value")
                        | F.col("line").startswith("avg")) & (F.col("line") != ""))
    parts = F.split("line", ",")
    out = rows.select("_f", parts[0].cast("bigint").alias("query_id"),
                      parts[1].cast("double").alias("value"))
    rid = F.lit(run_id) if run_id is not None else F.col("_f")
    return out.select(rid.alias("run_id"), F.lit(metric).cast("string").alias("metric"),
                      "query_id", "value")
