"""Directory trees of text files as documents.

``scan_files`` gives one row per file and derives everything else from its path, size
and time. In a folder that every machine mounts (``file:``) tasks list the tree and read
its files, so that the driver holds nothing per file; elsewhere Spark's file source does
it (recursive lookup, ``wholetext``, ``_metadata``), whose driver lists all files. The path
rules (sub-folder units, depth, extension lists) are plain column
expressions, so they apply equally to any table with a path column -- e.g.
URL paths -- via ``path_columns`` / ``filter_paths``.

Rules kept from the replaced indexer:
- ``by_subfolder``: only the immediate sub-directories of the root are units
  of work; files directly in the root are ignored
- ``max_depth``: -1 unlimited, 0 nothing, n = files at most n levels below
  the unit (1 = directly in it)
- ``only_ext`` / ``not_ext``: last extension of the file name, compared
  case-sensitively; if both are given, ``prefer`` says which one applies
- ``content_lines``: first n lines (blank lines counted; 0 = all), stored as
  the bracketed, comma-separated list form ``[l1, l2]``
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.hygiene import java_string_hash
from quire.session import materialize, mounted, ship_package


def path_columns(df: DataFrame, rel_col: str = "rel_path") -> DataFrame:
    """Add segments-derived columns of a relative path: file name, extension,
    subfolder (first segment of a nested path) and depth (1 = directly in
    the root)."""
    seg = F.split(F.col(rel_col), "/")
    name = F.element_at(seg, -1)
    return (df.withColumn("file_name", name)
            .withColumn("ext", F.regexp_extract(name, r"\.([^.]*)$", 1))
            .withColumn("depth", F.size(seg).cast("bigint"))
            .withColumn("subfolder", F.when(F.size(seg) > 1, seg[0])))


def filter_paths(df: DataFrame, by_subfolder: bool = False, max_depth: int = -1,
                 only_ext=None, not_ext=None, prefer: str | None = None) -> DataFrame:
    """S2-S6 on a table produced by ``path_columns``."""
    if only_ext and not_ext:
        if prefer not in ("only", "not"):
            raise ValueError("both extension lists given: pass prefer='only' or prefer='not'")
        if prefer == "only":
            not_ext = None
        else:
            only_ext = None
    out = df
    depth = F.col("depth")
    if by_subfolder:
        out = out.filter(F.col("subfolder").isNotNull())
        depth = depth - 1
    if max_depth == 0:
        return out.limit(0)
    if max_depth > 0:
        out = out.filter(depth <= max_depth)
    norm = lambda xs: sorted({x.lstrip(".") for x in xs})
    if only_ext:
        out = out.filter(F.col("ext").isin(norm(only_ext)))
    if not_ext:
        out = out.filter(~F.col("ext").isin(norm(not_ext)))
    return out


def java_list_lines(text: Column, n: int = 0) -> Column:
    """The text's lines (one final line end removed) as ``[l1, l2, ...]``;
    the first ``n`` lines when n > 0."""
    body = F.regexp_replace(text, r"(\r\n|\r|\n)$", "")
    lines = F.split(body, r"\r\n|\r|\n")
    lines = F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(lines)
    if n > 0:
        lines = F.slice(lines, 1, n)
    return F.concat(F.lit("["), F.array_join(lines, ", "), F.lit("]"))


def time_columns(ts: Column) -> list[Column]:
    """Epoch milliseconds and the two string forms of a timestamp
    (session time zone)."""
    return [
        (F.unix_micros(F.to_timestamp(ts)) / 1000).cast("bigint").alias("modified_ms"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
        F.date_format(ts, "yyyyMMddHHmmssSSS").alias("last_modified_sortable"),
    ]


def scan_files(spark: SparkSession, root: str, by_subfolder: bool = False, max_depth: int = -1,
               only_ext=None, not_ext=None, prefer: str | None = None,
               content_lines: int | None = None, contents_stored: bool = True,
               with_hash: bool = False) -> DataFrame:
    """One row per readable file under ``root``.

    Columns: path, rel_path, file_name, ext, subfolder, depth, size, size_kb,
    modified (timestamp), modified_ms, last_modified, last_modified_sortable,
    partition (S9: the task that read the file), contents (raw, or the list
    form when ``content_lines`` is given), contents_hash (Java string hash,
    with ``with_hash``). Unreadable files are skipped (``ignoreCorruptFiles``).
    """
    def wanted(df: DataFrame) -> DataFrame:
        df = path_columns(df.withColumn("rel_path", _relative(F.col("path"), root)))
        return filter_paths(df, by_subfolder, max_depth, only_ext, not_ext, prefer)

    local = mounted(spark, root)
    if local is not None and os.path.isdir(local) and not re.search(r"[{}\[\]*?\\]", root):
        files = wanted(list_tree(spark, local)).select("path")
        base = read_files(files, contents_stored or with_hash)
    else:
        reader = _reader(spark)
        if only_ext and not (not_ext and prefer == "not"):
            exts = ",".join(sorted({x.lstrip(".") for x in only_ext}))
            reader = reader.option("pathGlobFilter", f"*.{{{exts}}}")   # files never opened
        base = _read_by_spark(reader, root)
    df = wanted(base.withColumn("partition", F.spark_partition_id()))
    text = F.col("_text")
    contents = java_list_lines(text, content_lines) if content_lines is not None else text
    cols = [
        "path", "rel_path", "file_name", "ext", "subfolder", "depth", "size",
        F.floor(F.col("size") / 1024).cast("bigint").alias("size_kb"), "modified",
        *time_columns(F.col("modified")), "partition",
    ]
    if contents_stored:
        cols.append(contents.alias("contents"))
    if with_hash:
        cols.append(java_string_hash(contents).alias("contents_hash"))
    return df.select(*cols)


def _reader(spark: SparkSession):
    return (spark.read.option("recursiveFileLookup", "true")
            .option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true"))


def _read_by_spark(reader, paths: str | list[str]) -> DataFrame:
    """(path, size, modified, _text) by Spark's file source."""
    return reader.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("_text"))


#: Files that a task reads, on average, and bytes of text that it holds at once.
FILES_PER_TASK, BYTES_AT_ONCE = 2_000, 8 << 20


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path): the files below a mounted folder that Spark's file source would read, as
    it writes their paths. Tasks list the folders, one folder of the root each, and the
    names are written once, like a listing that is taken when the scan begins."""
    ship_package(spark)
    top = materialize(spark.createDataFrame([(root,)], "at string").mapInArrow(lambda b: _names(b, False), "path string, folder string"), "tree-top")
    n = spark.sparkContext.defaultParallelism
    below = top.filter(F.col("folder").isNotNull()).select("folder").repartition(n, "folder") \
        .mapInArrow(lambda b: _names(b, True), "path string, folder string")
    return materialize(top.unionByName(below).filter(F.col("path").isNotNull()).select("path"), "tree-files")


def _hidden(name: str) -> bool:
    """Whether Spark's file source leaves a file or folder of this name out of a listing."""
    return (name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")) \
        and not name.startswith(("_common_metadata", "_metadata"))


def _uri(path: str) -> str:
    """A path as ``java.net.URI`` writes it: characters outside ASCII stay, but for control
    characters and spaces."""
    return "file:" + re.sub(r"[^\x00-\x7f]+|[\x00-\x7f]+", lambda m: quote(m[0], "/-_.!~'()*,;:$&+=@") if m[0][0] < "\x80" else "".join(
        quote(c) if unicodedata.category(c) in ("Cc", "Zs", "Zl", "Zp") else c for c in m[0]), path)


def _names(batches, deep: bool):
    """Rows (path, null) of the files in the given folders and, if ``deep``, in those below;
    otherwise these folders as rows (null, folder). Links are followed."""
    def rows(files, folders):
        return pa.RecordBatch.from_arrays([pa.array(files + [None] * len(folders), pa.string()),
                                           pa.array([None] * len(files) + folders, pa.string())], ["path", "folder"])
    for batch in batches:
        for top in batch.column(0).to_pylist():
            todo, files, folders = [top], [], []
            while todo:
                try:
                    entries = os.scandir(todo.pop())
                except FileNotFoundError:
                    continue
                with entries:
                    for e in entries:
                        # what Java cannot name, or Hadoop not open, was never read
                        if _hidden(e.name) or not e.name.isascii() and e.name.encode(errors="ignore") != os.fsencode(e.name):
                            continue
                        if e.is_dir():
                            (todo if deep else folders).append(e.path)
                        elif not e.name.startswith("_") or "=" in e.name:
                            if ":" not in e.name:
                                files.append(_uri(e.path))
                        if len(files) + len(folders) >= 50_000:
                            yield rows(files, folders)
                            files, folders = [], []
            yield rows(files, folders)


def read_files(files: DataFrame, with_text: bool) -> DataFrame:
    """(path, size, modified, _text): files of mounted folders, read by tasks, each by one.
    Empty and unreadable ones are left out. Compressed ones are read by Spark, as the codecs
    are Hadoop's."""
    spark = files.sparkSession
    n = max(1, min(files.count(), max(spark.sparkContext.defaultParallelism, files.count() // FILES_PER_TASK)))
    coded = F.lower("path").rlike("(" + "|".join(re.escape(x) for x in _codec_endings(spark)) + ")$")
    packed = [unquote(r["path"][5:]) for r in files.filter(coded).collect()]   # few, if any
    rows = files.filter(~coded).repartition(n, "path").mapInArrow(
        lambda batches: _contents(batches, with_text), "path string, size bigint, ms bigint, bytes binary")
    rows = rows.select("path", "size", F.timestamp_millis("ms").alias("modified"), F.col("bytes").cast("string").alias("_text"))
    if packed:
        # read whole, and by name: a file is not looked for below another
        rows = rows.unionByName(_read_by_spark(_reader(spark).option("__globPaths__", "false"), [f"file:{x}" for x in packed]))
    return rows


def _codec_endings(spark: SparkSession) -> list[str]:
    """Endings of the names of files that Hadoop decompresses."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return [jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in codecs]


def _contents(batches, with_text: bool):
    """A row per file that can be read. All are read, whether their text is asked for or not."""
    fields = ["path", "size", "ms", "bytes"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
    rows, held = [], 0

    def made():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, kinds, strict=True)], fields)
    for batch in batches:
        for path in batch.column(0).to_pylist():
            at = unquote(path[5:])
            try:
                with open(at, "rb") as f:
                    st, data = os.fstat(f.fileno()), f.read()
                if not data or not _sound(at, data):
                    continue
            except OSError:
                continue
            rows.append((path, st.st_size, st.st_mtime_ns // 1_000_000, data if with_text else None))
            held += len(data) if with_text else 0
            if held >= BYTES_AT_ONCE or len(rows) >= 10_000:
                yield made()
                rows, held = [], 0
    yield made()


def _sound(path: str, data: bytes) -> bool:
    """Whether a file agrees with the checksums that Hadoop has written beside it, if it has."""
    folder, name = os.path.split(path)
    try:
        with open(os.path.join(folder, f".{name}.crc"), "rb") as f:
            sums = f.read()
    except OSError:
        return True
    size = int.from_bytes(sums[4:8], "big")
    if sums[:4] != b"crc\0" or not size:
        return True
    return all(zlib.crc32(data[i:i + size]).to_bytes(4, "big") == sums[8 + 4 * k:12 + 4 * k] for k, i in enumerate(range(0, len(data), size)))


def _relative(path: Column, root: str) -> Column:
    """Path relative to ``root`` (scheme and authority ignored)."""
    r = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", root.rstrip("/"))
    absolute = F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    return F.regexp_replace(absolute, "^" + re.escape(r) + "/", "")
