"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.tokens import forget_pieces

#: ASCII white space; the complement makes words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

ROW = "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def boxed(df: DataFrame) -> DataFrame:
    """The whole row as one struct column, so that columns which an operator adds
    can't clash with columns that the table happens to have."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW))


def field(name: str) -> Column:
    """A column of a boxed row."""
    return F.col(f"{ROW}.`{name}`")


def unboxed(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, also where ``body``
    uses it inside a lambda (where a plain column would be computed per element)."""
    return F.transform(F.array(value), body)[0]


def in_slices(of: Callable[..., pa.Array], *columns: pa.Array, rows: int = 256) -> pa.Array:
    """``of`` applied to a few rows of columns at a time, so that what it makes of them in
    Python does not add up over a batch. It is for stages that encode no tokens: pieces that
    the worker remembers from one that did are given back."""
    forget_pieces()
    parts = [of(*[x.slice(i, rows) for x in columns]) for i in range(0, max(len(columns[0]), 1), rows)]
    return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function over batches that gives freed Arrow memory back when it is done."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return of
