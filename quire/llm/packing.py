"""Best-fit packing planned on a histogram of lengths.

Documents become token ids with an end id; those longer than a sequence are cut, the
first piece taking what is left over. Only the number of pieces of each length (at most
one count per possible length) goes to the driver, where best-fit decreasing runs over
counts: a step places many equal pieces in many equal bins at once. The plan is a list
of runs of slots per length. Each piece then takes the slot with its rank within its
length, looked up in the sorted runs.

Scale: texts are read and encoded once, without a shuffle; pieces are a written table of
some 40 bytes a row. Ranks are counted in salted groups (length, salt) with offsets per
salt, so a length that a third of all pieces has is spread over many tasks.

Defined results: null text is empty and packs its end id; repeated rows and null ids are
packed as rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import released
from quire.llm.tokens import coder
from quire.session import materialize, ship_package

SIZE = 1024
ROWS_PER_RANKING = 250_000


def pieces_of(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    if n <= size:
        return [(0, n)]
    first = n % size
    cuts = ([0] if first else []) + list(range(first, n, size))
    return [(a, b - a) for a, b in zip(cuts, cuts[1:] + [n])]


def token_pieces(docs: DataFrame, vocabulary: str, spaced: bool, size: int = SIZE, text_col: str = "text",
                 id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked, ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    ids_type = [pa.list_(pa.int32())] if with_ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(vocabulary, spaced).encode_column
        for batch in batches:
            done = 0
            for some in encode(batch.column(1)):
                cut = [(k, p, a, n, ids[4 * a:4 * (a + n)]) for k, ids in enumerate(some)
                       for p, (a, n) in enumerate(pieces_of(len(ids) // 4, size))]
                owner, piece, start, length, raw = zip(*cut)
                cols = [batch.column(0).take(pa.array(np.array(owner) + done)), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(r, "<i4") for r in raw], *ids_type))
                    names.append("ids")
                done += len(some)
                yield pa.RecordBatch.from_arrays(cols, names)

    ship_package(docs.sparkSession)
    out = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(released(run), out)


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths. Returns runs of slots (length,
    first rank, first bin, pieces per bin, offset in the bin): the piece of rank r of a
    length sits in bin first_bin + (r - first) // per_bin."""
    free: dict[int, list[tuple[int, int]]] = {}      # free space -> runs (first bin, bins)
    spaces: list[int] = []
    slots, bins = [], 0

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in free:
                free[space] = []
                insort(spaces, space)
            free[space].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = free[space].pop()
                if not free[space]:
                    del free[space], spaces[at]
            else:
                space, first, n = size, bins, -(-left // (size // length))
                bins += n
            per_bin = space // length
            filled = min(n, left // per_bin)
            if filled:
                slots.append((length, rank, first, per_bin, size - space))
                put(space - per_bin * length, first, filled)
                rank, left, first, n = rank + filled * per_bin, left - filled * per_bin, first + filled, n - filled
            if n and left and left < per_bin:
                slots.append((length, rank, first, left, size - space))
                put(space - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            put(space, first, n)
    return slots


def ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with a rank within their length, from 0, without a task per length."""
    total = pieces.count()
    salts = max(1, -(-total // ROWS_PER_RANKING)) * 4
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.withColumn("_place", F.row_number().over(inside) - 1)
            .join(firsts, ["length", "_salt"]).withColumn("rank", F.col("_first") + F.col("_place"))
            .drop("_salt", "_first", "_place"))


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Written pieces with their sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = np.array(sorted(plan(counts, size)), dtype=np.int64).reshape(-1, 5)

    @F.arrow_udf("sequence_id long, offset long")
    def slot(length: pa.Array, rank: pa.Array) -> pa.Array:
        n, r = length.to_numpy().astype(np.int64), rank.to_numpy().astype(np.int64)
        # rows of runs before the one whose (length, first rank) is the last at or below
        key = np.searchsorted(starts, n * span + r, side="right") - 1
        _, first, first_bin, per_bin, offset = runs[key].T
        return pa.StructArray.from_arrays([pa.array(first_bin + (r - first) // per_bin),
                                           pa.array(offset + (r - first) % per_bin * n)], ["sequence_id", "offset"])

    span = max(counts.values(), default=0) + 1
    starts = runs[:, 0] * span + runs[:, 1]
    placed = ranked(pieces).withColumn("_slot", slot("length", "rank"))
    return placed.select(*pieces.columns, "_slot.sequence_id", "_slot.offset")


def pack_documents(docs: DataFrame, vocabulary: str, spaced: bool = True, size: int = SIZE, **cols) -> DataFrame:
    """Documents to placed pieces."""
    return pack(materialize(token_pieces(docs, vocabulary, spaced, size, **cols), "packing-pieces"), size)


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences themselves (from pieces with ids): sequence_id, ids. A group holds
    one sequence, so at most ``size`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
