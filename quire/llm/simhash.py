"""SimHash near-duplicates: a binary trie joined with itself.

Fingerprints are 64-bit SimHashes of word shingles. Two of them that differ in at most
``bits`` places agree on one of ``bits + 1`` equal blocks, so every fingerprint is put,
once per block, under the trie node that this block's value names (its bits first).
Each such sub-trie is then joined with itself in one task: pairs of nodes are walked
down together, differing bits add up, and a pair goes as soon as the error budget is
exceeded. The walk is over ranges of a sorted array, many sub-tries at once, with a
stack of bounded slices of the frontier.

Scale: equal texts fall together before anything is joined (one row per fingerprint,
combined before the shuffle). A sub-trie with more than ``hot`` distinct fingerprints
is split by a second block of its remaining bits, by the same argument, so that it is
walked in many tasks. A task gives back a spanning forest of what it linked, never all
pairs: at most one row per fingerprint that it holds. Components are found by
large-star / small-star rounds over written tables; each keeps its sums of rows.

Defined results: null text is empty, and texts without words have fingerprint 0, linked
like any other; ids may be null (they never name a component that has another id) or
repeated; rows equal in all columns are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ROW, boxed, field, in_slices, unboxed
from quire.operators.joins import broadcast_if_small
from quire.session import materialize, ship_package

SHINGLE = 3
BITS = 3
SEED = 42
WIDTH = 64
HASHES_AT_ONCE = 1 << 17
FRONTIER = 1 << 18
#: Fingerprints of a task of the walk, about.
WALKED = 400_000


# ---------------------------------------------------------------- fingerprints

def shingle_hashes(text: bytes, size: int) -> Iterator[list[int]]:
    """XXH64 of every shingle of a text, some at a time. ASCII capitals are lowered;
    white space within a shingle counts as one space."""
    words = text.lower().split()
    if not words:
        return
    if len(words) <= size:
        yield [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
        return
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1)).tolist()
    stops = ends[size - 1:].tolist()
    for i in range(0, len(starts), HASHES_AT_ONCE):
        yield [xxhash.xxh64_intdigest(flat[a:b], SEED)
               for a, b in zip(starts[i:i + HASHES_AT_ONCE], stops[i:i + HASHES_AT_ONCE])]


def bit_counts(hashes: list[int], cuts: list[int]) -> np.ndarray:
    """For each run of hashes (cuts: where runs begin) how many set each bit."""
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.add.reduceat(np.unpackbits(raw, axis=1, bitorder="little"), cuts, axis=0, dtype=np.int32)


def fingerprints_of(texts: list[bytes | None], size: int) -> np.ndarray:
    """Signed 64-bit fingerprints. Hashes of many texts are counted together."""
    sums, total = np.zeros((len(texts), WIDTH), np.int64), np.zeros(len(texts), np.int64)
    held: list[int] = []
    cuts: list[int] = []
    owners: list[int] = []

    def count() -> None:
        if held:
            np.add.at(sums, owners, bit_counts(held, cuts))
            held.clear(), cuts.clear(), owners.clear()

    for i, text in enumerate(texts):
        for part in shingle_hashes(text or b"", size):
            cuts.append(len(held))
            owners.append(i)
            held += part
            total[i] += len(part)
            if len(held) >= HASHES_AT_ONCE:
                count()
    count()
    over = 2 * sums > total[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<i8").ravel()


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    @F.arrow_udf("long")
    def of(column: pa.Array) -> pa.Array:
        return in_slices(lambda some: pa.array(fingerprints_of(some.cast(pa.binary()).to_pylist(), size)), column)
    return of(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------------------- trie self-join

def turned(values: np.ndarray, start: int, width: int) -> np.ndarray:
    """The ``width`` bits from bit ``start`` (of 64, from the top) come first; the
    others follow in their order."""
    v = values.astype(np.uint64)
    if start == 0:
        return v
    u = np.uint64
    block = (v << u(start)) >> u(WIDTH - width)
    head = v >> u(WIDTH - start)
    tail_bits = WIDTH - start - width
    tail = v & u((1 << tail_bits) - 1)
    return (block << u(WIDTH - width)) | (head << u(tail_bits)) | tail


def roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = parent[up]


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of many pairs at once; the smaller index becomes the root."""
    while a.size:
        a, b = roots(parent, a), roots(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        if a.size:
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(parent, hi, lo)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def join_tries(values: np.ndarray, starts: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Join sub-tries with themselves. ``values`` are sorted within sub-tries, which begin
    at ``starts`` and agree on their first ``depth`` bits. Returns each value's root:
    an index that is the same for all that links within the budget connect here."""
    n = len(values)
    parent = np.arange(n)
    ones: dict[int, np.ndarray] = {}

    def split(lo: np.ndarray, hi: np.ndarray, d: int) -> np.ndarray:
        """Where the bit at depth d turns to 1 in each range."""
        if d not in ones:
            bit = (values >> np.uint64(WIDTH - 1 - d)) & np.uint64(1)
            ones[d] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        c = ones[d]
        return hi - (c[hi] - c[lo])

    lo, hi = starts, np.append(starts[1:], n)
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), np.int16))]
    while stack:
        d, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            stack.append((d, *(x[half:] for x in (alo, ahi, blo, bhi, err))))
            alo, ahi, blo, bhi, err = (x[:half] for x in (alo, ahi, blo, bhi, err))
            stack.append((d, alo, ahi, blo, bhi, err))
            continue
        # two single leaves: the rest of both paths is one edge, its differing bits add up
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            x, y = alo[single], blo[single]
            near = popcount(values[x] ^ values[y]) <= budget
            unite(parent, x[near], y[near])
            alo, ahi, blo, bhi, err = (z[~single] for z in (alo, ahi, blo, bhi, err))
        if not len(alo) or d >= WIDTH:
            continue
        am, bm = split(alo, ahi, d), split(blo, bhi, d)
        own = (alo == blo) & (ahi == bhi)
        new = []
        for (pl, ph), (ql, qh), more in (((alo, am), (blo, bm), 0), ((am, ahi), (bm, bhi), 0),
                                         ((alo, am), (bm, bhi), 1), ((am, ahi), (blo, bm), 1)):
            keep = (ph > pl) & (qh > ql) & (err + more <= budget)
            if more and pl is am:
                keep &= ~own                     # the mirror image of the pair before
            if not more:
                keep &= ~(own & (ph - pl == 1))  # a leaf with itself
            new.append((pl[keep], ph[keep], ql[keep], qh[keep], err[keep] + np.int16(more)))
        stack.append((d + 1, *(np.concatenate(z) for z in zip(*new))))
    return roots(parent, np.arange(n))


def block_of(fp: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(F.shiftleft(fp, start), WIDTH - width) if start else \
        F.shiftrightunsigned(fp, WIDTH - width)


def _walk(budget: int, width: int, sub: int):
    """Join all sub-tries of a partition: (block, second, fp) rows to forest edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches]
        if not got:
            return
        block, second, fps = (np.concatenate(x) for x in zip(*got))
        for j in np.unique(block):
            for s in np.unique(second[block == j]):
                fp = fps[(block == j) & (second == s)]
                value = turned(fp.view(np.uint64), int(j) * width, width)
                depth = width
                if s >= 0:                       # a split sub-trie: its second block comes next
                    rest = turned(value << np.uint64(width), int(s) * sub, sub) >> np.uint64(width)
                    value = (value & ~np.uint64((1 << (WIDTH - width)) - 1)) | rest
                    depth = width + sub
                order = np.argsort(value, kind="stable")
                value, fp = value[order], fp[order]
                top = value >> np.uint64(WIDTH - depth)
                starts = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))
                root = join_tries(value, starts, depth, budget)
                linked = root != np.arange(len(fp))
                if linked.any():
                    yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], ["a", "b"])
    return run


def links(distinct: DataFrame, bits: int = BITS, hot: int = 20_000) -> DataFrame:
    """Edges (a, b) among distinct fingerprints ``fp`` that connect exactly those that
    links of at most ``bits`` differing bits connect."""
    if bits != 3:
        raise ValueError("blocks are laid out for 3 differing bits")
    width, sub = WIDTH // (bits + 1), (WIDTH - WIDTH // (bits + 1)) // (bits + 1)
    spark = distinct.sparkSession
    blocks = range(bits + 1)
    keyed = distinct.select("fp", F.posexplode(F.array(*[block_of(F.col("fp"), j * width, width) for j in blocks]))
                            .alias("block", "node"))
    crowded = (keyed.groupBy("block", "node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot)
               .select("block", "node", F.lit(True).alias("crowded")))
    marked = keyed.join(crowded, ["block", "node"], "left")
    # the bits after the first block, in the order that the walk gives them
    after = [_rest_column(F.col("fp"), j * width, width) for j in blocks]
    tail = F.element_at(F.array(*after), F.col("block") + 1)
    second = F.array(*[F.shiftrightunsigned(tail, WIDTH - width - (s + 1) * sub).bitwiseAND(F.lit((1 << sub) - 1))
                       for s in blocks])
    once = marked.filter(F.col("crowded").isNull()).select("block", F.lit(-1).alias("second"), "node",
                                                          F.lit(-1).cast("long").alias("deep"), "fp")
    split = marked.filter("crowded").select("block", "node", "fp", F.posexplode(second).alias("second", "deep")) \
        .select("block", "second", "node", "deep", "fp")
    # a task holds one partition's fingerprints: as many partitions as that takes
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(bits + 1) * distinct.count() // WALKED), 1)
    dealt = once.unionByName(split).repartition(parts, "block", "second", "node", "deep")
    return dealt.select(F.col("block").cast("long"), F.col("second").cast("long"), "fp") \
        .mapInArrow(_walk(bits, width, sub), "a long, b long")


def _rest_column(fp: Column, start: int, width: int) -> Column:
    """The bits other than [start, start + width) as a number of 64 - width bits."""
    tail_bits = WIDTH - start - width
    tail = fp.bitwiseAND(F.lit((1 << tail_bits) - 1))
    head = F.shiftrightunsigned(fp, WIDTH - start) if start else F.lit(0).cast("long")
    return F.shiftleft(head, tail_bits).bitwiseOR(tail)


# ------------------------------------------------------------------ components

def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, root), the root being the smallest node reachable.

    Large-star and small-star rounds: every node points its neighbours to the smallest
    one it knows. Smallest neighbours are found by an aggregate that combines before
    its shuffle and joined back, so no task holds a neighbour list; a hot centre's rows
    can be split by the adaptive join. Every round is a written table.
    """
    pairs = materialize(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                        .filter("hi != lo").distinct(), "simhash-edges")
    seen = None
    while True:
        stamp = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if stamp == seen or not stamp[0]:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = stamp
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.filter("hi != lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.explode(F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*")
        pairs = materialize(small.filter("hi != lo").distinct(), "simhash-edges")


def classes(prints: DataFrame, bits: int = BITS, hot: int = 20_000) -> DataFrame:
    """(fp, id) rows -> one row per distinct fp: (fp, component_id), the smallest id
    reachable through links, and fp_root, the same for all of a component."""
    ship_package(prints.sparkSession)
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("id")), "simhash-distinct")
    nodes = components(links(distinct, bits, hot))
    rooted = distinct.join(nodes, distinct.fp == nodes.node, "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("fp_root"))
    named = rooted.groupBy("fp_root").agg(F.min("id").alias("component_id"))
    return rooted.join(named, "fp_root").select("fp", "fp_root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, text_col: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """Per row: id, fp, component_id."""
    ship_package(docs.sparkSession)
    prints = materialize(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")),
                         "simhash-prints")
    return prints.join(classes(prints, bits).drop("fp_root"), "fp").select("id", "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, text_col: str = "text",
                id_col: str = "doc_id") -> DataFrame:
    """One document of each component stays: that with the smallest id (null ids last;
    of rows with the same id, the one that the written table holds first). The numbers
    of the rows that go are a written table; checked to be few they are broadcast, so
    that texts are not shuffled."""
    ship_package(docs.sparkSession)
    rows = materialize(boxed(docs).select(ROW, fingerprint(field(text_col), shingle).alias("fp"),
                                          field(id_col).alias("id"),
                                          F.monotonically_increasing_id().alias("n")), "simhash-rows")
    thin = rows.select("fp", "id", "n")
    found = materialize(classes(thin, bits), "simhash-classes")
    # the first row of every component: combined before its shuffle, a hot component is one row per task
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n")).alias("first")
    stays = thin.groupBy("fp").agg(first).join(found, "fp").groupBy("fp_root").agg(F.min("first").alias("first"))
    kept = stays.select(F.col("first.n").alias("n"))
    gone = materialize(thin.select("n").join(kept, "n", "left_anti"), "simhash-gone")
    return unboxed(rows.join(broadcast_if_small(gone), "n", "left_anti"))
