"""Join strategy helpers: size-checked broadcast and salted shuffle joins.

A side is broadcast only after its rows and bytes are checked against bounds;
beyond them the join is shuffled, and a key that may hold a large share of the
rows (a frequent term) is salted so that no single task receives it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows we are willing to ship to every executor. Query-side tables (terms of
# a query batch, stop lists) are far below this. Override per session with
# the setting ``quire.broadcast.maxRows``.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
CONF_MAX_ROWS = "quire.broadcast.maxRows"
# Bytes of their strings and 16 for every other value (a keyword term or a
# passage may be a whole document). Setting ``quire.broadcast.maxBytes``.
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
CONF_MAX_BYTES = "quire.broadcast.maxBytes"


def max_broadcast_rows(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(CONF_MAX_ROWS, None)
    return int(v) if v is not None else DEFAULT_MAX_BROADCAST_ROWS


def max_broadcast_bytes(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(CONF_MAX_BYTES, None)
    return int(v) if v is not None else DEFAULT_MAX_BROADCAST_BYTES


def row_bytes(df: DataFrame):
    """Column: about how many bytes a row takes."""
    sizes = [F.lit(0)]
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)) + 16)
        elif kind.startswith(("array", "map", "struct")):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        else:
            sizes.append(F.lit(16))
    return reduce(lambda x, y: x + y, sizes).cast("bigint")


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Checked bound: one job over at most max_rows + 1 rows of a query-side
    table (``limit`` stops it early on a large one) counts rows and bytes."""
    max_rows = max_broadcast_rows(df) if max_rows is None else max_rows
    n, size = df.select(row_bytes(df).alias("b")).limit(max_rows + 1) \
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return n <= max_rows and size <= max_broadcast_bytes(df)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def salted_join(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner",
                salts: int = 32, spread_col: str | None = None) -> DataFrame:
    """Shuffle join that splits every key into ``salts`` sub-keys.

    ``big`` rows get a salt from a hash of ``spread_col`` (default: of all its
    columns), so ids of any type and pattern spread evenly; ``small`` is replicated once per salt. A hot key therefore
    lands on ``salts`` tasks instead of one. Only inner/left joins from the big
    side are meaningful here.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError("a salted join preserves the big (left) side only")
    keys = [on] if isinstance(on, str) else list(on)
    spread = F.xxhash64(*[F.col(c) for c in ([spread_col] if spread_col else big.columns)])
    big_s = big.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    small_s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big_s.join(small_s, keys + ["_salt"], how).drop("_salt")


#: Rows of a key that one task is given, where the number of a key's rows is known.
DEFAULT_ROWS_PER_SALT = 4_000_000
CONF_ROWS_PER_SALT = "quire.join.rowsPerSalt"


def counted_join(big: DataFrame, small: DataFrame, key: str, rows_of: str, spread_col: str) -> DataFrame:
    """Inner shuffle join where ``small`` knows how many rows of ``big`` each key has
    (``rows_of``): a key is split into as many sub-keys as its rows need, others are left
    whole. The split keys are few, at most the rows of ``big`` by the rows of a task; should
    they still be too many to broadcast, every key is split evenly."""
    per = int(big.sparkSession.conf.get(CONF_ROWS_PER_SALT, None) or DEFAULT_ROWS_PER_SALT)
    salts = F.greatest(F.lit(1), F.ceil(F.col(rows_of) / per)).cast("int")
    split = small.filter(F.col(rows_of) > per).groupBy(key).agg(F.max(salts).alias("_k"))
    if not fits_broadcast(split):
        return salted_join(big, small, key, spread_col=spread_col)
    dealt = big.join(F.broadcast(split), key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_col), F.coalesce("_k", F.lit(1))).cast("int")).drop("_k")
    return dealt.join(small.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))), [key, "_salt"]).drop("_salt")


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner",
               max_rows: int | None = None, salts: int = 32,
               spread_col: str | None = None) -> DataFrame:
    """Join a large table with a usually-small one: broadcast when the small
    side is proven small, otherwise a salted shuffle join."""
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, salts=salts, spread_col=spread_col)


def join_hot_cold(big: DataFrame, dim: DataFrame, on: str, hot: "Column") -> DataFrame:
    """Inner join of a large table with a large dimension on a skewed key.

    ``hot`` marks the dimension rows whose key is frequent in ``big`` (for
    terms: a document frequency above a share of the corpus). There are few
    such keys, so they are broadcast (size-checked; salted otherwise) and
    joined map-side; only rows of the remaining, individually small keys are
    shuffled. No key with a large share of ``big`` ever reaches one task.
    """
    hot_dim = dim.filter(hot)
    cold_dim = dim.filter(~hot)
    hot_part = join_small(big, hot_dim, on)
    # beyond the bound the hot keys are salted here too: a plain anti join would send each
    # of them to one task
    cold_big = join_small(big, hot_dim.select(on), on, "left_anti")
    return hot_part.unionByName(cold_big.join(cold_dim, on))
