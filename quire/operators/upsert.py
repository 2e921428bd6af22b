"""Keyed upserts of a document table (K2, D3).

The replaced indexer meant "a document with the same key replaces the old
one". Here: the newest update per key wins (a maximum over an ordering
column, a partial aggregate), the old rows with an updated key are removed
with an anti join, and the new rows are appended. The result is written to a
*new* location by the caller; a table is never overwritten while it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(updates: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``order_col``; among equal ones
    (and without ``order_col``) the greatest row, column by column."""
    cols = [c for c in updates.columns if c != key]
    packed = F.struct(*[F.col(c) for c in cols])
    first = [F.col(order_col).alias("_o")] if order_col else []
    return (updates.groupBy(key).agg(F.max(F.struct(*first, packed.alias("_p"))).alias("_r"))
            .select(key, *[F.col(f"_r._p.{c}").alias(c) for c in cols]))


def upsert(old: DataFrame, updates: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """K2: old rows whose key is not replaced, plus the winning update per key.

    With ``order_col`` the newest update per key is taken first; when the old
    table carries ``order_col`` too, an update replaces an old row only if it
    is not older (so batches may arrive in any order). Without it a key that the
    updates repeat keeps its greatest row. The updated keys are size-checked: they
    are broadcast into the scan of the old table, or else both are shuffled by key."""
    from quire.operators.joins import broadcast_if_small, join_small

    new = latest_per_key(updates, key, order_col)
    if order_col and order_col in old.columns:
        prev = old.select(key, F.col(order_col).alias("_prev"))
        stale = (join_small(prev, new.select(key, order_col), key, "inner")
                 .filter(F.col("_prev") > F.col(order_col)).select(key))
        new = new.join(broadcast_if_small(stale), key, "left_anti")
    elif order_col:
        new = new.drop(order_col)
    keys = broadcast_if_small(new.select(key))
    return old.join(keys, key, "left_anti").unionByName(new.select(*old.columns))
