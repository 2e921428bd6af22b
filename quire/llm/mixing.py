"""Mixing sources to target weights.

Words are added up per source, each source gets a target from its weight, and a
source's repetition rate is target / size. A document is emitted floor(rate) times
plus one more copy if its seeded hash falls below the rate's fraction, so the mix is
the same on every run and needs no sampling pass.

Plan: two scans of the text column (totals, then copies), each without a shuffle of
text. Only one row per source is shuffled; a hot source is summed before its shuffle.

Defined results: null text has size 0; null is a source of its own and comes last; a
source or table of size 0 has target 0 and its documents no copies; repeated rows are
separate documents with the same decision; null ids hash as one id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import ROW, WORD, boxed, field, unboxed
from quire.operators.joins import fits_broadcast, salted_join

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 20


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from 52 bits of a hash of the id."""
    digest = F.md5(F.concat(F.lit(f"mix:{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Targets share the total by weight and stop at ``max_repeats`` times the source's
    size; what is over goes to the others by weight until none is above. That fixed
    point is min(cap, level * weight), with one level for all: sources sorted by
    cap / weight, capped ones first, and the level from what is left. One row per
    source in one window; the sums are whole numbers, so the level has one rounding.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    of = F.array(*[F.lit(int(w)) for w in weights])
    ranked = (sizes
              .withColumn("weight", of[(F.row_number().over(by_name) - 1) % F.lit(len(weights))].cast("long"))
              .withColumn("cap", F.col("source_size") * F.lit(max_repeats))
              .withColumn("ratio", F.col("cap").cast("double") / F.col("weight")))
    upto = (Window.orderBy("ratio", F.col("source").asc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = Window.orderBy("ratio").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) - F.sum("cap").over(upto) + F.col("cap")).cast("double")
             / (F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight")))
    return (ranked.withColumn("own_level", level)
            .withColumn("level", F.max(F.when(F.col("own_level") <= F.col("ratio"), F.col("own_level"))).over(whole))
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")))


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS,
             seed: int = SEED, text_col: str = "text", source_col: str = "source",
             id_col: str = "doc_id") -> DataFrame:
    """Boxed rows with size, source_size, target and copies."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(n_words(F.col(text_col))).alias("source_size"))
    targets = source_targets(sizes, weights, max_repeats)
    sized = boxed(docs).select(ROW, n_words(field(text_col)).alias("size"),
                               field(source_col).isNull().alias("_none"),
                               F.coalesce(field(source_col).cast("string"), F.lit("")).alias("_source"))
    targets = targets.select(F.col("source").isNull().alias("_none"),
                             F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
                             "source_size", "target")
    keys = ["_none", "_source"]
    # one row per source: broadcast if counted small, else joined on salted keys
    joined = (sized.join(F.broadcast(targets), keys, "left") if fits_broadcast(sizes)
              else salted_join(sized.withColumn("_spread", F.xxhash64(field(id_col), F.monotonically_increasing_id())), targets,
                               keys, "left", spread_col="_spread"))
    rate = F.when(F.col("source_size") > 0,
                  F.least(F.lit(float(max_repeats)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    once_more = (draw(field(id_col), seed) < rate - F.floor(rate)).cast("long")
    return joined.select(ROW, "size", "source_size", "target", (F.floor(rate).cast("long") + once_more).alias("copies"))


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as given."""
    planned = plan_mix(docs, **params).filter("copies > 0")
    return unboxed(planned.select(ROW, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")))
