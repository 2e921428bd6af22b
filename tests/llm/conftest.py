import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])
PROSE = "The quick brown fox jumps over the lazy dog and then it sleeps under a very old tree near a river. "


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""
    def of(rows):
        full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "s")), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return of


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty and very long texts, repeated rows and ids."""
    return make([
        (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (None, PROSE * 3, "en", "b"),
        (4, PROSE * 4000, "en", "a"), (5, PROSE * 3, "en", "a"), (5, PROSE * 3, "en", "a"), (None, None, None, None),
        (6, "x" * 300_000, "en", "b"), (7, PROSE * 2 + "é😀 ñ", "es", "c"), (7, "other text of the same id", "en", "c"),
        (8, "1" * 5_000, "en", "b"), (9, " " * 50_000 + "end", "en", "b")])


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with columns named as the operators name theirs."""
    names = ("size", "target", "copies", "fp", "n", "id", "component_id", "kept", "votes", "quality", "_text", "_row",
             "_words", "row", "piece", "length", "rank", "sequence_id", "start", "spans", "weight", "_source")
    return odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
