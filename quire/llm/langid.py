"""Language identification by nearest centroids.

A text is a normalised TF-IDF vector of hashed character 1- to 3-grams of its lower-cased
letters. The labelled documents of each language are clustered into a few centroids, and
a text gets the language of the centroid with the largest cosine. A text whose cosine is
below what the members of that centroid show is marked as rejected.

Fitting uses a bounded sample of labelled rows (``per_language`` documents of each
language, fewer where ``MAX_SAMPLE`` in all would be exceeded, chosen by a hash of the id after a count per language, so it is the same on
every run); vectors of the sample are made by tasks and clustered in numpy. The document
frequencies of IDF are those of the same sample, not of all rows. The model is
``dims`` numbers per centroid, at most ``MAX_CENTROIDS`` of them: with more languages each
has fewer centroids and rows of the sample, down to one centroid, and beyond that number
the most frequent languages are learned. It travels with the tasks. Predicting reads every whole text once, without a shuffle.

Defined results: null texts and texts without letters are "und" with score 0, as is
everything when nothing is labelled; rows with null id or language are not learned from;
ties go to the language that comes first.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.joins import broadcast_if_small
from quire.session import ship_package

DIMS = 1 << 13
PER_LANGUAGE = 400
#: Over all languages: 16 kB a row on the driver.
MAX_SAMPLE = 8000
CLUSTERS = 4
#: Over all languages, and so the languages that are learned: 32 kB a centroid.
MAX_CENTROIDS = 1600
ROUNDS = 15
SEED = 7
FOLDS, HELD_OUT = 3, 1
AT_ONCE = 128


# ------------------------------------------------------------------- features

@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_bins(text: str, dims: int) -> np.ndarray | None:
    """Bins of all 1- to 3-grams of a text: letters in lower case, anything between
    them as one space. None without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[codes]
    if not letter.any():
        return None
    shown = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]                      # the first place after letters is the space
    body = shown[keep].astype(np.uint32)
    c = np.concatenate(([32], body, [32])).astype(np.uint32)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    return np.concatenate((one[1:-1] >> shift, two >> shift, three >> shift))


def weights(text: str | None, dims: int) -> np.ndarray | None:
    """1 + log of counts per bin."""
    bins = gram_bins(text, dims) if text else None
    if bins is None:
        return None
    n = np.bincount(bins, minlength=dims).astype(np.float32)
    return np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0).astype(np.float32)


def normalised(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(size > 0, size, 1)).astype(np.float32)


# ---------------------------------------------------------------------- model

class Model:
    def __init__(self, languages: list[str], idf: np.ndarray, centroids: np.ndarray, owner: np.ndarray, least: np.ndarray):
        self.languages, self.idf, self.centroids, self.owner, self.least = languages, idf, centroids, owner, least

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        dims = len(self.idf)
        rows = [weights(t, dims) for t in texts]
        out: list[tuple[str, float, bool]] = [("und", 0.0, False)] * len(texts)
        some = [i for i, w in enumerate(rows) if w is not None]
        if not some or not len(self.owner):
            return out
        near = normalised(np.stack([rows[i] for i in some]) * self.idf) @ self.centroids.T
        best = near.argmax(1)
        for i, b, s in zip(some, best, near[np.arange(len(some)), best]):
            out[i] = (self.languages[self.owner[b]], float(min(max(s, 0.0), 1.0)), bool(s < self.least[b]))
        return out


def clustered(x: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids and each row's one. Seeds are spread out, each the
    row that is least like the seeds before it."""
    rng = np.random.default_rng(seed)
    centres = x[[rng.integers(len(x))]]
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[[(x @ centres.T).max(1).argmin()]]])
    for _ in range(ROUNDS):
        own = (x @ centres.T).argmax(1)
        sums = np.stack([x[own == c].sum(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = normalised(sums)
    return centres, (x @ centres.T).argmax(1)


def fit_vectors(languages: list[str], x: np.ndarray, label: np.ndarray, clusters: int, seed: int) -> Model:
    """Model of a sample's weights (rows) and labels (indexes into languages)."""
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    v = normalised(x * idf)
    centroids, owner, least = [], [], []
    for k in range(len(languages)):
        own = v[label == k]
        centres, member = clustered(own, clusters, seed)
        for c in range(len(centres)):
            near = own[member == c] @ centres[c]
            if len(near):
                centroids.append(centres[c])
                owner.append(k)
                least.append(near.mean() - 4 * near.std() - 0.05)
    return Model(languages, idf, np.array(centroids, np.float32), np.array(owner), np.array(least))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, text_col: str, lang_col: str, id_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` labelled, not held-out rows (text, lang) per language."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id")) \
        .filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # the most frequent languages, as many as the model has centroids for
    counts = counts.orderBy(F.desc("n"), "lang").limit(MAX_CENTROIDS)
    per_language = min(per_language, MAX_SAMPLE // max(counts.count(), 1))
    # a hash bound first, so that few more rows than wanted are moved; then the exact cut
    place = F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    near = rows.join(broadcast_if_small(counts), "lang").withColumn("place", place) \
        .filter(F.col("place") * F.col("n") < per_language + 6 * per_language ** 0.5 + 10)
    first = Window.partitionBy("lang").orderBy("place", "id")
    return near.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= per_language).select("text", "lang", "r")


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", dims: int = DIMS,
        per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS, seed: int = SEED) -> Model:
    ship_package(docs.sparkSession)

    @F.arrow_udf("binary")
    def vector(texts: pa.Array) -> pa.Array:
        made = (weights(t.as_py(), dims) for t in texts)
        return pa.array([None if w is None else w.astype(np.float16).tobytes() for w in made], pa.binary())

    chosen = sample(docs, text_col, lang_col, id_col, per_language)
    got = sorted(((r["lang"], r["r"], r["v"]) for r in chosen.select("lang", "r", vector("text").alias("v"))
                  .filter("v is not null").collect()))
    languages = sorted({lang for lang, _, _ in got})
    x = np.frombuffer(b"".join(v for _, _, v in got), np.float16).reshape(-1, dims).astype(np.float32)
    place = {lang: k for k, lang in enumerate(languages)}
    label = np.array([place[lang] for lang, _, _ in got], dtype=int)
    clusters = max(1, min(clusters, MAX_CENTROIDS // max(len(languages), 1)))
    return fit_vectors(languages, x, label, clusters, seed)


def predicted(text: Column, model: Model) -> Column:
    """Struct of lang_pred, score and rejected."""
    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def of(texts: pa.Array) -> pa.Array:
        out = [p for i in range(0, len(texts), AT_ONCE) for p in model.predict(texts.slice(i, AT_ONCE).to_pylist())]
        kinds = (pa.string(), pa.float64(), pa.bool_())
        return pa.StructArray.from_arrays([pa.array([p[k] for p in out], t) for k, t in enumerate(kinds)],
                                          ["lang_pred", "score", "rejected"])
    return of(text)


def identify(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       predicted(F.col(text_col), model).alias("_p")).select("doc_id", "held_out", "_p.*")
