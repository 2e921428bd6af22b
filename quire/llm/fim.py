"""Fill-in-the-middle: texts cut in three and dealt anew between marks.

Where to cut is drawn in code points by a seeded hash of the id; texts are UTF-8. An
exception index of a batch of texts holds only their characters of more than one byte:
the position of each and how many excess bytes precede it. A binary search among these
turns code-point cuts into byte cuts and back; between two exceptions both counts run
alike, so a text of ASCII alone costs arithmetic. Texts are then cut and joined as bytes.

Each text is handled whole inside its task, with a batch of texts at a time; nothing is
shuffled. Defined results: null or empty text is plain and empty; null ids draw as the id
"null"; rows that repeat an id and a length are cut alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ROW, boxed, field, in_slices
from quire.session import ship_package

MARKS = ("<P>", "<S>", "<M>")
SEED = 1
#: Of 100 documents so many are cut; of 100 cut ones so many take the suffix first.
CUT, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"


class Exceptions:
    """Characters of more than one byte in UTF-8 bytes: ``byte`` and ``point`` are where
    they begin, ``excess[i]`` how many bytes beyond one each the first i take."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        more = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(more)))
        self.point = self.byte - self.excess[:-1]

    def points(self, at: np.ndarray) -> np.ndarray:
        """Code points before byte positions (of character beginnings)."""
        return at - self.excess[np.searchsorted(self.byte, at)]

    def bytes(self, at: np.ndarray) -> np.ndarray:
        """Bytes before code-point positions."""
        return at + self.excess[np.searchsorted(self.point, at)]


def utf8(texts: pa.Array) -> tuple[np.ndarray, memoryview, np.ndarray]:
    """Where texts begin and end in their buffer, the buffer, and its bytes from the
    first beginning to the last end. Nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    whole = memoryview(data if data is not None else b"")
    return cuts, whole, np.frombuffer(whole, np.uint8)[cuts[0]:cuts[-1]]


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers drawn for an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformed(text: Column, draw: list[Column], cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> Column:
    """Struct of n, form, prefix_chars, middle_chars and output."""
    kinds = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(),
             "output": pa.string()}

    @F.arrow_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def of(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        return in_slices(some, texts, h1, h2, h3, h4)

    def some(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        ends, whole, data = utf8(texts)
        odd = Exceptions(data)
        ends = ends - ends[0]
        begin, end = ends[:-1], ends[1:]
        first = odd.points(begin)
        n = odd.points(end) - first
        a, b, c, d = (h.to_numpy() for h in (h1, h2, h3, h4))
        one, two = a % (n + 1), b % (n + 1)
        cuts = np.stack([np.minimum(one, two), np.maximum(one, two)])
        byte = odd.bytes(first + cuts)
        marked = np.zeros(len(texts), bool)
        for mark in MARKS:
            found = pc.match_substring(pc.fill_null(texts, ""), mark)
            marked |= found.to_numpy(zero_copy_only=False)
        plain = (n == 0) | marked | (c % 100 >= cut)
        spm = ~plain & (d % 100 < suffix_first)
        p, s, m = (x.encode() for x in MARKS)
        base = memoryview(data)
        out = []
        for is_plain, is_spm, x, i, j, y in zip(plain.tolist(), spm.tolist(), begin.tolist(), *byte.tolist(), end.tolist()):
            if is_plain:
                out.append(bytes(base[x:y]))
            elif is_spm:
                out.append(b"".join((s, base[j:y], p, base[x:i], m, base[i:j])))
            else:
                out.append(b"".join((p, base[x:i], s, base[j:y], m, base[i:j])))
        form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
        cols = [pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(cuts[0], mask=plain),
                pa.array(cuts[1] - cuts[0], mask=plain), pa.array(out, pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays([x.cast(t) for x, t in zip(cols, kinds.values())], list(kinds))
    return of(text, *draw)


def restored(output: Column, form: Column) -> Column:
    """Struct of the text that an output was made of, prefix_chars and middle_chars, read
    from the output and its form alone. No mark can arise where a text meets a mark, so
    the first of each kind is the one that was put in."""
    @F.arrow_udf("text string, prefix_chars long, middle_chars long")
    def of(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return in_slices(some, outputs, forms)

    def some(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        ends, _, data = utf8(outputs)
        odd = Exceptions(data)
        ends = (ends - ends[0]).tolist()
        p, s, m = (x.encode() for x in MARKS)
        texts, spans = [], []
        for kind, x, y in zip(forms.to_pylist(), ends, ends[1:]):
            raw = data[x:y].tobytes()
            if kind == PLAIN:
                texts.append(raw)
                spans.append((0, 0, 0, 0))
                continue
            one, two = (raw.find(p), raw.find(m)) if kind == SPM else (raw.find(s), raw.find(m))
            head, body = raw[len(s):one], raw[one + len(p):two]
            prefix, suffix = (body, head) if kind == SPM else (head, body)
            texts.append(b"".join((prefix, raw[two + len(m):], suffix)))
            at = x + (one + len(p) if kind == SPM else len(p))
            spans.append((at, at + len(prefix), x + two + len(m), y))
        a, b, c, d = odd.points(np.array(spans, np.int64).reshape(-1, 4)).T
        plain = pc.equal(forms, PLAIN).to_numpy(zero_copy_only=False).astype(bool)
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(b - a, mask=plain), pa.array(d - c, mask=plain)],
            ["text", "prefix_chars", "middle_chars"])
    return of(output, form)


def fill_in_middle(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: int = SEED, cut: int = CUT,
                   suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Each document as the struct ``_row`` with n, form, prefix_chars, middle_chars and
    output, the text to train on."""
    ship_package(docs.sparkSession)
    rows = boxed(docs)
    made = transformed(field(text_col), draws(field(id_col), seed), cut, suffix_first)
    return rows.select(ROW, made.alias("_made")).select(ROW, "_made.*")


def restore(made: DataFrame) -> DataFrame:
    """Rows with ``output`` and ``form``: the rows with ``restored``, the text behind them."""
    ship_package(made.sparkSession)
    return made.withColumn("restored", restored(F.col("output"), F.col("form"))["text"])
