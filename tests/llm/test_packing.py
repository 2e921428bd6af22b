import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import packing, tokenfiles, tokens
from quire.llm.tokens import Coder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = ["word", "Wörter,", "naïve.", "İst", "ſtop", " ", "  ", "\n", " \n", "\n\n", "\t", "a", "B", "é", "́", "12", "3",
         "'s", "'ll", "!!", "|", " ", " ", "\x1c", "\x85", "Σ", "ΟΔΟΣ", "<|endoftext|>", "<|startoftext|>", "日本",
         "​", "﻿", "ab cd", "ß", "😀", "\x00", "_"]


def direct(path, text):
    return np.array(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [2], "<u4")


@pytest.mark.parametrize("path,spaced", [(BYTE, True), (WORD, False)])
def test_coder_equals_tokenizer(path, spaced):
    rng, own, whole = random.Random(11), Coder(path, spaced), Tokenizer.from_file(path)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(15))) for _ in range(4000)]
    for i in range(0, len(texts), 50):
        some = texts[i:i + 50]
        got = own.encode(some if spaced else [t.encode() for t in some])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in some]


def test_coder_forgets(monkeypatch):
    monkeypatch.setattr("quire.llm.tokens.KEPT_PIECES", 20)
    own, whole = Coder(BYTE, True), Tokenizer.from_file(BYTE)
    for i in range(100):
        text = f"alpha{i} beta{i % 7} gamma"
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(own.kept) + len(own.firsts) < 60


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1024)]),
                                    (2048, [(0, 1024), (1024, 1024)]), (2500, [(0, 452), (452, 1024), (1476, 1024)])])
def test_pieces(n, want):
    assert packing.pieces_of(n, 1024) == want


def one_by_one(lengths, size):
    """Best-fit decreasing, piece by piece: number of bins."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(size - n)
    return len(free)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 64, 1024])
    lengths = [rng.randint(1, size) if rng.random() < 0.7 else rng.choice([1, 2, size]) for _ in range(rng.randrange(1, 600))]
    counts, bins, ranks = Counter(lengths), {}, Counter()
    runs = packing.plan(counts, size)
    for i, (n, rank, first, per_bin, offset) in enumerate(runs):
        assert rank == ranks[n]
        later = [r[1] for r in runs[i + 1:] if r[0] == n]
        upto = later[0] if later else counts[n]
        for r in range(rank, upto):
            bins.setdefault(first + (r - rank) // per_bin, []).append((offset + (r - rank) % per_bin * n, n))
        ranks[n] = upto
    assert ranks == counts
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= size
    assert len(bins) == one_by_one(lengths, size)


def test_packed_documents(odd):
    rows = packing.pack_documents(odd, BYTE, size=64).collect()
    want = Counter()
    for d in odd.collect():
        ids = direct(BYTE, d.text)
        for p, (a, n) in enumerate(packing.pieces_of(len(ids), 64)):
            want[(d.doc_id, p, a, n, zlib.crc32(ids[a:a + n].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in sorted(b)[:i]) == o for b in bins.values() for i, (o, _) in enumerate(sorted(b)))
    assert max(sum(n for _, n in b) for b in bins.values()) <= 64
    assert len(bins) == one_by_one([r.length for r in rows], 64)


def test_sequences(make):
    docs = make([(i, f"some words {i} " * (i % 9 + 1)) for i in range(60)])
    pieces = packing.materialize(packing.token_pieces(docs, BYTE, True, 32, with_ids=True), "test-pieces")
    seqs = packing.sequences(packing.pack(pieces, 32)).collect()
    assert sum(len(r.ids) for r in seqs) == sum(len(direct(BYTE, d.text)) for d in docs.collect())
    assert all(len(r.ids) <= 32 for r in seqs)


def test_ranks_in_salts(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_RANKING", 10)
    rows = spark.range(500).selectExpr("id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, 7L, id % 5) as length", "id as ids_crc32")
    got = {}
    for r in packing.ranked(rows).collect():
        got.setdefault(r.length, []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values())


def test_clashing_and_empty(clashing):
    assert packing.pack_documents(clashing, BYTE).count() >= clashing.count()
    assert packing.pack_documents(clashing.limit(0), BYTE).count() == 0


def test_token_files_round_trip(spark, odd, clashing, tmp_dir):
    for docs in (odd, clashing):
        path = f"{tmp_dir}/{len(docs.columns)}"
        tokenfiles.write_tokens(docs, path, WORD, False, parts=3)
        rows = tokenfiles.read_tokens(spark, path).orderBy("start").collect()
        assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter(
            (d.doc_id, tuple(direct(WORD, d.text).tolist())) for d in docs.collect())
        at = 0
        for r in rows:
            assert (r.start, r.n_tokens) == (at, len(r.ids))
            at += r.n_tokens
        ids = [r.doc_id for r in rows]
        assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    crc = tokenfiles.read_tokens(spark, path).select("ids", tokenfiles.ids_crc32("ids").alias("c")).collect()
    assert all(r.c == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in crc)


def test_token_files_empty(spark, odd, tmp_dir):
    tokenfiles.write_tokens(odd.limit(0), f"{tmp_dir}/e", WORD, False, parts=2)
    assert tokenfiles.read_tokens(spark, f"{tmp_dir}/e").count() == 0


def test_token_files_prune(spark, make, tmp_dir):
    docs = make([(i, f"text number {i}") for i in range(300)])
    tokenfiles.write_tokens(docs, f"{tmp_dir}/p", WORD, False, parts=4)
    some = tokenfiles.read_tokens(spark, f"{tmp_dir}/p", [7, 250])
    whole = {r.doc_id: r.start for r in tokenfiles.read_tokens(spark, f"{tmp_dir}/p").collect()}
    assert {r.doc_id: r.start for r in some.collect()} == {7: whole[7], 250: whole[250]}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan


def scanned(df):
    """Rows that the file reader handed over when the query ran, before its filter."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().get("numOutputRows").get().value()


def test_stripes_and_metadata_pruning(spark, make, tmp_dir, monkeypatch):
    """One file of several stripes is read by several tasks; a lookup skips stripes by their
    ranges, and by the Bloom filter where the range does not tell."""
    from pathlib import Path

    import pyarrow.orc
    monkeypatch.setattr(tokenfiles, "STRIPE_BYTES", 1 << 17)
    monkeypatch.setattr(tokenfiles, "INDEX_STRIDE", 1000)
    rng = np.random.default_rng(4)
    # the writer looks at the size of a stripe every 5,000 rows
    docs = make([(2 * i, " ".join(map(str, rng.integers(0, 10**9, 9)))) for i in range(24_000)]).repartition(4)
    path = f"{tmp_dir}/s"
    tokenfiles.write_tokens(docs, path, WORD, False, parts=1)
    file, = Path(path).glob("*.orc")
    size, stripes = file.stat().st_size, pyarrow.orc.ORCFile(str(file)).nstripes
    assert stripes >= 4
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 3))
    try:
        rows = spark.read.schema("doc_id bigint, part int, start long, n_tokens long, ids array<int>").orc(path)
        per_task = {r["t"]: r["count"] for r in rows.groupBy(F.spark_partition_id().alias("t")).count().collect()}
        whole = tokenfiles.read_tokens(spark, path).orderBy("start").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(per_task) >= 2 and sum(per_task.values()) == 24_000 and min(per_task.values()) > 2000
    assert [r.doc_id for r in whole] == [2 * i for i in range(24_000)]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(whole, whole[1:]))
    rows = spark.read.schema("doc_id bigint, ids array<int>").orc(path)
    assert scanned(rows.filter("doc_id >= 0")) == 24_000
    assert 0 < scanned(rows.filter("doc_id = 24400")) <= 1000        # one row group of one stripe
    # 24,401 lies within the range of that row group: only the Bloom filter rules it out
    assert scanned(rows.filter("doc_id = 24401")) == 0


def test_memory_of_pieces_is_bounded(monkeypatch):
    """With hardly any room the ids are the same."""
    from quire.llm import tokens
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x} été, a.b\n" for x in rng.zipf(1.3, 40) % 5000) for _ in range(300)]
    for path, spaced in ((BYTE, True), (WORD, False)):
        want = [tuple(direct(path, t).tolist()) for t in texts]
        for room in (160 << 20, 20_000, 0):
            monkeypatch.setattr(tokens, "KEPT_BYTES", room)
            c = tokens.Coder(path, spaced)
            got = [tuple(np.frombuffer(x, "<u4").tolist()) for some in c.encode_column(pa.array(texts), 16) for x in some]
            assert got == want and c.size <= room + 2000


def test_pieces_are_given_back():
    """A worker that goes on with a stage without tokens keeps no pieces."""
    import pyarrow as pa
    from quire.llm import pii
    from quire.llm.common import in_slices
    own = tokens.coder(BYTE, True)
    want = own.encode(["alpha beta gamma"])
    assert own.size > 0
    assert in_slices(lambda some: pa.array([pii.redacted(v.as_py()) for v in some]), pa.array(["a@b.org"])).to_pylist() == ["[EMAIL]"]
    assert own.size == 0 and not own.kept and own.firsts == {"": b""}
    assert own.encode(["alpha beta gamma"]) == want
