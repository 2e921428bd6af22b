from collections import Counter

import corpus_pipeline as cp
import public_tokenizers
from tokenizers import Tokenizer

from quire.llm import mixing, packing, pii, quality, simhash
from quire.llm.queries import QUERIES
from quire.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    kept = {r.doc_id for r in QUERIES["op7_quality"](spark, SF).collect() if r.kept}
    good = materialize(cp.quality_rules(spark, docs, SF), "t")
    assert good.columns == columns and sorted(r.doc_id for r in good.collect()) == sorted(kept)
    one = materialize(cp.near_duplicates(spark, good, SF), "t")
    classes = {r.component_id for r in simhash.near_duplicates(good).collect()}
    assert one.columns == columns and {r.doc_id for r in one.collect()} == classes
    clean = materialize(cp.personal_data(spark, one, SF), "t")
    texts = {r.doc_id: pii.redacted(r.text) for r in rows}
    assert clean.columns == columns and all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in clean.collect())
    mixed = materialize(cp.mix_sources(spark, clean, SF), "t")
    copies = {r.doc_id: r.copies for r in mixing.plan_mix(clean).select("_row.doc_id", "copies").collect()}
    assert mixed.columns == columns and Counter(r.doc_id for r in mixed.collect()) == Counter(copies)
    packed = cp.pack_sequences(spark, mixed, SF).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = {r.doc_id: len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean.collect()}
    assert Counter(r.doc_id for r in packed) == Counter({i: c * len(packing.pieces_of(n[i], 1024)) for i, c in copies.items()})
    again = cp.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in again) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_odd_documents_pass_through(spark, odd, clashing):
    for docs in (odd, clashing, odd.limit(0)):
        d = docs
        for name, stage in cp.STAGES:
            out = materialize(stage(spark, d, SF), "t")
            if name != "pack_sequences":
                assert out.columns == docs.columns
                d = out


def test_names():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "mix_sources", "pack_sequences"]
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 11))
    assert quality.THRESHOLD == 0.5 and simhash.SHINGLE == 3 and simhash.BITS == 3
