"""The pipeline against the plain versions of its stages."""

import hashlib

import corpus_pipeline
from facetable.llm import bpe
from facetable.llm.queries import QUERIES
from tests.llm import brute


def test_stages_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "benchmark decontamination", "personal data", "tokens"]


def test_pipeline(spark, data):
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    good = {r.doc_id for r in QUERIES["op5_quality_rules"](spark, data).where("kept").collect()}
    rows = [(d, docs[d]) for d in sorted(good)]
    rows = [(d, docs[d]) for d, _, first in brute.near(rows) if d == first]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(d, t) for d, t in rows if not brute.leaks(t, items)]

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, data).collect()}
    assert set(got) == {d for d, _ in rows}
    library = Tokenizer.from_file(bpe.tokenizer_path())
    for d, text in rows:
        if brute.personal(text):
            continue  # its text was changed
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[d].ids == ids and got[d].n_tokens == len(ids)
        assert got[d].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    redacted = [d for d, text in rows if brute.personal(text)]
    assert redacted
    for d in redacted:
        decoded = library.decode(got[d].ids, skip_special_tokens=False).replace("</w> ", " ").replace(" ", "")
        assert any(mark in decoded for mark in ("[email]", "[ip]", "[card]", "[phone]"))
