"""Every operator and stage on NULLs, empty tables, repeated rows and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from facetable.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    fill_middle,
    html_text,
    langid,
    minhash,
    pii,
    quality_model,
    quality_rules,
    sharding,
    suffix_dedup,
    token_align,
)

ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd_rows(spark):
    long = " ".join(f"word{i % 977} {i}" for i in range(20000))
    rows = [
        (1, "one two three four five six seven", "en", "a", 33), (1, "one two three four five six seven", "en", "a", 33),
        (2, None, None, None, None), (3, "", "en", "a", 0), (None, "no id at all here now", None, "a", 3),
        (None, None, None, None, None), (4, " \n ", "de", "a", 3), (5, long, "en", "a", len(long)),
        (6, long + " end", "en", "a", len(long)), (7, "mail a@b.org now " * 10, "en", "a", 3),
    ]
    return spark.createDataFrame(rows, ROWS)


@pytest.fixture(scope="module")
def operators(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    forest = quality_model.fit(docs, labels)
    network = langid.fit(docs.where("doc_id % 7 = 0"), F.col("doc_id").isNotNull(), per_lang=10)
    model = pii.fit(docs)
    return {
        "leaks": lambda d: decontaminate.find_leaks(d, bench),
        "quality": lambda d: quality_model.score(d, forest),
        "language": lambda d: langid.identify(d, network),
        "html": lambda d: html_text.extract(d, "text"),
        "rules": quality_rules.ledger,
        "repeats": suffix_dedup.remove_repeats,
        "shards": sharding.shuffle_into_shards,
        "near": minhash.near_duplicates,
        "deduplicate": minhash.deduplicate,
        "spans": lambda d: pii.find(d, model),
        "redact": lambda d: pii.redact(d, model),
        "tokens": lambda d: bpe.decode_documents(bpe.encode_documents(d)),
        "aligned": token_align.align,
        "moved": lambda d: fill_middle.invert(fill_middle.transform(d)),
        "same": exact_dedup.mark,
    }


NAMES = (
    "leaks", "quality", "language", "html", "rules", "repeats", "shards", "near", "deduplicate", "spans",
    "redact", "tokens", "aligned", "moved", "same",
)


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(operators, odd_rows, name):
    rows = operators[name](odd_rows).collect()
    assert len(rows) == (9 if name == "deduplicate" else 10)
    # Repeated rows get equal answers, but for their places in a shuffle.
    ones = [r for r in rows if r["doc_id"] == 1]
    assert len(ones) == 2 and (name == "shards" or ones[0] == ones[1])
    assert sum(r["doc_id"] is None for r in rows) == 2


def test_rows_without_an_id_are_linked_with_nothing(operators, odd_rows):
    for r in operators["near"](odd_rows.union(odd_rows)).where("doc_id IS NULL").collect():
        assert r.component_id is None and r.kept


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(operators, odd_rows, name):
    frame = operators[name](odd_rows.where("FALSE"))
    assert frame.count() == 0 and frame.columns == operators[name](odd_rows).columns


#: Columns of any name that an operator uses for itself.
CLASHES = (
    "score", "predicted", "held_out", "lang_pred", "leaks", "ids", "decoded", "spans", "base_spans", "shard",
    "slot", "kept", "n_words", "failed", "h1", "bands", "label", "task", "side", "route", "kind", "payload",
    "wanted", "shingles", "class_id", "component_id", "a", "b", "id", "hub", "item_id", "key", "block", "row", "text_", "words", "lines", "base", "all", "at", "bin", "ends",
    "n_bytes", "band", "first", "c", "h", "y", "x", "slice", "place", "radix", "head", "body", "t", "c0", "c1", "n_best", "n", "form", "output",
    "restored", "run", "digest", "bytes", "check", "keep", "rows", "keep_id", "group_size", "text_sha256",
)


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns(operators, odd_rows, name):
    wide = odd_rows.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    plain, got = operators[name](odd_rows), operators[name](wide)
    if name == "shards":
        assert got.count() == 10
        return
    shared = [c for c in plain.columns if c in got.columns]
    assert sorted(map(str, plain.select(*shared).collect())) == sorted(map(str, got.select(*shared).collect()))
    for c in set(CLASHES) & set(got.columns) - set(plain.columns):
        assert {r[0] for r in got.select(c).distinct().collect()} == {f"own {c}"}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages(spark, data, odd_rows, stage):
    wide = odd_rows.select(F.lit("own").alias("spans"), "*", F.lit(1).alias("label"))
    for rows in (wide, wide.where("FALSE")):
        out = stage[1](spark, rows, data)
        out.collect()
        if stage is not corpus_pipeline.STAGES[-1]:
            assert out.columns == list(corpus_pipeline.COLUMNS)
