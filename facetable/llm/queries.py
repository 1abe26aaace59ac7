"""One query per operator over its whole table, with production parameters.

The operators return their real outputs; the queries derive the columns that are
compared from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

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
from facetable.llm.tables import held_out, load


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, load(spark, sf_dir, "benchmark"), short_anywhere=False)
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.col("leaks.item_id").alias("item_ids"),
        F.coalesce(F.array_max("leaks.similarity"), F.lit(0.0)).alias("best_similarity"),
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality_model.fit(docs, load(spark, sf_dir, "labels"), folds=5, fold=0)
    return quality_model.score(docs, forest).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted"
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 3, 1)
    network = langid.fit(docs, F.col("doc_id").isNotNull() & ~out)
    return langid.identify(docs.select("doc_id", "text"), network).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score"
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality_rules.ledger(docs)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.fails("base").alias("base_failed"),
        (~quality_rules.fails("base") & ~quality_rules.fails("v1")).alias("kept"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = load(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.shuffle_into_shards(docs, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))

    def count(kind: str) -> Column:
        of_kind = F.filter("base_spans", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.digest("base_spans"), 256).alias("base_sha256"),
        pii.digest("spans").alias("spans"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode_documents(bpe.encode_documents(docs).drop("text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_middle.invert(fill_middle.transform(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.mark(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_language_id": op3_language_id,
    "op4_html_text": op4_html_text,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_sharding": op7_sharding,
    "op8_minhash": op8_minhash,
    "op9_pii": op9_pii,
    "op10_bpe": op10_bpe,
    "op11_token_align": op11_token_align,
    "op12_fill_middle": op12_fill_middle,
    "op13_exact_dedup": op13_exact_dedup,
}
