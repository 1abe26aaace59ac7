"""Documents to training tokens: five stages, each written and read again.

1. quality rules: documents that the policy rejects go
2. near duplicates: one document of each group stays
3. benchmark decontamination: documents that hold a benchmark item go
4. personal data: found spans are replaced in the text
5. tokens: every text is encoded, and decoded again as proof

A stage takes (spark, docs, sf_dir).  All but the last return the columns of
``documents``, whatever other columns come in.  Between two stages the rows are written
as Parquet to the shared folder of the session, so a lost executor costs at most one
stage.

Edge cases: an empty table stays empty through all stages; NULL and empty texts are
rejected by the first stage; a stage given them on its own keeps them (2, 3), leaves
them as they are (4) or gives them no tokens (5).  Repeated rows stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetable.llm import bpe, decontaminate, minhash, pii, quality_rules
from facetable.llm.tables import load, ship
from facetable.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(docs.select(*COLUMNS))
    return quality_rules.apply_policy(rows, "v1").select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs.select(*COLUMNS)).select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = load(spark, sf_dir, "benchmark")
    return decontaminate.decontaminate(docs.select(*COLUMNS), benchmark, short_anywhere=False)


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS)
    clean = pii.redact(rows, pii.fit(rows))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.decode_documents(bpe.encode_documents(docs.select(*COLUMNS)))
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", rules_stage),
    ("near duplicates", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("personal data", privacy_stage),
    ("tokens", token_stage),
]

#: SQL cannot express the trained model of stage 4 nor the tokens of stage 5.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    ship(spark)
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
