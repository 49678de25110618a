"""The corpus pipeline: documents -> rules -> near duplicates -> secrets -> mix -> tokens.

Every stage takes all rows its predecessor kept. ``run`` writes each stage's result to the
shared checkpoint folder and reads it again for the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm import bpe, jaccard, mixing, quality, secrets
from peerscope.llm.registry import bpe_path
from peerscope.llm.session import (ensure_checkpoint_dir, remove_folder, unused,
                                   with_row_key)

#: Near duplicates share this percentage of their shingles of so many words.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep. Null and empty texts go. This and the next
    stages pass columns of any name through."""
    verdict, = unused(docs, "__quality")
    judged = quality.with_quality(docs, out_col=verdict)
    return judged.filter(F.col(f"{verdict}.kept")).drop(verdict)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one row: that with the least id, null last. Rows that
    share a null or repeated id are rows of their own. Documents without shingles stay."""
    row, = unused(docs, "__row")
    rows = with_row_key(docs, row)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                   F.col(row).alias("row"))
    found = jaccard.near_duplicates(rows.select(key.alias("key"), "text"), SHINGLE_WORDS,
                                    SIMILAR_PERCENT, id_col="key")
    keep = found.filter(F.col("doc_id.row") == F.col("component_id.row")).select(
        F.col("doc_id.row").alias(row))
    return rows.join(keep, row, "left_semi").select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark and n_chars counted anew."""
    columns = docs.columns
    marked, = unused(docs, "__secrets")
    found, spans = secrets.with_secrets(docs, out_col=marked), F.col(f"{marked}.spans")
    hit = F.size(spans) > 0
    found = found.withColumn("text", F.when(hit, secrets.redacted(
        F.col("text"), spans)).otherwise(F.col("text")))
    return found.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).select(*columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and tokens of every row: count, digests of ids and decoded text, ids."""
    out = bpe.with_bpe(docs.select("doc_id", "source", "text"), bpe_path(), outputs=("ids",))
    return out.select("doc_id", "source", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256",
                      "bpe.ids")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", token_ids),
]

#: SQL cannot express the encoding; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last one's result is not written here. What a stage
    was read from is deleted when its result is written."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
