"""The registered queries of the operators of this subpackage, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm import (bpe, classifier, conversations, jaccard, langid, lm, mixing, quality,
                           secrets, urls, vectors, warc, whitening)
from peerscope.llm.oracle import ORACLE_SQL
from peerscope.llm.session import materialised, remove_folder, scratch_folder, with_row_key

#: The vocabulary file of the encoding query; a parameter of the operator.
BPE_FILE = "word_bpe_49k.json"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BPE_FILE)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return quality.with_quality(docs).select("doc_id", "quality.*")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_documents(spark, sf_dir), words_each=4, percent=85)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    s = secrets.with_secrets(docs)
    base = F.concat(*(F.col(f"secrets.{r.kind}") for r in secrets.BASE))
    return s.select(
        "doc_id", *(F.size(f"secrets.{r.kind}").cast("long").alias(f"n_{r.kind}")
                    for r in secrets.BASE),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("secrets.spans")).alias("spans"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = langid.remainder("doc_id", 5) == 0
    model = langid.fit(docs.filter(~out))
    scored = langid.with_language(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", out.alias("held_out"), "language.lang_pred", "language.score",
                         F.size("language.spans").cast("long").alias("n_spans"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    out = langid.remainder("doc_id", 10) == 0
    training = docs.filter(~out)
    counts = materialised(lm.word_counts(training))
    scored = lm.with_lm_score(docs, lm.fit(training, counts), counts)
    return scored.select("doc_id", out.alias("held_out"), "lm.*")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return bpe.with_bpe(docs, bpe_path()).select("doc_id", "bpe.*")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.93)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    out = langid.remainder("doc_id", 4) == 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~out)
    scored = classifier.with_score(docs, classifier.fit(docs, labels))
    return scored.select("doc_id", out.alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "position")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    keyed, archives = scratch_folder(spark, "pages"), scratch_folder(spark, "warc")
    found = warc.round_trip(with_row_key(pages, "row", keyed), archives)
    for folder in (keyed, archives):  # the records are in the checkpoint folder
        remove_folder(spark, folder)
    return found


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows, found = conversations.repair(conversations.damaged(given), given)
    return conversations.with_digest(rows, found)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_url_filters": op3_url_filters,
    "op4_secret_scans": op4_secret_scans,
    "op5_language_id": op5_language_id,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_bpe": op7_bpe,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_warc": op12_warc,
    "op13_conversations": op13_conversations,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
