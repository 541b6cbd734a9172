"""Registered queries of the operators for text corpora, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martpulse.llm import (
    chat, codes, decontam, fingerprints, jaccard, lines, mixing, phrases, pii, quality, search, secrets, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.fit(docs))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprints.prints(docs, fingerprints.lexicon(docs))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), n=3, percent=90)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.rotate(table(spark, sf_dir, "conversations"))
    return views.withColumn("mask", chat.mask_text(F.col("mask")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.report(*codes.compress(table(spark, sf_dir, "embeddings")))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_quality, op3_personal_data, op4_secrets, op5_mixing, op6_warc, op7_line_dedup,
        op8_fingerprints, op9_jaccard_join, op10_chat, op11_vector_codes, op12_phrases, op13_search,
    )
}
