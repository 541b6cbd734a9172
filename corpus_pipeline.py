"""A training corpus from raw documents: quality, line dedup, near duplicates, decontamination, mixing.

Nulls, empty tables, ties and repeated rows are as each stage's module states; a null or wordless text passes the stages that keep
it and is not taken by the mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martpulse.llm import decontam, jaccard, lines, mixing, quality
from martpulse.llm.queries import table
from martpulse.llm.store import settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents it rejects go."""
    scored = quality.quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: repeated lines of any number of words go; documents of which nothing is left go with them.

    One word in five may differ, as far as the Jaccard join goes for documents; blank lines stay as layout, and a document that is
    left with these alone is one of which nothing is left.
    """
    words = F.col("text").rlike(mixing.WORD)
    rest = lines.dedup(docs, exact_words=1, near_words=5).where((F.coalesce("n_removed", F.lit(0)) == 0) | words)
    changed = F.col("n_removed") > 0
    return rest.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join, five words, 0.8: one document of each group stays."""
    return jaccard.one_of_each(docs, n=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: one row per copy taken, with sizes, targets and the number of the copy; documents without a word are not taken."""
    return mixing.emit(mixing.mix(docs))


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # a fitted classifier is not expressible in SQL; tests hold each stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
