"""Long words, repeated ids, wordless documents: what must stay bounded, linear or the same from run to run."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martpulse.llm import fingerprints, mixing, pii, quality

# The forms as one pattern each, which take quadratic time on long words.
WRITTEN = re.compile(
    r"[A-Za-z0-9._%+-]+\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]+)+", re.I
)
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")


@pytest.mark.parametrize("seed", range(4))
def test_linear_forms_find_what_the_plain_ones_do(seed):
    rng = random.Random(seed)
    parts = ["a", "b.c", " ", "(at)", "[AT]", "(dot)", ".", "1", "23", "4.5", "-", "(", "x y", "@", "9.9.9.9", "1.2.3"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 24)))
        assert pii.written(text) == [m.span() for m in WRITTEN.finditer(text)], text
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in IP.finditer(text)], text
        assert [m.span() for m in pii.DOTTED.finditer(text)] == [m.span() for m in DOTTED.finditer(text)], text


@pytest.mark.parametrize("text", [
    "a" * 1_000_000 + "(at)", "a" * 1_000_000 + "(at)x" + "b" * 10, "1" * 1_000_000, "1 " * 500_000, "1." * 500_000, "1-(" * 333_000,
    "+1" * 500_000, "(at)" * 250_000, "a.b" * 333_000 + "@" + "c" * 1_000_000,
], ids=range(9))
def test_words_of_a_million_characters(text):
    start = time.perf_counter()
    pii.base_spans(text)
    pii.candidates(text)
    assert time.perf_counter() - start < 60  # quadratic patterns take hours


def test_a_label_or_document_that_repeats_does_not_pass_the_sample(spark, text_of):
    docs = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    others = spark.createDataFrame([(i, text_of(i, 20)) for i in range(2, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)] + [(1, 0)] * 50, "doc_id long, quality int")
    scored = quality.quality(docs.unionByName(others), labels, sample=10)
    assert scored.count() == 100_028


def test_fingerprints_of_text_ids_equal_those_of_numbers(spark, text_of):
    rows = [(f"{i:04}", text_of(i // 2, 30 + i % 7)) for i in range(1300)] + [(None, "no id here")]
    named = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    words = fingerprints.lexicon(named)
    found = {r.doc_id: tuple(r)[1:] for r in fingerprints.prints(named, words).collect()}
    numbered = named.withColumn("doc_id", F.col("doc_id").cast("long"))
    assert found == {None if r.doc_id is None else f"{r.doc_id:04}": tuple(r)[1:] for r in fingerprints.prints(numbered, words).collect()}


def test_reruns_of_the_mix_agree_on_rows_that_share_an_id(spark):
    rows = [(i % 3, "s", " ".join(["word"] * 4) + f" w{i}") for i in range(60)] + [(None, "s", f"one two {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    runs = [
        sorted((str(r.doc_id), r.text, r.copy) for r in mixing.emit(mixing.mix(df.orderBy(F.rand(seed)).repartition(n))).collect())
        for seed, n in ((1, 1), (2, 7), (3, 3))
    ]
    assert runs[0] and runs[0] == runs[1] == runs[2]


@pytest.fixture
def corpus(spark, tmp_path, text_of):
    """A folder with the tables that the pipeline reads, and documents of every kind."""
    good = [(i, "\n".join(text_of(i * 9 + k, 12).capitalize() + "." for k in range(6)), "en", "ab"[i % 2]) for i in range(60)]
    bad = [(100 + i, "zzz " * 40 + "!!! 000 " * 30, "en", "a") for i in range(40)]
    question = " ".join(f"fact{i}" for i in range(12))
    repeated = text_of(4711, 9) + "\n" + text_of(4712, 11)
    rows = good + bad + [
        (200, None, "en", "a"), (201, "", "en", "b"), (202, "\n\n", "en", None), (203, repeated, "en", "a"),
        (204, repeated.split("\n")[0] + "\n\n \t\n" + repeated.split("\n")[1], "en", "a"),
        (205, good[0][1] + "\n" + question + " answer1 answer2 answer3.", "en", "b"), (None, text_of(99, 40), "en", "a"),
    ]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 1) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(
        [(1, f"Question: {question}\nAnswer: answer1 answer2 answer3")], "item_id long, text string"
    ).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_the_pipeline_run(spark, corpus):
    out = corpus_pipeline.run(spark, corpus).collect()
    assert out and all(r.size > 0 and re.search(r"[^\x20\x09-\x0D]", r.text) for r in out)
    ids = {r.doc_id for r in out}
    assert not ids & set(range(100, 140)) and not ids & {200, 201, 202, 204}
    assert len(ids & set(range(60))) > 40
    again = corpus_pipeline.run(spark, corpus).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_the_pipeline_without_documents(spark, corpus, tmp_path, none):
    spark.read.parquet(f"{corpus}/labels.parquet").write.parquet(f"{tmp_path}/none/labels.parquet")
    spark.read.parquet(f"{corpus}/benchmark.parquet").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    none.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
