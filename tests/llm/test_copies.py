"""Line dedup, the Jaccard join and components against brute force; the pipeline's stages."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martpulse.llm import components, jaccard, lines, mixing, store


def apart(a, b):
    """Edit distance of two lists of words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_dedup(docs, exact, near):
    """doc -> text, comparing every line with all earlier ones."""
    seen, out = [], {}
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        if text is None:
            out[doc] = None
            continue
        kept = []
        for line in text.split("\n"):
            w = line.split()
            if len(w) < exact:
                kept.append(line)
                continue
            if not any(w == s or (len(w) >= near and len(s) >= near and abs(len(w) - len(s)) < 2 and apart(w, s) <= 1) for s in seen):
                kept.append(line)
            seen.append(w)
        out[doc] = "\n".join(kept)
    return out


def edited_lines(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(3, 16))] for _ in range(12)]
    docs = []
    for doc in range(40):
        own = []
        for _ in range(rng.randrange(1, 8)):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w) + 1)
                kind = rng.randrange(3)
                if kind == 0:
                    w.insert(at, rng.choice(vocabulary))
                elif at < len(w) and kind == 1:
                    del w[at]
                elif at < len(w):
                    w[at] = rng.choice(vocabulary)
            own.append(rng.choice(["", "  "]) + rng.choice([" ", "  "]).join(w))
        docs.append((doc, "\n".join(own)))
    return docs


@pytest.mark.parametrize("seed", range(4))
def test_lines_against_brute_force(spark, seed):
    docs = edited_lines(seed) + [(100, None), (101, ""), (102, "\n\n")]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_lines", F.lit("clash")).repartition(5)
    got = {r.doc_id: r.text for r in lines.dedup(table, exact_words=4, near_words=5).collect()}
    assert got == plain_dedup(docs, 4, 5)


@pytest.mark.parametrize("seed", range(2))
def test_short_lines_against_brute_force(spark, seed):
    docs = edited_lines(seed) + [(100, None), (101, ""), (102, "\n\n"), (103, "a\n \nb c\n\t\na"), (104, "b  c\n\n a \nd")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.text for r in lines.dedup(table, exact_words=1, near_words=5).collect()}
    assert got == plain_dedup(docs, 1, 5)


def test_pipeline_drops_short_repeats(spark, small):
    texts = ["All rights reserved.\n\nLicensed under the Apache License, Version 2.0.", "one\n\nAll rights reserved.\nLicensed under the Apache License, Version 2.1.\ntwo"]
    rows = [(i, t, "en", "x", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, small).collect()}
    assert got == {0: texts[0], 1: "one\n\ntwo"}


def test_runs_of_one_word(spark):
    docs = [(i, " ".join(["a"] * n)) for i, n in enumerate((8, 9, 11, 12, 14))] + [(9, "a a a b a a a a"), (10, "b a a a a a a a")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup(table, 5, 5).collect()}
    assert got == plain_dedup(docs, 5, 5)


def test_lines_hot_and_odd(spark, odd, none, text_of):
    line = text_of(1, 20)
    docs = [(i, f"{text_of(i + 10, 15)}\n{line}\n{line}") for i in range(300)] + [(None, line)]
    rows = lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [r.doc_id for r in rows if line in r.text] == [None]
    assert sum(r.n_removed for r in rows) == 600
    out = lines.dedup(odd)
    assert out.count() == odd.count() and set(odd.columns) <= set(out.columns)
    assert lines.dedup(none).count() == 0
    assert {r.text for r in out.where("doc_id = 2").collect()} == {None}


def test_common_variant_makes_no_pairs(spark, text_of):
    words = text_of(3, 20).split()
    docs = [(i, " ".join(words[:7] + [f"x{i}"] + words[8:])) for i in range(2000)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = lines.distinct_lines(table, 5, 10)
    pairs = lines.candidates(lines.variants(lines._texts(table, lines.partnered(found))))
    assert pairs.count() < 3 * 2000
    assert sum(r.n_removed for r in lines.dedup(table).collect()) == 1999


def plain_shingles(text, n):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    size = min(n, len(w))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


def plain_components(docs, n, percent):
    sets = {}
    for d, t in docs:
        sets.setdefault(d, []).append(plain_shingles(t, n))
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, x), (b, y) in itertools.combinations([(d, s) for d, own in sets.items() for s in own if s], 2):
        if 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {d: root(d) for d in sets}


def near_documents(seed, groups=8, size=12, words=(3, 140)):
    """Groups of copies, each edited a little more than the last."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(groups):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(*words))]
        for _ in range(rng.randrange(1, size)):
            docs.append(" ".join(w))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = [rng.choice(vocabulary) for _ in range(rng.randrange(3))]
                w = w or ["x"]
    rng.shuffle(docs)
    return [(i * 3 + 1, d if i % 9 else d.upper()) for i, d in enumerate(docs)]


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 3, 90), (2, 3, 90), (3, 5, 80), (4, 5, 80), (5, 1, 50)])
def test_join_against_brute_force(spark, seed, n, percent):
    docs = near_documents(seed) + [(900, ""), (901, None), (902, "one"), (903, "ONE"), (904, "one one"), (905, " \n ")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in jaccard.join(table, n, percent).collect()}
    want = plain_components(docs, n, percent)
    assert {d: c for d, (c, _) in got.items()} == want
    assert all(got[d][1] == len(plain_shingles(t, n)) for d, t in docs)
    stay = [r.doc_id for r in jaccard.one_of_each(table, n, percent).collect()]
    assert sorted(stay) == sorted({c for c in want.values()})


def test_join_odd(spark, odd, none):
    rows = jaccard.join(odd, 3, 90).collect()
    assert len(rows) == odd.count()
    of = {r.doc_id: r.component_id for r in rows}
    assert of[5] == 3 and of[3] == 3 and of[1] == 1 and of[2] == 2 and of[None] is None
    assert jaccard.one_of_each(odd, 3, 90).columns == odd.columns
    assert jaccard.join(none, 3, 90).count() == 0


def test_rows_of_one_document_join_its_classes(spark, text_of):
    docs = [(1, text_of(1, 50)), (2, text_of(2, 50)), (7, text_of(1, 50)), (7, text_of(2, 50))]
    rows = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string"), 3, 90).collect()
    assert {r.component_id for r in rows} == {1}


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_keys_meet_for_every_linked_pair(percent):
    """Sets of every size, with as many differing tokens as a link allows, share a key in either mode."""
    rng = np.random.default_rng(percent)
    plain = jaccard.bands({s: 1 for s in range(1, 400)}, percent)
    for deletion in (False, True):
        plan = {
            k: jaccard.Band(b.number, b.low, b.high, b.apart, (b.apart + 2) // 2 if deletion else b.segments, b.spare, deletion)
            for k, b in plain.items()
        }
        for _ in range(400):
            size = int(rng.integers(1, 200))
            most = jaccard.most_apart(2 * size, percent)
            less = int(rng.integers(0, most + 1))
            a = rng.integers(0, 2**63, size + less, dtype=np.uint64)
            x, y = np.unique(a[:size]), np.unique(np.concatenate([a[less // 2 : size], a[size : size + less - less // 2]]))
            both = len(np.intersect1d(x, y))
            if 100 * both < percent * (len(x) + len(y) - both):
                continue
            met = set()
            for s in (x, y):
                own = jaccard.band_of(len(s), percent)
                met.add(frozenset(k for n in (own, own - 1) if n in plan for k in jaccard.keys(s, plan[n]).tolist()))
            assert len(met) == 1 or frozenset.intersection(*met)


def test_modes_are_allocated_by_cost():
    few, many = (jaccard.bands({400: n}, 80)[jaccard.band_of(400, 80)] for n in (1000, 10**9))
    assert not few.deletion and many.deletion and many.segments < few.segments


def test_modes_follow_the_meetings_measured(spark):
    """Sets whose tokens differ write one key per segment, however many there are; those that share some take deletions."""
    rng = np.random.default_rng(0)

    def met(sets):
        rows = [(len(s), jaccard._tally(s, 80)) for s in sets]
        return jaccard.meetings(spark.createDataFrame(rows, "size long, tally binary").repartition(3), 80)

    apart = [rng.integers(0, 2**63, 400, dtype=np.uint64) for _ in range(2000)]
    number = jaccard.band_of(400, 80)
    assert jaccard.bands({400: 10**6}, 80)[number].deletion  # by the guess
    exact, _ = met(apart)[number]
    assert exact < 0.5 * 2000 * len(jaccard.keys(apart[0], jaccard.bands({400: 1}, 80)[number]))
    assert not jaccard.bands({400: 2000}, 80, met(apart))[number].deletion

    few = rng.integers(0, 2**63, 1200, dtype=np.uint64)  # of which every set has a third
    shared = [np.sort(rng.permutation(few)[:400]) for _ in range(2000)]
    plan = jaccard.modes(*jaccard._band_at(400, 80), 80)
    for measured, band in zip(met(shared)[number], plan, strict=True):
        times = np.unique(np.concatenate([jaccard.keys(s, band) for s in shared]), return_counts=True)[1]
        pairs = (times * (times - 1) // 2).sum()
        assert abs(measured - pairs) < 0.8 * (pairs + times.sum())
    assert met([]) == {}


def test_sets_are_built_for_pairs_that_may_link_only(spark, monkeypatch):
    """Long texts that share a segment by a common line, but little else, are dropped by their outlines."""
    rng = random.Random(3)
    line = " ".join(f"common{i}" for i in range(400))
    texts = [line + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(1600)) for _ in range(30)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100, texts[0] + " end")]
    built, sets = [], jaccard._sets
    monkeypatch.setattr(jaccard, "_sets", lambda *a: built.append(out := sets(*a)) or out)
    rows = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string"), 5, 80).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: i for i in range(30)} | {100: 0}
    assert {r.doc_id for df in built for r in df.collect()} == {0, 100}


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_outlines_drop_no_link(percent):
    rng = np.random.default_rng(percent)
    for _ in range(200):
        size = int(rng.integers(513, 5000))
        less = int(rng.integers(0, jaccard.most_apart(2 * size, percent) + 1))
        a = np.unique(rng.integers(0, 2**63, size + less, dtype=np.uint64))
        x, y = a[: len(a) - less // 2], a[less - less // 2 :]
        both = len(np.intersect1d(x, y))
        p, q = jaccard._outline(x), jaccard._outline(y)
        assert p is None or q is None or jaccard._flipped(p, q) <= len(x) + len(y) - 2 * both


def test_shuffle_files_go_when_a_table_is_settled(spark):
    import glob

    def files():
        local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in local for f in glob.glob(f"{d}/*/shuffle_*")}

    before = files()
    out = store.settle(spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count().repartition(3), "cleanup")
    assert not files() - before and out.count() == 1000


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (300, 200), (7, 7)] + [(500, 500 + i) for i in range(1, 300)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in components.components(links).collect()}
    want = {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100} | {500 + i: 500 for i in range(300)}
    assert got == want
    assert components.components(links.limit(0)).count() == 0


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    bench = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, folder)
        rows = out.collect()
        if name != "mixing":
            assert out.columns == names and {r.doc_id for r in rows} <= set(before)
        if name == "line_dedup":
            texts = [line for r in rows for line in r.text.split("\n") if len(line.split()) >= 5]
            assert len(texts) == len({" ".join(t.split()) for t in texts})
        if name == "jaccard_join":
            want = plain_components([(d, r.text) for d, r in before.items()], 5, 80)
            assert {r.doc_id for r in rows} == set(want.values())
        if name == "decontamination":
            texts = {r.doc_id: " ".join(re.findall(r"\w+", r.text.lower())) for r in rows}
            assert not any(b in t for b in bench for t in texts.values())
            assert len(rows) > 0.9 * len(before)
        if name == "mixing":
            total = sum(r.size for r in {r.doc_id: r for r in rows}.values())
            assert len(rows) > len(before) and total > 0
        docs = spark.createDataFrame(rows, out.schema)


def test_pipeline_without_rows(spark, small, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert docs.count() == 0


def test_word_counts_agree(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(50)
    for r in docs.select("text", mixing.word_count("text").alias("n")).collect():
        assert r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
