"""Decontamination, quality, fingerprints, archives."""

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from martpulse.llm import decontam, fingerprints, quality, warc

ITEMS = [
    (1, "what colour has the sky on a clear day in spring? It is blue because of how light is scattered."),
    (2, "Name the longest river that runs through the old town. The answer is the river of seven bridges."),
    (3, "short one"), (4, ""), (5, None), (6, "Where do the geese fly when the pond has frozen? They fly south over the hills."),
]


def plain_bm25(query, items, df):
    """Score of every item for a set of words, by definition, over its own score."""
    docs = {i: decontam.words(t) for i, t in items}
    n, mean = len(docs), sum(map(len, docs.values())) / len(docs)

    def score(words, d):
        return sum(
            np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * d.count(w) * 2.2 / (d.count(w) + 1.2 * (0.25 + 0.75 * len(d) / mean))
            for w in sorted(set(d) & set(words))
        )

    return {i: score(query, d) / score(d, d) for i, d in docs.items() if d}


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 0.9])
def test_block_max_wand_finds_all(threshold, text_of):
    items = [(i, text_of(i, 8 + i % 60, ("on", "ti", "er", "the", "an"))) for i in range(300)]
    df = {}
    for _, t in items:
        for w in set(decontam.words(t)):
            df[w] = df.get(w, 0) + 1
    index = decontam.build_index(items, df, len(items), sum(len(decontam.words(t)) for _, t in items) / len(items))
    assert index.blocks > 10
    for seed in range(8):
        query = decontam.words(text_of(seed * 7 + 3, 25, ("on", "ti", "er", "the", "an"))) + decontam.words(items[seed][1])[:12]
        want = {i for i, s in plain_bm25(query, items, df).items() if s >= threshold}
        known = np.array(sorted({index.terms[w] for w in query if w in index.terms}))
        got = set()
        for lists in index.classes:
            for _, place, _ in zip(*decontam.block_max_wand(known * 0, known, 1, lists, np.full(len(items), threshold)), strict=True):
                got.add(index.ids[place])
        assert got == want


def test_leaks(spark, text_of, odd, none):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = text_of(5, 400)
    long_text = text_of(6, 30_000) + " " + ITEMS[5][1].upper() + " " + text_of(7, 300)
    docs = spark.createDataFrame(
        [(1, clean), (2, f"{clean} {ITEMS[0][1]} {clean}"), (3, long_text), (4, ITEMS[1][1].replace(". ", ".\n ")), (5, None), (6, ""),
         (7, "what colour has the sky on a clear day in spring? Nobody knows for sure."), (None, ITEMS[0][1])],
        "doc_id long, text string",
    )
    for shard in (2000, 2):
        got = {(r.doc_id, r.item_id) for r in decontam.find(docs, bench, shard_items=shard).collect()}
        assert got == {(2, 1), (3, 6), (4, 2), (None, 1)}
        assert {r.doc_id for r in decontam.clean(docs, bench, shard_items=shard).collect()} == {1, 5, 6, 7}
    assert decontam.find(docs, bench.limit(0)).count() == 0
    assert decontam.find(none, bench).count() == 0
    assert decontam.clean(odd, bench).columns == odd.columns and decontam.clean(odd, bench).count() == odd.count()


def plain_overlap(part, passage):
    n = min(3, len(part))
    own = {tuple(part[i : i + n]) for i in range(len(part) - n + 1)}
    return len(own & {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}) / len(own)


def leaks_of_all_pairs(items, docs):
    """(doc, item) by the overlaps in passages of one and a half lengths of the item itself."""
    want = set()
    for doc, text in docs:
        tokens = decontam.words(text)
        for i, item in items:
            (asked, told), size = decontam.question_answer(item), max(8, len(decontam.words(item)))
            step = max(4, size // 2)
            for at in range(0, max(1, len(tokens) - size + 1), step):
                passage = tokens[at : at + size + step]
                if plain_overlap(asked, passage) >= 0.6 and plain_overlap(told, passage) >= 0.5:
                    want.add((doc, i))
    return want


def quotes(seed):
    """Items of common and rare words; documents that quote parts of them, reword them or change the rare words."""
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(40)], (f"r{i}" for i in range(10**6))
    items, docs = [], []
    for i in range(60):
        asked, told = ([rng.choice(common) if rng.random() < 0.7 else next(rare) for _ in range(rng.randrange(*n))] for n in ((8, 40), (1, 20)))
        items.append((i, f"{' '.join(asked)}? {' '.join(told)}."))
        for _ in range(4):
            a, b = list(asked), list(told)
            kind = rng.randrange(3)
            if kind == 0:  # quoted in a row
                a, b = a[len(a) * 3 // 10 :], b[: (len(b) * 6 + 9) // 10]
            else:
                for part in (a, b):
                    for at in range(len(part)):
                        if (part[at][0] == "r" and rng.random() < 0.5) if kind == 1 else rng.random() < 0.08:
                            part[at] = f"x{rng.randrange(10**6)}"
            around = [rng.choice(common) for _ in range(rng.randrange(0, 60))]
            docs.append((len(docs), " ".join(around + a + b + around[::-1])))
    asked, told = [f"q{i}" for i in range(100)], [f"a{i}" for i in range(50)]
    items.append((1000, f"{' '.join(asked)}? {' '.join(told)}."))
    docs.append((1000, " ".join(asked[39:] + told[:26])))  # 0.58 of the item's score
    items += [(i, f"{' '.join(common)} number{i} again") for i in range(2000, 2040)]
    return items, docs


@pytest.mark.parametrize("seed", range(3))
def test_partial_quotes_against_all_pairs(spark, seed):
    items, docs = quotes(seed)
    bench, table = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    want = leaks_of_all_pairs(items, docs)
    got = {(r.doc_id, r.item_id): r.score for r in decontam.find(table, bench).collect()}
    assert set(got) == want and (1000, 1000) in want
    assert min(got.values()) < 0.5  # below the threshold, as the words left out are the rare ones


def test_long_items_and_shards_change_nothing(spark):
    """A question quoted alone is no leak because its one-word answer stands far off, whatever the longest item is."""
    asked = [f"q{i}" for i in range(39)]
    apart = [f"z{i}" for i in range(300)]
    items = [(1, f"{' '.join(asked)}? yes."), (2, "who was it that came to see the geese? nobody.")]
    long = [(3, f"{' '.join(f'l{i}' for i in range(4000))}? {' '.join(f'm{i}' for i in range(1000))}.")]
    docs = [(1, " ".join([*asked, *apart, "yes", *apart])), (2, " ".join([*apart, *asked, "yes", *apart])), (3, " ".join([*apart, "nobody", *asked]))]
    docs.append((4, "x " * 2000 + long[0][1] + " y" * 3000))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for some in (items, items + long):
        bench, want = spark.createDataFrame(some, "item_id long, text string"), leaks_of_all_pairs(some, docs)
        assert {p for p in want if p[1] < 3} == {(2, 1)}
        for shard in (2000, 1):
            assert {(r.doc_id, r.item_id) for r in decontam.find(table, bench, shard_items=shard).collect()} == want
        assert {r.doc_id for r in decontam.clean(table, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_planted_leaks(spark, folder):
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: decontam.words(r.text) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        text = " ".join(decontam.words(r.text))
        want |= {(r.doc_id, i) for i, w in items.items() if f" {' '.join(w)} " in f" {text} "}
    got = {(r.doc_id, r.item_id) for r in decontam.find(docs, bench).collect()}
    assert len(want) > 20 and got == want


def test_quality_on_held_out_labels(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.quality(docs, labels).join(labels, "doc_id").where(quality.held_out()).collect()
    right = [r.predicted == r.quality for r in scored]
    bad = [r.predicted == 0 for r in scored if r.quality == 0]
    good = [r.predicted == 1 for r in scored if r.quality == 1]
    assert len(scored) > 60 and np.mean(right) > 0.97 and np.mean(bad) > 0.85 and np.mean(good) > 0.97


def test_quality_never_learns_from_held_out(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    pick = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert pick(quality.quality(docs, labels)) == pick(quality.quality(docs, flipped))


def test_quality_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (3, 1), (4, 1), (4, 1), (5, None), (99, 1)], "doc_id long, quality int")
    rows = quality.quality(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(none, labels).count() == 0


def test_gam_learns_a_pair():
    x = np.random.default_rng(2).random((3000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.Gam(rounds=30).fit(x[:2000], y[:2000])
    assert (3, 0) in model.pairs and ((model.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.9


def plain_edits(rows):
    """doc -> edited text, by the order of the ids."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 4
        out[doc] = text[: len(text) - n] + after[:n]
    return out


def test_fingerprints_and_edits(spark, text_of):
    rows = [(i * 3, text_of(i, 40 + i % 300) if i % 11 else ("" if i % 2 else None)) for i in range(1500)]
    rows += [(10_000, text_of(5, 45)), (10_001, "é\U0001f600" * 9), (None, "no id at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    words = fingerprints.lexicon(docs)
    got = {r.doc_id: r for r in fingerprints.prints(docs, words).collect()}
    assert len(got) == len(rows)
    edits, texts = plain_edits(rows), dict(rows)
    order = sorted(texts, key=lambda d: (d is not None, d or 0))
    for doc, r in got.items():
        assert r.n_chars == len(texts[doc] or "")
        assert r.edited_sha256 == hashlib.sha256(edits[doc].encode()).hexdigest()
        assert r.fingerprint == fingerprints.fingerprint(texts[doc], words)
        assert r.edited_fingerprint == fingerprints.fingerprint(edits[doc], words)
        after = got[order[(order.index(doc) + 1) % len(order)]]
        assert r.near_next == fingerprints.likeness(r.fingerprint, after.fingerprint)
    assert got[10_000].fingerprint == got[15].fingerprint


def test_lexicon_is_a_band(spark):
    docs = spark.createDataFrame([(i, f"the word{i % 10} rare{i}") for i in range(100)], "doc_id long, text string")
    assert fingerprints.lexicon(docs, rare=0.05, common=0.2) == {f"word{i}" for i in range(10)}


def test_near_is_nearer_than_next(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = fingerprints.prints(docs, fingerprints.lexicon(docs)).collect()
    assert np.mean([r.near_edited for r in rows]) > 0.35 and np.mean([r.near_next for r in rows]) < 0.1
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95


def test_fingerprints_odd(spark, odd, none):
    words = fingerprints.lexicon(odd)
    assert fingerprints.prints(odd, words).count() == odd.count()
    assert fingerprints.prints(none, fingerprints.lexicon(none)).count() == 0
    one = fingerprints.prints(odd.where("doc_id = 4"), words).first()
    assert one.near_next == 1.0  # its own follower


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(50), r, i) for i in range(rng.randrange(30))) for r in range(k)]
    assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_archives(spark, text_of):
    same, other = text_of(1, 400), text_of(2, 400)
    rows = [(i, f"http://www.Site{i % 7}.example.com/p{i % 40}?q={i}#top", f"<p>{i}</p>" + text_of(i, 50)) for i in range(500)]
    rows += [(1000 + i, "http://hot.example.com/", same if i % 3 else other) for i in range(300)]
    rows += [(2000, None, None), (2001, "", ""), (2002, "http://x/\r\nWARC-Type: forged", "tiny"), (2003, "http://x/", "tiny"),
             (2004, "http://[bad", same), (None, "http://n/", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("clash")).repartition(6)
    folder, index = warc.archive(pages)
    read = {r.page_id: r for r in warc.read(index, folder).collect()}
    assert len(read) == len(rows) and all(r.intact for r in read.values())
    texts = {i: (h or "").encode() for i, _, h in rows}
    for page, payload in texts.items():
        r = read[page]
        first = max((p for p, t in texts.items() if t == payload and p is not None), default=None)
        revisit = len(payload) >= 1000 and page != first
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
    placed = [(r.urlkey, r.ts, r.page_id is not None, r.page_id or 0) for r in index.orderBy("range", "place").collect()]
    assert placed == sorted(placed) and len(placed) == len(rows)
    assert index.where("file like 'part-%' and length > 0").count() == len(rows)
    files = [p for p in Path(folder).glob("*.warc.gz")]
    assert sum(zlib.decompress(f.read_bytes(), 31).startswith(b"WARC/1.1\r\n") for f in files) == len(files)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder, index = warc.archive(pages)
    assert warc.read(index, folder).count() == 0


def test_url_keys():
    assert warc.url_key("https://WWW.b.Example.com:80/Path?Q=1#x") == "com,example,b)/path?q=1"
    assert warc.url_key(None) == "-" and warc.url_key("http://[bad") == "http://[bad"


def test_cut_decides_what_is_retrieved(text_of):
    items = [(i, text_of(i, 20 + i % 30)) for i in range(40)]
    df = {}
    for _, t in items:
        for w in set(decontam.words(t)):
            df[w] = df.get(w, 0) + 1
    index = decontam.build_index(items, df, len(items), 30.0)
    texts = [decontam.words(f"{text_of(99 + i, 50)} {items[i][1]}" if i % 2 else text_of(99 + i, 9000)) for i in range(6)]
    numbers, sizes = np.array([index.terms.get(w, -1) for t in texts for w in t]), np.array([len(t) for t in texts])

    def plain(cut):
        """Every passage of a class against every item of the class."""
        want = set()
        for lists in index.classes:
            step = decontam.stride(lists.longest)
            for t, tokens in enumerate(texts):
                for begin in range(0, len(tokens), step):
                    scores = plain_bm25(tokens[begin : begin + decontam.SPAN * step], items, df) if begin < 2000 else {}
                    want |= {(t, begin, i) for i, s in scores.items() if s >= cut and i in index.ids[lists.places[0] : lists.places[-1]]}
        return want

    for cut in (0.2, 0.6, 2.0):
        got = {
            (t, b, index.ids[p])
            for lists in index.classes
            for rows in decontam.retrieve(numbers, sizes, lists, np.full(len(items), cut))
            for t, b, p in zip(*(r.tolist() for r in rows), strict=True)
        }
        assert {g for g in got if g[1] < 2000} == plain(cut)
        assert bool(got) == (cut < 1)
    search = decontam.build_search(index, 0.5, 0.6, 0.5)
    quoted = [" ".join(t) for t in texts]
    assert [{leak[0] for leak in found} for found in decontam.leaks(quoted, search)] == [{i} if i % 2 else set() for i in range(6)]
    search.cuts[:] = 1.1
    assert not any(decontam.leaks(quoted, search))
