"""Phrase mining against counts of every n-gram of the whole texts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from martpulse.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top=2000, cover=80):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    own[tuple(w[i : i + k])] += 1
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * a >= cover * own[p[i : i + k]]
        }
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def texts(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "é", " ", "a-b", "W3", "\U0001f600"]
    passage = " ".join(rng.choice(words) for _ in range(70))
    out = []
    for _ in range(60):
        parts = [rng.choice(words) + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " \r"]) for _ in range(rng.randrange(120))]
        out.append((rng.choice(["en", "en", "de", None, "und"]), "".join(parts) + (passage if rng.random() < 0.4 else "")))
    return out + [("en", None), ("en", ""), (None, " \t\n.,"), ("fr", "only once"), out[0], out[0], ("en", "same " * 3000), ("", "no lang " * 40)]


@pytest.mark.parametrize(("seed", "options"), [
    (1, {}), (2, {"every": 3, "longest": 5}), (3, {"every": 10**9}), (4, {"bits": 15}), (5, {"every": 1, "top": 7}),
])
def test_equals_counts_of_all_n_grams(spark, seed, options):
    rows = texts(seed)
    df = spark.createDataFrame([(lang, text, "x", 1) for lang, text in rows], "lang string, text string, phrase string, n int")
    got = mined(df.repartition(4), least=5, **options)
    assert got and got == plain(rows, 5, options.get("top", 2000))


def test_empty_table(spark, none):
    assert mined(none) == []


def test_odd_rows(spark, odd):
    df = odd.withColumnRenamed("size", "lang")
    assert mined(df, least=2) == plain([(r.lang, r.text) for r in df.collect()], 2)


@pytest.mark.parametrize("every", [1, 4, 50])
def test_chunks_cover_every_n_gram_once(every):
    rng = random.Random(every)
    words = np.array([f"w{rng.randrange(9)}" for _ in range(900)], dtype=object)
    starts = np.array(sorted({0, *(rng.randrange(900) for _ in range(60))}))
    at = phrases.cuts(phrases._keys(words), starts, every, 40)
    assert set(starts) <= set(at.tolist()) and np.diff(np.append(at, 900)).max() <= 40
    # cuts within a piece leave a whole window before its end, and the same content is cut alike
    alone = phrases.cuts(phrases._keys(words[starts[3] : starts[4]]), np.array([0]), every, 40)
    assert (at[(at >= starts[3]) & (at < starts[4])] - starts[3]).tolist() == alone.tolist()


def test_shared_passages_share_their_chunks(spark):
    """A passage within different texts is read from a few chunks, however often it occurs."""
    rng = random.Random(0)
    passage = " ".join(f"p{rng.randrange(50)}" for _ in range(300))
    rows = [("en", f"own{i} words{i} " * (i % 7 + 1) + passage) for i in range(200)]
    chunks = phrases.parse(spark.createDataFrame(rows, "lang string, text string").repartition(5), every=16).collect()
    inside = [c for c in chunks if "own" not in c.chunk]
    assert sum(c.own * c.n for c in chunks) == sum(len(t.split()) for _, t in rows)
    assert max(c.n for c in inside) == 200 and sum(c.own for c in inside) < 400
