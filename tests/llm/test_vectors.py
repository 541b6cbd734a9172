"""Vector codes and exact search against brute force; bounds, ties, odd rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martpulse.llm import codes, search

SCHEMA = "vec_id long, embedding array<double>, label int, code string, rank int, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 9, "y") for i, v, label in rows], SCHEMA).repartition(3)


def is_sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [math.floor(256 * x) for x in v]


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted(((i, whole(v), label) for i, v, label in rows if is_sound(v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    cut = [[(v + [0] * (parts * width))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = [nearest(x[p], p)[1] for x in cut]
            new.append([
                [sum(c) // len(c) for c in zip(*[x[p] for x, o in zip(cut, own, strict=True) if o == k], strict=True)] if k in own else e
                for k, e in enumerate(books[p])
            ])
        books = new
    coded = [[nearest(x[p], p) for p in range(parts)] for x in cut]
    errors = [sum(d for d, _ in c) for c in coded]
    labels = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        labels[label] = labels.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in c), e, labels[label], sha) for (i, _, label), c, e in zip(kept, coded, errors, strict=True)),
        key=repr,
    )


def coded(df, **options):
    return sorted((tuple(r) for r in codes.report(*codes.compress(df, **options)).collect()), key=repr)


def gathered(seed, n, dims=32, spread=0.3, groups=9):
    """Vectors around a few centres, a third of them equal, with odd rows among them."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    rows = [(i, (centres[i % groups] + spread * rng.normal(size=dims)).tolist(), i % 5 or None) for i in range(n)]
    rows = [(i, centres[0].tolist() if i % 3 == 0 else v, label) for i, v, label in rows]
    odd = [(n, None, 1), (n + 1, [], 1), (n + 2, [0.5] * 7, 1), (n + 3, [math.nan] * dims, 1), (n + 4, [math.inf] + [0.0] * (dims - 1), 1),
           (n + 5, [None] + [0.0] * (dims - 1), 2), (None, [0.25] * dims, None), (5, [0.125] * dims, 3), (5, [0.125] * dims, 3)]
    return rows + odd


@pytest.mark.parametrize(("seed", "n", "rounds"), [(1, 400, 2), (2, 40, 2), (3, 700, 5)])
def test_codes_equal_brute_force(spark, seed, n, rounds):
    rows = gathered(seed, n)
    assert coded(frame(spark, rows), rounds=rounds) == plain_codes(rows, rounds=rounds)


def test_codes_of_ties_and_single_rows(spark):
    same = [(i, [0.5] * 16, 1) for i in range(100)]
    assert coded(frame(spark, same)) == plain_codes(same)
    assert coded(frame(spark, same[:1])) == plain_codes(same[:1])
    grid = [(i, [float(i % 4) / 256 + d % 2 / 128 for d in range(16)], None) for i in range(90)]
    assert coded(frame(spark, grid)) == plain_codes(grid)


def test_codes_of_huge_numbers_are_exact(spark):
    rows = [(i, [(-1) ** i * (1e7 + i * 1e5 + d / 3) for d in range(16)], i % 2) for i in range(80)]
    assert coded(frame(spark, rows)) == plain_codes(rows)


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [None], 1)]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        assert coded(df) == []
        assert search.top(df, F.col("vec_id") >= 0).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_spare_distances(seed):
    """After any moves of the entries, bounds lie below the true distances, and most rows measure few entries."""
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(600, 4)) * 60)
    before = x[:64].copy()
    code, own, near, bounds = codes.measured(x, before, 16)
    spared = 0
    for turn in range(5):
        entries = np.floor(before + rng.normal(size=before.shape) * (3 - turn / 2))
        keep = max(4, near.shape[1] - 3)
        code, own, near, bounds, need = codes.reassigned(x, entries, before, code, near, codes.down(bounds), keep)
        true = codes.squared(x, entries)
        assert (code == true.argmin(1)).all() and (own == true.min(1)).all()
        apart = np.sqrt(true)
        rows = np.arange(len(x))[:, None]
        assert (bounds[:, :-1] <= apart[rows, near]).all()
        rest = np.ones(true.shape, bool)
        rest[rows, near] = False
        rest[rows[:, 0], code] = False
        assert (bounds[:, -1] <= np.where(rest, apart, np.inf).min(1)).all()
        spared += (need <= keep + 3).mean()
        before = entries
    assert spared > 2.5


def test_bounds_in_16_bits_never_rise():
    values = np.array([0.0, 1e-9, 1.0, 300.123, 65504.0, 1e9, np.inf, -3.3])
    assert (codes.down(values).astype(float) <= values).all()


def test_lists_get_shorter_where_long_ones_do_not_pay():
    assert codes.lengths({(0, 0): 1000, (0, 3): 1}, [16], 64) == [1]
    assert codes.lengths({(0, 0): 10, (0, 16): 1000}, [16], 64) == [16]


def plain_search(rows, asks, k=5):
    kept = [(i, whole(v)) for i, v, _ in rows if is_sound(v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in kept if i is not None and asks(i)}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j is None, j or 0) for j, v in kept if j != i)
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("dims", "seeds"), [(32, 64), (5, 4), (24, 3)])
def test_search_equals_brute_force(spark, dims, seeds):
    rows = gathered(4, 500, dims)
    found = search.top(frame(spark, rows), F.col("vec_id") % 10 == 0, rows=64, query_rows=16, salts=4, seeds=seeds)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_search(rows, lambda i: i % 10 == 0)


def test_search_with_few_candidates_ties_and_huge_numbers(spark):
    rows = [(i, [0.5, -0.25], None) for i in (0, 50, 7, 9)]
    found = search.top(frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(r) for r in found) == plain_search(rows, lambda i: i % 50 == 0)
    rows = [(i, [(-1) ** (i // 2) * (3e5 + i / 7) for _ in range(8)], None) for i in range(60)]
    found = search.top(frame(spark, rows), F.col("vec_id") % 7 == 0, rows=16).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_search(rows, lambda i: i % 7 == 0)


def test_search_reads_fewer_candidates_from_block_to_block():
    """With a threshold, candidates fall out before the last dimension block."""
    rng = np.random.default_rng(3)
    body = np.floor(rng.normal(size=(64, 3000)) * 30 * np.exp(-np.arange(64) / 12)[:, None])
    query = body[:, 0].copy()
    block = search.Block(np.arange(3000), body, np.arange(64))
    exact = query @ body
    least = np.sort(exact[1:])[-5]
    scores, ids = block.search(query, 0, least, 5)
    want = search.best(exact[1:], np.arange(1, 3000), 5)
    assert scores.tolist() == want[0].tolist() and ids.tolist() == want[1].tolist()
    early = (exact * 0 + query[:16] @ body[:16] + block.left[1] * np.sqrt((query[16:] ** 2).sum())) >= least
    assert early.mean() < 0.5
