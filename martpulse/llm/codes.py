"""Product codes of vectors: codebooks by Lloyd rounds that Drake and Hamerly's adaptive bounds keep from measuring all distances.

Vectors of whole numbers, floor(256 * x), are cut into ``parts`` equal parts. Every part position has a codebook of ``entries``
entries, at first those parts of the vectors with the smallest ids; a round assigns every part to its nearest entry (ties to the
lower index) and moves every entry to the floor of its parts' mean. Unused entries stay.

A stored row carries, for each part, its entry, the ``b`` entries next in distance in order, a lower bound for each, and one
outer bound for all others. When entries have moved, bounds fall by these moves, and the exact distance to the part's own entry
is held against them in order: below the first bound, nothing can have changed; below a later one, only the entries
before it are measured, in whole numbers; not even below the outer bound, all are. ``b`` begins at a quarter of the entries and is
chosen anew per part position after every round, by the cost of keeping bounds against that of measuring all.

Distances are compared as whole numbers only. Bounds are doubles, stored in 16 bits rounded down; they decide nothing closer than
a part in 10^9, so a tie or near tie is always measured. A round is one pass over the stored rows and one fold of sums to a
row per entry and component: entries are all that reaches the driver.

Defined cases: vectors that are null or hold nulls or components that are not finite are left out; the others are filled up with zeros to
the longest length, rounded up to a multiple of ``parts``; fewer vectors than entries make fewer entries; equal ids are
ordered by vector, null ids come last; repeated rows count each; an empty table gives no rows; other columns are ignored.
Numbers too large for exact doubles are computed as Python's integers, all distances measured; an error beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martpulse.llm.store import pieces, settle
from martpulse.llm.vectors import EXACT, matrix, sound, whole

SURE = 1e-9  # relative; far beyond what square roots of exact doubles err by
STATE = "id long, label string, vector array<{kind}>, code binary, near binary, bounds binary, need binary, error long"
LABELS = 16  # salts of the join with the errors of labels


@dataclass
class Codebooks:
    """Entries of all parts, as whole numbers: (parts, entries, width)."""

    values: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.values.flat).encode()).hexdigest()


def down(bounds: np.ndarray) -> np.ndarray:
    """Lower bounds in 16 bits, never above what they were."""
    with np.errstate(over="ignore"):
        short = bounds.astype(np.float16)
    return np.where(short.astype(np.float64) > bounds, np.nextafter(short, np.float16(-np.inf)), short).astype(np.float16)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries)."""
    return (x * x).sum(1)[:, None] + (entries * entries).sum(1)[None] - 2 * (x @ entries.T)


def measured(x: np.ndarray, entries: np.ndarray, b: int):
    """(code, squared distance, b next entries, their bounds with the outer bound last), all distances measured."""
    distances = squared(x, entries)
    code = distances.argmin(1)  # the first of the smallest
    rows = np.arange(len(x))
    own = distances[rows, code]
    apart = np.sqrt(distances.astype(np.float64)) * (1 - SURE)
    apart[rows, code] = -1
    order = np.argsort(apart, axis=1, kind="stable")[:, 1 : b + 2]
    bounds = np.take_along_axis(apart, order, 1)
    if bounds.shape[1] < b + 1:
        bounds = np.concatenate([bounds, np.full((len(x), b + 1 - bounds.shape[1]), np.inf)], axis=1)
    return code, own, order[:, :b], bounds


def reassigned(x, entries, before, code, near, bounds, keep: int):
    """As ``measured``, from what the last round left, and the rank that each row had to measure up to (b + 1: all)."""
    n, b = near.shape
    moved = np.sqrt(np.square(entries - before).sum(1)) * (1 + SURE)
    own = np.square(x - entries[code]).sum(1)
    upper = np.sqrt(own) * (1 + SURE)
    low = bounds.astype(np.float64) - np.concatenate([moved[near], np.full((n, 1), moved.max())], axis=1)
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]  # each holds for all entries from its rank on
    sure = upper[:, None] < low
    need = np.where(sure.any(1), sure.argmax(1), b + 1)
    code, near = code.copy(), near.copy()

    some = np.flatnonzero((need > 0) & (need <= b))
    if len(some):
        m = need[some].max()
        ranks = need[some, None]
        found = np.concatenate([code[some, None], near[some, :m]], axis=1)
        distances = np.square(x[some, None] - entries[found]).sum(2)
        out = np.arange(m + 1) > ranks
        order = np.lexsort((found, np.where(out, np.inf, distances)), axis=-1)
        found = np.take_along_axis(found, order, 1)
        distances = np.take_along_axis(distances, order, 1)
        code[some], own[some] = found[:, 0], distances[:, 0]
        within = np.arange(m) < ranks
        near[some, :m] = np.where(within, found[:, 1:], near[some, :m])
        low[some, :m] = np.where(within, np.sqrt(distances[:, 1:]) * (1 - SURE), low[some, :m])
        low[some] = np.minimum.accumulate(low[some, ::-1], axis=1)[:, ::-1]
    low = np.concatenate([low[:, :keep], low[:, keep:].min(1)[:, None]], axis=1)  # entries that are no longer kept go to the rest
    near = near[:, :keep]
    rest = np.flatnonzero(need > b)
    if len(rest):
        code[rest], own[rest], near[rest], low[rest] = measured(x[rest], entries, keep)
    return code, own, near, low, need


def _assign(now: np.ndarray, before: np.ndarray | None, kept: list[int], keep: list[int], kind: str, last: bool):
    """One round over stored rows; ``before`` are the last entries, ``kept`` the lists' lengths as stored, ``keep`` as to store."""
    parts, entries, width = now.shape
    largest = max(abs(int(x)) for x in now.flat)
    arrow = pa.list_(pa.float32() if kind == "float" else pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2000):
            x = matrix(batch["vector"], parts * width).reshape(batch.num_rows, parts, width)
            bound = 4 * parts * width * max(largest, np.abs(x).max(initial=0)) ** 2
            exact, books = whole(x, bound), whole(now, bound)
            n = len(x)
            fast = before is not None and bound < EXACT
            if fast:
                code = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                near = np.frombuffer(b"".join(batch["near"].to_pylist()), np.uint8).reshape(n, -1)
                low = np.frombuffer(b"".join(batch["bounds"].to_pylist()), np.float16).reshape(n, -1)
                starts = np.cumsum([0, *kept])
            out = []
            for p in range(parts):
                if fast:
                    a, z = starts[p], starts[p + 1]
                    out.append(reassigned(
                        exact[:, p], books[p].astype(np.float64), before[p].astype(np.float64), code[:, p],
                        near[:, a:z].astype(np.int64), low[:, a + p : z + p + 1], keep[p],
                    ))
                else:
                    out.append((*measured(exact[:, p], books[p], keep[p]), np.full(n, kept[p] + 1)))
            errors = [sum(int(o[1][i]) for o in out) for i in range(n)] if bound >= EXACT else sum(o[1] for o in out).astype(np.int64).tolist()
            held = lambda cells, kind: [r.tobytes() for r in np.concatenate(cells, axis=1).astype(kind)] if n else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"], batch["label"], batch["vector"].cast(arrow),
                    pa.array(held([o[0][:, None] for o in out], np.uint8), pa.binary()),
                    pa.array([b""] * n if last else held([o[2] for o in out], np.uint8), pa.binary()),
                    pa.array([b""] * n if last else held([down(o[3]) for o in out], np.float16), pa.binary()),
                    pa.array(held([o[4][:, None] for o in out], np.uint8), pa.binary()),
                    pa.array([e if e < 1 << 63 else None for e in errors], pa.int64()),
                ],
                names=["id", "label", "vector", "code", "near", "bounds", "need", "error"],
            )

    return run


COUNT, NEED = -1, -2  # places of a sum row that hold no component


def _sums(parts: int, entries: int, width: int):
    """Sums and counts per entry, and how many rows needed which rank, folded per task: (part, entry, place, total)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width))
        large: dict[tuple[int, int, int], int] = {}
        counts, needs = np.zeros((parts, entries), np.int64), np.zeros((parts, 256), np.int64)
        for batch in pieces(batches, 2000):
            x = matrix(batch["vector"], parts * width).reshape(batch.num_rows, parts, width)
            code = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(-1, parts)
            need = np.frombuffer(b"".join(batch["need"].to_pylist()), np.uint8).reshape(-1, parts)
            exact = np.abs(x).max(initial=0) < 1 << 21
            for p in range(parts):
                counts[p] += np.bincount(code[:, p], minlength=entries)
                needs[p] += np.bincount(need[:, p], minlength=256)
                for d in range(width) if exact else ():
                    totals[p, :, d] += np.bincount(code[:, p], x[:, p, d], entries)
            if not exact:
                for (i, p, d), value in np.ndenumerate(x):
                    key = (p, int(code[i, p]), d)
                    large[key] = large.get(key, 0) + int(value)
        rows = [(p, e, d, int(totals[p, e, d]) + large.get((p, e, d), 0)) for p, e in zip(*counts.nonzero(), strict=True) for d in range(width)]
        rows += [(p, e, COUNT, counts[p, e]) for p, e in zip(*counts.nonzero(), strict=True)]
        rows += [(p, r, NEED, needs[p, r]) for p, r in zip(*needs.nonzero(), strict=True)]
        if rows:
            part, entry, place, total = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(x) for x in part], pa.int32()), pa.array([int(x) for x in entry], pa.int32()),
                    pa.array(place, pa.int32()), pa.array([Decimal(int(x)) for x in total], pa.decimal128(38, 0)),
                ],
                names=["part", "entry", "place", "total"],
            )

    return run


def lengths(needs: dict[tuple[int, int], int], kept: list[int], entries: int) -> list[int]:
    """How many next entries to keep per part: every one costs its upkeep per row, a rank beyond them all distances."""
    out = []
    for p, b in enumerate(kept):
        rows = sum(n for (q, _), n in needs.items() if q == p)
        cost = lambda size: rows * size + entries * sum(n for (q, r), n in needs.items() if q == p and r > size)  # noqa: E731, B023
        out.append(min(range(min(1, b), b + 1), key=cost, default=b))
    return out


def compress(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2,
    id_column: str = "vec_id", column: str = "embedding", label: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """(id, label as text, vector, code, error) of every sound row, and the codebooks after ``rounds`` rounds.

    ``code`` has one byte per part, so ``entries`` is at most 256.
    """
    spark = vectors.sparkSession
    kind = "float" if dict(vectors.dtypes)[column] == "array<float>" else "double"
    rows = sound(vectors, column).select(
        F.col(id_column).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(column).alias("vector")
    )
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    schema = STATE.format(kind=kind)
    if longest is None:
        return spark.createDataFrame([], schema), None
    width = max(1, -(-longest // parts))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()  # the first entries
    start = matrix(pa.array([r.vector for r in first], pa.list_(pa.float64())), parts * width)
    now = whole(start, EXACT).reshape(len(first), parts, width).transpose(1, 0, 2)
    entries = len(first)

    before, kept = None, [min(max(1, entries // 4), entries - 1)] * parts
    keep, state = kept, rows
    for turn in range(rounds + 1):
        last = turn == rounds
        state = settle(state.mapInArrow(_assign(now, before, kept, keep, kind, last), schema), f"codes-{turn}")
        if last:
            break
        totals = (
            state.select("vector", "code", "need").mapInArrow(
                _sums(parts, entries, width), "part int, entry int, place int, total decimal(38,0)"
            )
            .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))
            .collect()  # one row per part, entry and component
        )
        found = {(r.part, r.entry, r.place): int(r.total) for r in totals}
        kept, before = keep, now
        now = now.copy()
        for (p, e, place), total in found.items():
            if place >= 0:
                now[p, e, place] = total // found[p, e, COUNT]
        if turn:
            keep = lengths({(p, r): n for (p, r, place), n in found.items() if place == NEED}, kept, entries)
    return state.select("id", "label", "vector", "code", "error"), Codebooks(now)


def hexed(code: Column) -> Column:
    return F.lower(F.hex(code))


def report(coded: DataFrame, books: Codebooks | None) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256). Labels are folded per task, and the join with them is salted."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(LABELS - 1))).alias("part"))
    rows = coded.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(LABELS)).cast("int"))
    met = rows.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("part")))
    return met.select(
        F.col("id").alias("vec_id"), hexed(F.col("code")).alias("code"), "error", "label_error",
        F.lit(books.sha256 if books else None).cast("string").alias("codebooks_sha256"),
    )
