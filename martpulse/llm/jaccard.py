"""N-gram Jaccard join by universe partition, with an exact result.

A document's set holds the hashes (64 bits) of its distinct word n-grams. Two sets link when their Jaccard similarity is at
least ``percent`` / 100. Linked sets differ in at most H tokens, where H follows from their sizes. Sizes are cut into
bands so that linked sets lie in one band or in neighbours, and for every band the universe of tokens is hashed into
segments, so that few segments can differ:

* exact: with more than H segments, some segment of two linked sets is equal; every segment is one key. Empty segments
  would make keys that many sets share, so the partition has ``spare`` more segments than that and sets leave their empty ones
  out, unless they have more than ``spare`` of them (then they emit those too; two such sets still meet).
* one deletion: with more than H / 2 segments, some segment differs in at most one token; keys are the segment and
  each of it with one token left out.

The mode of a band is allocated by cost: keys to write, against the meetings of its different sets under either mode. These are
measured over all sets, by signed counts of their keys. Each set writes keys for its own band and, as the larger side, for the band
below.

Equal sets need no join: they are one class, named by its smallest doc_id. Of the sets that share a key, each is
first verified against the smallest doc_id of the key. The components found so far then settle most groups of copies: only pairs across
components are formed, and all of them, so no link between components is lost, while links within one change nothing.
A parity sketch of 512 bits (each differing token flips one bit) drops pairs that cannot link, one of at least as many bits as
tokens (the outline) those of larger sets, before their sets are compared; comparison is exact, and only the sets of pairs left are
built.

Defined cases: null or empty texts have no set and link with nothing; with fewer words than n the whole sequence is
the one token; rows sharing a doc_id are one document; a null doc_id gets n_shingles and no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from martpulse.llm.components import components
from martpulse.llm.store import pieces, settle

ODD = np.uint64(0x9E3779B97F4A7C15)  # the usual odd multiplier
SHIFT = np.uint64(31)
SKETCH = 8  # longs
TALLY = 32  # signed counts per mode


class WordHashes(dict):
    """Hashes of words seen by this process; emptied when it holds very many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


HASHES = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * ODD
    return x ^ (x >> SHIFT)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of word n-grams; words are split at ASCII white space after A-Z were lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    acc = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        acc = mix(acc + ids[k : k + len(acc)])
    return np.unique(acc)


def most_apart(total: int, percent: int) -> int:
    """Largest symmetric difference of linked sets whose sizes add up to at most ``total``."""
    return (100 - percent) * total // (100 + percent)


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int
    apart: int
    segments: int
    spare: int
    deletion: bool


def band_of(size: int, percent: int) -> int:
    return _band_at(size, percent)[0]


def _band_at(size: int, percent: int) -> tuple[int, int]:
    """The number of the band of a size, and the smallest size in it."""
    low, number = 1, 0
    while (high := low * 100 // percent) < size:
        low, number = high + 1, number + 1
    return number, low


def modes(number: int, low: int, percent: int) -> tuple[Band, Band]:
    """A band with exact segments, and with one deletion."""
    high = low * 100 // percent
    apart = most_apart(high + high * 100 // percent, percent)
    fill = low / (apart + 1)
    spare = math.ceil((apart + 1) * 1.2 * math.exp(-fill) + 4 * math.sqrt((apart + 1) * math.exp(-fill))) if apart else 0
    return Band(number, low, high, apart, apart + 1 + spare, spare, False), Band(number, low, high, apart, (apart + 2) // 2, 0, True)


def bands(counts: dict[int, int], percent: int, met: dict[int, tuple[float, float]] | None = None) -> dict[int, Band]:
    """Bands for sizes with their numbers of sets, and the mode of each by expected cost.

    ``met`` has the pairs of sets that share keys under either mode, by band; without it, one in a hundred lone tokens counts as equal.
    """
    out, low, number = {}, 1, 0
    largest = max(counts, default=0)
    while low <= largest:
        exact, deletion = modes(number, low, percent)
        held = sum(c for s, c in counts.items() if low <= s <= exact.high)
        written = held * (exact.apart + 1), held * (deletion.segments + deletion.high)
        if met is None:
            meetings = tuple(
                0.01 * held * held / 2 * n * (fill * math.exp(-fill)) ** 2  # chance that a segment holds a single token
                for n, fill in ((exact.apart + 1, low / (exact.apart + 1)), (deletion.segments + deletion.high, low / deletion.segments))
            )
        else:
            meetings = met.get(number, (0, 0))
        out[number] = deletion if written[1] + meetings[1] < written[0] + meetings[0] else exact
        low, number = exact.high + 1, number + 1
    return out


def keys(tokens: np.ndarray, band: Band) -> np.ndarray:
    """The keys of one set under the partition of one band."""
    salt = np.uint64((band.number + 1) * int(ODD) % 2**64)
    mixed = mix(tokens + salt)
    at = ((mixed >> np.uint64(33)) % np.uint64(band.segments)).astype(np.int64)
    sums = np.zeros(band.segments, np.uint64)
    np.add.at(sums, at, mixed)
    names = mix(np.arange(1, band.segments + 1, dtype=np.uint64) + salt)
    if band.deletion:
        less = mix(sums[at] - mixed + names[at])
        return np.unique(np.concatenate([mix(sums + names), less])).view(np.int64)
    full = np.bincount(at, minlength=band.segments) > 0
    if band.segments - full.sum() > band.spare:
        full[:] = True
    return mix(sums[full] + names[full]).view(np.int64)


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of the number of tokens per bit."""
    bits = np.bincount((mix(tokens) >> np.uint64(55)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _outline(tokens: np.ndarray) -> bytes | None:
    """Parity of the number of tokens per bit, with a power of two of bits, as many as tokens at least; none where the sketch has that."""
    bits = 1 << (len(tokens) - 1).bit_length()
    if bits <= 64 * SKETCH:
        return None
    return np.packbits((np.bincount((mix(tokens) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def _flipped(x: bytes, y: bytes) -> int:
    """Bits in which two outlines differ; the longer one is folded to the length of the other."""
    p, q = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(p) < len(q):
        q = q[: len(q) // 2] ^ q[len(q) // 2 :]
    return int(np.bitwise_count(p ^ q).sum())


def _tally(tokens: np.ndarray, percent: int) -> bytes:
    """For either mode of the set's own band: its number of keys, and their signed counts.

    Summed over sets, the squares of the signed counts add up to those of the frequencies of keys, within a quarter or so.
    """
    out = np.zeros((2, 1 + TALLY), np.int32)
    for row, band in zip(out, modes(*_band_at(len(tokens), percent), percent), strict=True):
        found = mix(keys(tokens, band).view(np.uint64))
        signs = 1.0 - 2.0 * (found & np.uint64(1))
        row[0] = len(found)
        row[1:] = np.bincount((found >> np.uint64(59)).astype(np.int64), weights=signs, minlength=TALLY)
    return out.tobytes()


def meetings(distinct: DataFrame, percent: int) -> dict[int, tuple[float, float]]:
    """By band, the pairs of its different sets that share a key, for either mode, counted once for every key they share."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in pieces(batches):
            tallies = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32).reshape(batch.num_rows, -1)
            own = np.array([band_of(s, percent) for s in batch.column(0).to_pylist()])
            for number in set(own.tolist()):
                sums[number] = sums.get(number, 0) + tallies[own == number].sum(axis=0, dtype=np.int64)
        if sums:
            band, place = np.repeat(list(sums), 2 + 2 * TALLY), np.tile(np.arange(2 + 2 * TALLY), len(sums))
            yield pa.RecordBatch.from_arrays([pa.array(band), pa.array(place), pa.array(np.concatenate(list(sums.values())))], ["band", "place", "n"])

    total = distinct.select("size", "tally").mapInArrow(rows, "band long, place long, n long").groupBy("band", "place").agg(F.sum("n").alias("n"))
    sums: dict[int, list[int]] = {}
    for r in total.toLocalIterator():  # 66 rows per band
        sums.setdefault(r.band, [0] * (2 + 2 * TALLY))[r.place] = r.n
    halves = {k: (v[: 1 + TALLY], v[1 + TALLY :]) for k, v in sums.items()}
    return {k: tuple(max(0, sum(x * x for x in v[1:]) - v[0]) / 2 for v in both) for k, both in halves.items()}


def describe(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, size, h1, h2, k0..k7, tally, outline): size, 128-bit hash, sketch, tally and outline of every document's set."""
    names = ["size", "h1", "h2", *(f"k{i}" for i in range(SKETCH))]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = np.zeros((batch.num_rows, 3 + SKETCH), np.int64)
            tallies, outlines = [None] * batch.num_rows, [None] * batch.num_rows
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = shingles(text, n)
                if len(tokens):
                    h1, h2 = (np.add.reduce(mix(tokens + np.uint64(s))) for s in (1, 2))
                    out[i, :3] = len(tokens), h1.view(np.int64), h2.view(np.int64)
                    out[i, 3:] = _sketch(tokens)
                    tallies[i], outlines[i] = _tally(tokens, percent), _outline(tokens)
            more = [pa.array(x, pa.binary()) for x in (tallies, outlines)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in out.T), *more], ["doc_id", *names, "tally", "outline"])

    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names) + ", tally binary, outline binary"
    return settle(docs.select("doc_id", "text").mapInArrow(rows, schema), "sets")


def classes(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``described`` with ``rep``, the smallest doc_id with an equal set; (size, tally) of every different set."""
    known = described.where("size > 0 and doc_id is not null").drop("outline")
    reps = settle(
        known.groupBy("size", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("tally").alias("tally"))
        .select(F.col("size").alias("s"), F.col("h1").alias("x"), F.col("h2").alias("y"), "rep", "tally"),
        "set-classes",
    )
    same = (F.col("size") == F.col("s")) & (F.col("h1") == F.col("x")) & (F.col("h2") == F.col("y"))
    members = settle(known.drop("tally").join(reps.drop("tally"), same).drop("s", "x", "y"), "set-members")
    return members, reps.select(F.col("s").alias("size"), "tally")


def shared_keys(docs: DataFrame, n: int, percent: int, plan: dict[int, Band]) -> DataFrame:
    """(key, doc_id, first): keys that several documents have, and the smallest of these."""
    shared = docs.sparkSession.sparkContext.broadcast(plan)  # one entry per band: logarithmic in the largest size

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found, owners = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = shingles(text, n)
                if not len(tokens):
                    continue
                own = band_of(len(tokens), percent)
                for number in (own, own - 1):
                    if number in shared.value:
                        found.append(keys(tokens, shared.value[number]))
                        owners.append(np.full(len(found[-1]), i))
            if found:
                ids = batch.column(0).take(pa.array(np.concatenate(owners)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), ids], ["key", "doc_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    all_keys = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(rows, f"key long, doc_id {kind}")
    group = Window.partitionBy("key")
    return settle(
        all_keys.withColumn("first", F.min("doc_id").over(group)).withColumn("last", F.max("doc_id").over(group))
        .where("first < last").drop("last"),
        "set-keys",
    )


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(doc_id, tokens): the sets of wanted documents, as bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [shingles(t, n).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "tokens"])

    some = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    return settle(some.mapInArrow(rows, f"doc_id {kind}, tokens binary"), "set-tokens")


def may_link(percent: int) -> Column:
    """Sizes and sketches of sides ``a`` and ``b`` allow a link."""
    total = F.col("a.size") + F.col("b.size")
    flipped = sum((F.bit_count(F.col(f"a.k{i}").bitwiseXOR(F.col(f"b.k{i}"))) for i in range(SKETCH)), F.lit(0))
    sizes = 100 * F.least("a.size", "b.size") >= percent * F.greatest("a.size", "b.size")
    return sizes & (flipped * (100 + percent) <= (100 - percent) * total)


def outlined(pairs: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link by their outlines."""
    kind = pairs.schema["a"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            total, x, y = (c.to_pylist() for c in batch.columns[2:])
            keep = [p is None or q is None or _flipped(p, q) * (100 + percent) <= (100 - percent) * t for t, p, q in zip(total, x, y, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    known = described.where("size > 0 and doc_id is not null")
    left = known.select(F.col("doc_id").alias("a"), F.col("size").alias("s"), F.col("outline").alias("x"))
    right = known.select(F.col("doc_id").alias("b"), F.col("size").alias("t"), F.col("outline").alias("y"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", F.expr("s + t"), "x", "y")
    return settle(met.mapInArrow(rows, f"a {kind}, b {kind}").distinct(), "set-pairs")


def verified(pairs: DataFrame, docs: DataFrame, described: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    kind = pairs.schema["a"].dataType.simpleString()
    pairs = outlined(pairs, described, percent)
    sets = _sets(docs, pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), n)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return settle(joined.mapInArrow(rows, f"a {kind}, b {kind}").distinct(), "set-links")


def _across(shared: DataFrame, members: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of class representatives that share a key and lie in different components so far."""
    sketch = [f"k{i}" for i in range(SKETCH)]
    placed = (
        members.join(joined, members.rep == joined.node, "left")
        .select("doc_id", "rep", "size", *sketch, F.coalesce("component", "rep").alias("part"))
    )
    at = shared.select("key", "doc_id").join(placed.select("doc_id", "rep", "part"), "doc_id").select("key", "rep", "part")
    group = Window.partitionBy("key")
    mixed = at.withColumn("low", F.min("part").over(group)).withColumn("high", F.max("part").over(group)).where("low < high")
    rows = settle(
        mixed.select("key", "rep", "part").distinct()
        .join(placed.where("doc_id = rep").select("rep", "size", *sketch), "rep"),
        "set-mixed",
    )
    a, b = rows.alias("a"), rows.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.rep") < F.col("b.rep")) & (F.col("a.part") != F.col("b.part")) & may_link(percent))
    return settle(met.select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct(), "set-across")


def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    described = describe(docs, n, percent)
    members, distinct = classes(described)
    plan = bands({r.size: r["count"] for r in members.groupBy("size").count().toLocalIterator()}, percent, meetings(distinct, percent))
    shared = shared_keys(docs, n, percent, plan)

    sides = members.select("doc_id", "rep", "size", *[f"k{i}" for i in range(SKETCH)])
    stars = settle(shared.where("doc_id <> first").select("doc_id", "first").distinct(), "set-stars")
    first = (
        stars.join(sides.alias("a"), F.col("first") == F.col("a.doc_id")).join(sides.alias("b"), stars.doc_id == F.col("b.doc_id"))
        .where((F.col("a.rep") != F.col("b.rep")) & may_link(percent))
        .select(F.least("a.rep", "b.rep").alias("a"), F.greatest("a.rep", "b.rep").alias("b")).distinct()
    )
    links = verified(first, docs, described, n, percent)
    across = _across(shared, members, components(links), percent)
    found = components(links.unionByName(verified(across, docs, described, n, percent)))

    # a document with rows of different sets joins their classes
    ties = members.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    several = members.groupBy("doc_id").agg(F.countDistinct("rep").alias("reps")).where("reps > 1").select(F.col("doc_id").alias("a"))
    if not several.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(ties.join(several, "a", "left_semi")))
    place = (
        members.join(found, members.rep == found.node, "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    )
    place = settle(place.withColumnRenamed("doc_id", "d"), "set-places")
    return described.join(place, F.col("doc_id") == F.col("d"), "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without those that link to one of a smaller doc_id; one row stays per component."""
    found = join(docs, n, percent)
    keep = settle(found.where("component_id = doc_id").select("doc_id").distinct(), "set-kept")
    row = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    known = docs.join(keep, "doc_id", "left_semi").withColumn("_row", F.row_number().over(row)).where("_row = 1").drop("_row")
    return known.select(*docs.columns).unionByName(docs.where("doc_id is null"))
