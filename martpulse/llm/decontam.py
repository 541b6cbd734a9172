"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap of question and answer.

The test items are indexed by term: a posting is an item with the term's impact, its BM25 contribution divided by the item's score
for itself, so one threshold fits long and short items. Postings stand in blocks of ``BLOCK`` items, and a term keeps the largest
impact of its whole list and of each of its blocks. An item's cut is the threshold or, if that is less, the least score that a
passage can have which passes both overlap bounds (:func:`cuts`), so retrieval loses no item that they accept.

Every training text is cut into passages of one and a half item lengths, half such a length apart, so that any occurrence of an
item lies whole within a passage, and an item counts as leaked if in one of them it reaches its cut and enough of the word n-grams
of both its question and its answer occur. An item's passages depend on its own length alone, not on other items or shards.

For retrieval, items are classed by doublings of length, and every passage of a class, wide enough to hold all passages of its
items that begin in its stride, is a query. The cuts are fixed, so a query's pivots do not depend on the order of its finds, and
:func:`block_max_wand` walks the lists of many queries abreast: a query whose list maxima do not add up to the least cut has
no pivot; a block whose block maxima do not is skipped with its postings unread; the postings of the blocks left are summed.
All items at or above their cut are held against their own passages.

Items are indexed in shards of ``shard_items``, each broadcast on its own and compared in a pass of its own;
document frequencies are those of all items. The texts are never shuffled.

Defined cases: null texts are empty and leak nothing; items without words, and null ones, match nothing; repeated items or rows
give a row each; a null doc_id is kept; other columns are ignored or kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERM = re.compile(r"\w+")
K1, B = 1.2, 0.75  # the usual BM25 parameters
BLOCK = 4
GRAM = 3
LEAST = 8  # items of fewer words have the passages of so many
SPAN = 4  # strides in a passage of a class
ABREAST = 1 << 18  # entries that are summed at once
TEXT_WORDS = 1 << 16  # short texts are searched together up to so many words
SCHEMA = "item_id long, score double, question_overlap double, answer_overlap double, word long"


def words(text: str | None) -> list[str]:
    return TERM.findall((text or "").lower())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words before and after the last question mark, else before the last sentence and in it; one sentence is both."""
    head, mark, tail = text.rpartition("?")
    if mark and words(tail) and words(head):
        return words(head), words(tail)
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if words(s)]
    if len(sentences) < 2:
        return words(text), words(text)
    return words(" ".join(sentences[:-1])), words(sentences[-1])


def grams(tokens: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(tokens))
    return {tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1)} if n else set()


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's n-grams that the passage has."""
    own = grams(part)
    if not own:
        return 0.0
    n = min(GRAM, len(part))
    there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    return len(own & there) / len(own)


@dataclass
class Lists:
    """Inverted lists of the items of a class. Term t has entries ``begin[t]`` to ``begin[t + 1]``, one per block that holds it, with
    the block's largest impact; entry e has postings ``first[e]`` to ``first[e + 1]``, items by place with their impacts."""

    longest: int
    places: np.ndarray  # first place of each block, and the end of the last
    begin: np.ndarray
    top: np.ndarray  # largest impact of each term's list
    block: np.ndarray
    block_top: np.ndarray
    first: np.ndarray
    place: np.ndarray
    impact: np.ndarray

    @property
    def blocks(self) -> int:
        return len(self.places) - 1


@dataclass
class Index:
    """One shard; items by place, in order of length. ``weights`` has each item's terms and impacts."""

    ids: list[int]
    parts: list[tuple[list[str], list[str]]]
    lengths: list[int]
    terms: dict[str, int]
    weights: list[dict[int, float]]
    classes: list[Lists]

    @property
    def blocks(self) -> int:
        return sum(lists.blocks for lists in self.classes)


def length_class(length: int) -> int:
    """The doubling of ``LEAST`` that holds a length."""
    top = LEAST
    while top < length:
        top *= 2
    return top


def stride(length: int) -> int:
    """From passage to passage of an item; a passage is as much longer than the item."""
    return max(4, length // 2)


def build_index(items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean: float) -> Index:
    """Items are indexed in order of length, so that blocks hold alike items."""
    items = sorted(((i, t or "") for i, t in items), key=lambda x: (len(words(x[1])), x[0]))
    lengths = [max(LEAST, len(words(t))) for _, t in items]
    terms: dict[str, int] = {}
    weights: list[dict[int, float]] = []
    for _, text in items:
        tokens = words(text)
        parts = {
            t: np.log(1 + (n_items - df.get(t, 1) + 0.5) / (df.get(t, 1) + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(tokens) / mean))
            for t, n in Counter(tokens).items()
        }
        total = sum(parts.values())
        weights.append({terms.setdefault(t, len(terms)): part / total for t, part in parts.items()})
    classes = []
    for top in sorted({length_class(n) for n in lengths}):
        of = [i for i, n in enumerate(lengths) if length_class(n) == top]
        classes.append(build_lists(top, of[0], weights[of[0] : of[-1] + 1], len(terms)))
    parts = [question_answer(t) for _, t in items]
    return Index([i for i, _ in items], parts, lengths, terms, weights, classes)


def build_lists(longest: int, start: int, weights: list[dict[int, float]], n_terms: int) -> Lists:
    """The lists of items in a row, the first of which has place ``start``."""
    rows = sorted((t, place, impact) for place, item in enumerate(weights, start) for t, impact in item.items())
    term, place = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    impact = np.array([r[2] for r in rows], float)
    block = (place - start) // BLOCK
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(term) != 0) | (np.diff(block) != 0)
    first = np.flatnonzero(new)
    block_top = np.maximum.reduceat(impact, first) if len(first) else np.zeros(0)
    top = np.zeros(n_terms)
    np.maximum.at(top, term, impact)
    places = np.append(np.arange(start, start + len(weights), BLOCK), start + len(weights))
    begin = np.searchsorted(term[first], np.arange(n_terms + 1))
    return Lists(longest, places, begin, top, block[first], block_top, np.append(first, len(rows)), place, impact)


SLACK = 1e-9  # sums in another order


def cuts(index: Index, threshold: float, question: float, answer: float) -> np.ndarray:
    """Per place the score to retrieve at: the threshold, or less where the overlap bounds accept passages below it.

    A passage with an n-gram has all its words. With each word's impact dealt over the n-grams that hold it, the impacts of
    the n-grams found add up to at most the score, so the least of as many n-grams as a bound asks for are a lower limit.
    """
    out = np.full(len(index.ids), float(threshold))
    if question <= 0 and answer <= 0:
        return out
    names = list(index.terms)
    for place, (asked, told) in enumerate(index.parts):
        impact = {names[t]: w for t, w in index.weights[place].items()}
        bounds = [(grams(asked), max(question, answer))] if asked == told else [(grams(asked), question), (grams(told), answer)]
        best = 0.0
        for some in [bounds, *([b] for b in bounds)]:
            held = Counter(w for found, _ in some for g in found for w in set(g))
            least = 0.0
            for found, share in some:
                dealt = sorted(sum(impact[w] / held[w] for w in set(g)) for g in found)
                least += sum(dealt[: max(0, int(np.ceil(share * len(dealt) - 1e-9)))])
            best = max(best, least)
        out[place] = min(threshold, best - SLACK)
    return out


@dataclass
class Search:
    """An index with what holds for all texts: cuts, and the n-grams without which a found item cannot pass the overlap bounds."""

    index: Index
    question: float
    answer: float
    cuts: np.ndarray
    needed: dict[int, tuple[np.ndarray, np.ndarray]]  # n -> (sorted keys, places of their classes as bits)


def grams_at(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys) of the n-grams of known terms. Equal n-grams have equal keys; the reverse is not needed."""
    size = max(0, len(numbers) - n + 1)
    known, key = np.ones(size, bool), np.zeros(size, np.uint64)
    for i in range(n):
        part = numbers[i : i + size]
        known &= part >= 0
        key = key * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
    at = np.flatnonzero(known)
    return at, key[at]


def build_search(index: Index, threshold: float, question: float, answer: float) -> Search:
    bits: dict[int, dict[int, int]] = {}
    bit_of = {lists.longest: 1 << k for k, lists in enumerate(index.classes)}
    for length, (asked, told) in zip(index.lengths, index.parts, strict=True):
        part = asked if question > 0 else told if answer > 0 else asked + told
        n = min(GRAM, len(part)) if question > 0 or answer > 0 else 1
        if n:
            own = bits.setdefault(n, {})
            for key in grams_at(np.array([index.terms[t] for t in part], np.int64), n)[1].tolist():
                own[key] = own.get(key, 0) | bit_of[length_class(length)]
    needed = {n: (np.array(sorted(own), np.uint64), np.array([own[k] for k in sorted(own)], np.int64)) for n, own in bits.items()}
    return Search(index, question, answer, cuts(index, threshold, question, answer), needed)


def runs(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run, member) of all members of the runs from ``begin`` up to ``end``."""
    size = end - begin
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) + np.repeat(begin - (np.cumsum(size) - size), size)


def block_max_wand(
    query: np.ndarray, term: np.ndarray, n: int, lists: Lists, cut: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, place, score) of all items with at least their cut, for ``n`` queries given as distinct rows of query and term."""
    least = np.minimum.reduceat(cut[lists.places[0] : lists.places[-1]], lists.places[:-1] - lists.places[0])
    reach = np.bincount(query, lists.top[term], n)
    able = reach[query] >= least.min() - SLACK
    query, term = query[able], term[able]
    of, entry = runs(lists.begin[term], lists.begin[term + 1])
    cell = query[of] * lists.blocks + lists.block[entry]
    bound = np.bincount(cell, lists.block_top[entry], n * lists.blocks).reshape(n, lists.blocks)
    pivot = ((bound > 0) & (bound >= least - SLACK)).ravel()
    live = pivot[cell]
    cell, entry = cell[live], entry[live]
    of, posting = runs(lists.first[entry], lists.first[entry + 1])
    pivots = np.flatnonzero(pivot)
    number = np.cumsum(pivot) - 1
    offset = lists.place[posting] - lists.places[0]
    score = np.bincount(number[cell[of]] * BLOCK + offset % BLOCK, lists.impact[posting], len(pivots) * BLOCK)
    asked, block = np.divmod(np.repeat(pivots, BLOCK), lists.blocks)
    place = lists.places[block] + np.tile(np.arange(BLOCK), len(pivots))
    hit = (score > 0) & (score >= cut[np.minimum(place, len(cut) - 1)])
    return asked[hit], place[hit], score[hit]


def retrieve(numbers: np.ndarray, sizes: np.ndarray, lists: Lists, cut: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first word, place) of the class's passages and the items found for them; ``numbers`` holds the terms of all texts.

    Each passage is ``SPAN`` strides wide. A term is counted in the passages over its stride that have not met it in an earlier one.
    """
    step = stride(lists.longest)
    chunks = -(-sizes // step)
    base = np.cumsum(chunks) - chunks
    total, starts = int(chunks.sum()), np.cumsum(sizes) - sizes
    if not total:
        return
    text = np.repeat(np.arange(len(sizes)), chunks)
    at = np.flatnonzero(numbers >= 0)
    of = np.searchsorted(starts, at, side="right") - 1
    key = np.sort(numbers[at] * total + base[of] + (at - starts[of]) // step)
    term, chunk = np.divmod(key[np.diff(key, prepend=-1) > 0], total)
    before = np.full(len(term), -1)
    before[1:] = np.where(term[1:] == term[:-1], chunk[:-1], -1)
    low = np.maximum(np.maximum(chunk - SPAN + 1, base[text[chunk]]), before + 1)
    order = np.argsort(chunk, kind="stable")
    term, chunk, low = term[order], chunk[order], low[order]
    # As many passages at once as have ABREAST entries.
    cost = np.bincount(chunk, (chunk - low + 1) * (lists.begin[term + 1] - lists.begin[term]), total) + lists.blocks
    edges = np.unique(np.searchsorted(np.cumsum(cost), np.arange(0, cost.sum(), ABREAST)))
    for start, end in pairwise([*edges.tolist(), total]):
        own = slice(np.searchsorted(chunk, start), np.searchsorted(chunk, end + SPAN - 1))
        of, passage = runs(np.maximum(low[own], start), np.maximum(np.minimum(chunk[own], end - 1) + 1, np.maximum(low[own], start)))
        asked, place, _ = block_max_wand(passage - start, term[own][of], end - start, lists, cut)
        asked += start
        yield text[asked], (asked - base[text[asked]]) * step, place


def leaks(texts: list[str | None], search: Search) -> list[list[tuple]]:
    """Per text (item_id, score, question_overlap, answer_overlap, first word of the passage) of each leaked item."""
    out, held, size = [], [], 0
    for text in texts:
        tokens = words(text)
        held.append(tokens)
        size += len(tokens)
        if size >= TEXT_WORDS:
            out += _leaks(held, search)
            held, size = [], 0
    return out + _leaks(held, search)


def _leaks(texts: list[list[str]], search: Search) -> list[list[tuple]]:
    index = search.index
    found: list[dict[int, tuple]] = [{} for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    if not index.terms or not sizes.sum():
        return [[] for _ in texts]
    numbers = np.fromiter(map(index.terms.get, chain.from_iterable(texts), repeat(-1)), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    needed = {n: _places(numbers, n, *known) for n, known in search.needed.items()}
    for number, lists in enumerate(index.classes):
        step = stride(lists.longest)
        hits = np.unique(np.concatenate([at[bits >> number & 1 > 0] for at, bits in needed.values()] or [np.zeros(0, np.int64)]))
        for text, begin, place in retrieve(numbers, sizes, lists, search.cuts):
            near = np.searchsorted(hits, starts[text] + begin) < np.searchsorted(hits, starts[text] + begin + SPAN * step)
            for t, first, p in zip(text[near].tolist(), begin[near].tolist(), place[near].tolist(), strict=True):
                _verify(found[t], texts[t], numbers[starts[t] : starts[t] + sizes[t]], first, step, p, search)
    return [sorted(f.values()) for f in found]


def _places(numbers: np.ndarray, n: int, keys: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, classes as bits) of the n-grams that are needed."""
    at, key = grams_at(numbers, n)
    near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    met = keys[near] == key
    return at[met], bits[near[met]]


def _verify(found: dict[int, tuple], tokens: list[str], numbers: np.ndarray, begin: int, step: int, place: int, search: Search) -> None:
    """Holds a found item against its own passages that begin in the stride, and keeps the one of the highest score."""
    index = search.index
    length, weights = index.lengths[place], index.weights[place]
    apart = stride(length)
    last = min(begin + step, max(1, len(tokens) - length + 1))
    for start in range(-(-begin // apart) * apart, last, apart):
        end = start + length + apart
        score = sum(weights.get(t, 0.0) for t in np.unique(numbers[start:end]).tolist())
        if score < search.cuts[place] or score <= found.get(place, (0, -1.0))[1]:
            continue
        asked, told = (overlap(p, tokens[start:end]) for p in index.parts[place])
        if asked >= search.question and told >= search.answer:
            found[place] = (index.ids[place], score, asked, told, start)


def shards(benchmark: DataFrame, shard_items: int) -> Iterator[Index]:
    """Indexes of at most ``shard_items`` items each; a pass over the items first counts terms in all of them."""
    rows = benchmark.where(F.col("item_id").isNotNull()).select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    if not n:
        return
    terms = rows.select("item_id", F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0)).alias("t"))
    mean = max(terms.agg(F.avg(F.size("t"))).first()[0] or 0.0, 1.0)
    df = terms.select(F.explode(F.array_distinct("t")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for k in range(-(-n // shard_items)):
        own = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(-(-n // shard_items))) == k)
        mine = [(r.item_id, r.text) for r in own.toLocalIterator()]
        held = terms.join(own.select("item_id"), "item_id", "left_semi").select(F.explode("t").alias("term")).distinct()
        counts = {r.term: r.df for r in df.join(held, "term", "left_semi").toLocalIterator()}
        yield build_index(mine, counts, n, mean)


def find(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, question: float = 0.6, answer: float = 0.5,
    shard_items: int = 2000,
) -> DataFrame:
    """One row per (document, leaked item)."""
    out = None
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(f.split()[0] for f in SCHEMA.split(", "))]
    context = docs.sparkSession.sparkContext
    for index in shards(benchmark, shard_items):
        # at most ``shard_items`` items
        shared = context.broadcast(build_search(index, threshold, question, answer))

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = leaks(batch.column(1).to_pylist(), shared.value)
                got = [(i, *leak) for i, of in enumerate(found) for leak in of]
                columns = list(zip(*got, strict=True)) if got else [()] * 6
                ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
                types = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns[1:], types, strict=True))], names)

        part = docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, {SCHEMA}")
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], f"doc_id {kind}, {SCHEMA}") if out is None else out


def clean(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, question: float = 0.6, answer: float = 0.5,
    shard_items: int = 2000,
) -> DataFrame:
    """The rows of ``docs`` that leak no item, in one pass per shard."""
    context = docs.sparkSession.sparkContext
    at = docs.columns.index("text")
    for index in shards(benchmark, shard_items):
        shared = context.broadcast(build_search(index, threshold, question, answer))

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [not found for found in leaks(batch.column(at).to_pylist(), shared.value)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(rows, docs.schema)
    return docs
