"""Phrase collocations by prefix-free parsing: phrases whose words go together more often than their parts apart.

1. Texts are cut into pieces at punctuation and line ends, pieces into words. A piece is parsed into chunks: a chunk ends where
   the hash of the next ``WINDOW`` words is 0 modulo ``every`` (or after ``longest`` words), and the next begins there.
   Chunks overlap by those words, so that every n-gram of up to ``WINDOW`` + 1 words lies whole in the chunk that its
   first word belongs to, and in this role in no other: overlaps are counted once. As the content alone sets the cuts, texts that
   share a passage share its chunks, wherever it stands.
2. Equal chunks are folded into a dictionary with their frequency in the parse. What follows reads distinct chunks only and
   weighs what it finds with that frequency.
3. Words and pairs of words are counted by 64-bit keys. Keys that reach ``least`` mark a bitmap of fixed size; an n-gram
   can only be frequent if its words and pairs are marked. Different keys may share a mark, which lets more through, never less.
4. The n-grams let through are counted exactly, as strings, and those below ``least`` go.
5. Scores, cuts and the drop of phrases within longer ones are joins on the frequent n-grams.

Everything is folded in the task before a shuffle, so that a word with a third of all occurrences is one row per task.
All numbers are exact: counts are 64-bit integers, the product in the score a decimal.

Defined cases: null and empty texts have no words; a null lang is ``und``, one with the language of that name; repeated
rows count each; an empty table, or one without frequent phrases, gives no rows; other columns are ignored. Equal scores and
counts are ranked by the phrase's bytes, so there are no ties. A text of any length is cut whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from martpulse.llm.store import pieces, settle

PIECE = r"[.,;:!?\n-\r]"  # what ends a piece; within it, spaces and tabs end words
LONGEST = 4  # words of a phrase
WINDOW = LONGEST - 1  # words that a trigger looks at and that chunks share
MARK_BITS = 27  # the bitmap of frequent keys takes 16 MB
GOLD = np.uint64(0x9E3779B97F4A7C15)
CHUNKS = "lang string, chunk string, own int, n long"


def _keys(words: np.ndarray) -> np.ndarray:
    """64-bit keys of strings, the same in every process."""
    return pd.util.hash_array(np.asarray(words, dtype=object), categorize=False)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * GOLD
    return h ^ (h >> np.uint64(29))


def cuts(keys: np.ndarray, starts: np.ndarray, every: int, longest: int) -> np.ndarray:
    """Where chunks begin among the words of all pieces; ``starts`` are the pieces' first words, in order.

    A trigger window must lie within its piece, else the rest of the piece would be a chunk of less than a window.
    """
    n = len(keys)
    begins = np.zeros(n, bool)
    begins[starts] = True
    if n >= WINDOW:
        rolled = _mixed(_mixed(keys[: n - 2] * GOLD + keys[1 : n - 1]) + keys[2:])
        ends = np.append(starts[1:], n)
        left = np.repeat(ends, ends - starts) - np.arange(n)  # words up to the end of the piece
        begins[: n - 2] |= (rolled % np.uint64(every) == 0) & (left[: n - 2] >= WINDOW)
    at = np.flatnonzero(begins)
    lengths = np.diff(np.append(at, n))
    if len(lengths) and lengths.max() > longest:
        more = [np.arange(a, a + size, longest) for a, size in zip(at[lengths > longest], lengths[lengths > longest], strict=True)]
        at = np.union1d(at, np.concatenate(more))
    return at


def _parsed(langs: pa.Array, texts: pa.Array, every: int, longest: int) -> pa.Table:
    """The chunks of some texts, equal ones folded."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), PIECE)
    text_of_piece = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    split = pc.split_pattern(pc.replace_substring(split.flatten(), "\t", " "), " ")
    words = split.flatten()
    there = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    piece = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))[there]
    words = words.filter(pa.array(there)).dictionary_encode()
    ids, n = words.indices.to_numpy(zero_copy_only=False), len(piece)
    starts = np.flatnonzero(np.diff(piece, prepend=-1))
    at = cuts(_keys(words.dictionary.to_numpy(zero_copy_only=False))[ids], starts, every, longest)
    own = np.diff(np.append(at, n))
    ends = np.append(starts[1:], n)[np.searchsorted(starts, at, side="right") - 1]
    lengths = np.minimum(at + own + WINDOW, ends) - at
    offsets = np.append(0, np.cumsum(lengths))
    place = np.repeat(at - offsets[:-1], lengths) + np.arange(offsets[-1])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.dictionary.take(pa.array(ids[place])))
    chunks = pa.table({
        "lang": langs.take(pa.array(text_of_piece[piece[at]])), "chunk": pc.binary_join(lists, " "), "own": pa.array(own, pa.int32()),
    })
    return chunks.group_by(["lang", "chunk", "own"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["lang", "chunk", "own", "n"])


def _parse(every: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1000):
            yield from _parsed(batch["lang"], batch["text"], every, longest).to_batches()

    return run


def parse(docs: DataFrame, every: int = 32, longest: int = 256) -> DataFrame:
    """(lang, chunk, own, n): the dictionary of chunks, how many n-grams begin in each, and its frequency."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(_parse(every, longest), CHUNKS)
    return settle(rows.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n")), "phrases-chunks")


class _Words:
    """The words of a batch of chunks as numbers, one after the other."""

    def __init__(self, batch: pa.RecordBatch):
        split = pc.split_pattern(batch["chunk"], " ")
        lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        ends = np.cumsum(lengths)
        place = np.arange(len(self.ids)) - np.repeat(ends - lengths, lengths)
        own = batch["own"].to_numpy(zero_copy_only=False)
        self.left = np.repeat(lengths, lengths) - place  # words up to the chunk's end
        self.own = place < own[self.row]  # the rest is overlap
        self.n = batch["n"].to_numpy(zero_copy_only=False)[self.row]
        langs = batch["lang"].dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.row]
        of_lang = _mixed(_keys(self.langs.to_numpy(zero_copy_only=False)))
        self.word_keys = _mixed(_keys(self.words.to_numpy(zero_copy_only=False))[self.ids] + of_lang[self.lang])

    def pair_keys(self) -> np.ndarray:
        """Keys of the pairs that begin at all words but the last."""
        return _mixed(self.word_keys[:-1] * GOLD + self.word_keys[1:])


def _folded(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return order[first], np.add.reduceat(n[order], first)


def _count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        w = _Words(batch)
        pair = w.own[:-1] & (w.left[:-1] >= 2)
        keys = np.concatenate([w.word_keys[w.own], w.pair_keys()[pair]])
        at, n = _folded(keys, np.concatenate([w.n[w.own], w.n[:-1][pair]]))
        yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(n)], names=["key", "n"])


def marks(chunks: DataFrame, least: int, bits: int = MARK_BITS) -> np.ndarray:
    """The bitmap of the words and pairs that occur ``least`` times; 2 ** ``bits`` bits whatever the input."""
    counted = chunks.mapInArrow(_count_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    bit = F.col("key").bitwiseAND((1 << bits) - 1)
    rows = (
        counted.where(F.col("n") >= least)
        .groupBy(F.shiftright(bit, 15).alias("block"))
        .agg(F.bitmap_construct_agg(bit.bitwiseAND((1 << 15) - 1)).alias("bitmap"))
        .collect()  # at most 2 ** (bits - 15) rows of 4 KB
    )
    found = np.zeros(max(1, 1 << (bits - 15)) * 4096, np.uint8)
    for row in rows:
        found[row.block * 4096 : (row.block + 1) * 4096] = np.frombuffer(row.bitmap, np.uint8)
    return found


def _marked(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    bit = keys & np.uint64((1 << bits) - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _count_grams(shared, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            w = _Words(batch)
            size, many = len(w.ids), len(w.words) + 1
            word = _marked(bitmap, w.word_keys, bits)
            pair = np.append(_marked(bitmap, w.pair_keys(), bits), False) & word
            pair[:-1] &= word[1:]
            going, gram = word & w.own, w.lang * many + w.ids
            for length in range(1, LONGEST + 1):
                if length > 1:
                    before = length - 2  # the pair that the new word closes
                    going = going[: size - length + 1] & pair[before : size - 1] & (w.left[: size - length + 1] >= length)
                    gram = gram[: size - length + 1]
                at = np.flatnonzero(going)
                if not len(at):
                    break
                # numbers of distinct (language, words so far), then of those with the next word
                if length > 1:
                    _, numbered = np.unique(gram[at], return_inverse=True)
                    gram = np.zeros(len(gram), np.int64)
                    gram[at] = numbered * many + w.ids[at + length - 1]
                first, n = _folded(gram[at], w.n[at])
                first = at[first]
                parts = [w.words.take(pa.array(w.ids[first + k])) for k in range(length)]
                phrase = parts[0] if length == 1 else pc.binary_join_element_wise(*parts, " ")
                yield pa.RecordBatch.from_arrays(
                    [w.langs.take(pa.array(w.lang[first])), pa.array(np.full(len(n), length, np.int32)), phrase, pa.array(n)],
                    names=["lang", "words", "phrase", "f"],
                )

    return run


def frequent(chunks: DataFrame, least: int, bits: int = MARK_BITS) -> DataFrame:
    """(lang, words, phrase, f): all n-grams of 1 to 4 words that occur at least ``least`` times."""
    shared = chunks.sparkSession.sparkContext.broadcast(marks(chunks, least, bits))
    grams = chunks.mapInArrow(_count_grams(shared, bits), "lang string, words int, phrase string, f long")
    counted = grams.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return settle(counted, "phrases-frequent")


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, cover: int = 80, every: int = 32, longest: int = 256, bits: int = MARK_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase goes if a longer one that holds it occurs in at least ``cover`` percent of its occurrences.
    """
    chunks = parse(docs, every, longest)
    totals = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))
    grams = frequent(chunks, least, bits)
    found = grams.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    k = F.col("k")
    split = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "words", "phrase", "a", "k",
        F.array_join(F.slice("w", 1, k), " ").alias("left"), F.array_join(F.slice("w", k + 1, F.col("words") - k), " ").alias("right"),
    )
    side = grams.where(F.col("words") < LONGEST)
    parts = split.join(side.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        side.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]
    )
    score = F.expr("cast(cast(a as decimal(19, 0)) * 2000000 div (cast(l as decimal(19, 0)) + r) as bigint)")
    scored = parts.withColumn("score", score).groupBy("lang", "words", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )

    def inner(length: int):
        """All runs of ``length`` words."""
        return F.transform(
            F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.array_join(F.slice("w", i, F.lit(length)), " ")
        )

    inside = F.when(F.col("words") == 3, inner(2)).otherwise(F.concat(inner(2), inner(3)))
    within = (
        found.where("words > 2").select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    covered = F.col("longer").cast("decimal(19, 0)") * 100 >= F.col("a").cast("decimal(19, 0)") * cover
    left = scored.join(within, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
