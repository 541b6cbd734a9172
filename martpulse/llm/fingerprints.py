"""Document fingerprints by I-Match with randomised lexicons.

Terms are lower-cased runs of letters and digits. The lexicon holds the terms whose share of documents, df / N, lies
between ``rare`` and ``common``: a band of inverse document frequency, counted over all documents. Its size is at most the mean number of
distinct terms per document divided by ``rare``, whatever the number of documents, so it may be broadcast.

A document's terms within the lexicon are sorted, and ``subsets`` random subsets of the lexicon are applied to them; the
hash of what remains under a subset is one entry of the fingerprint. Subsets thin the lexicon by powers of two; a
document uses the two levels at which about one and one half of a term remain, so that an entry outlives an edit of other terms.
The likeness of two fingerprints is the share of equal entries, over the entries of levels that both have and where
either holds a term.

Defined cases: a null text is empty; a text without lexicon terms uses all its terms, one without any has the
fingerprint ``-`` (likeness 1 to its like, 0 to others); equal texts have equal fingerprints. Ids may be of any type that sorts; null ids
come first, rows of one id follow each other by a hash of their texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from xxhash import xxh64_intdigest

from martpulse.llm.store import settle

TERM = re.compile(r"[^\W_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)  # the usual odd multiplier


def terms(text: str) -> set[str]:
    return set(TERM.findall(text.lower()))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df) over all documents; counted within each batch before anything is shuffled."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                count.update(terms(text or ""))
            yield pa.RecordBatch.from_arrays(
                [pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["term", "df"]
            )

    return docs.select("text").mapInArrow(rows, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(docs: DataFrame, rare: float = 0.0005, common: float = 0.1) -> set[str]:
    n = docs.count()
    band = document_frequencies(docs).where(F.col("df").between(rare * n, common * n)).select("term")
    return {r.term for r in band.toLocalIterator()}


def fingerprint(text: str | None, words: set[str] | frozenset[str], subsets: int = 32) -> str:
    """``level:hash.hash...|level:hash...``; an entry is empty where nothing remains."""
    own = terms(text or "")
    kept = sorted(own & words) or sorted(own)
    if not kept:
        return "-"
    ids = np.fromiter((xxh64_intdigest(t) for t in kept), np.uint64, len(kept))
    salts = (np.arange(1, subsets + 1, dtype=np.uint64) * MIX) | np.uint64(1)
    mixed = ids[:, None] * salts[None, :]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
    top = max(0, int(np.log2(len(kept)) + 0.5))
    parts = []
    for level in (top, top + 1):
        chosen = (mixed >> np.uint64(64 - level)) == 0 if level else np.ones(mixed.shape, bool)
        # terms are in sorted order down the rows, so that the fold depends on the distinct terms alone
        entries = []
        for k in range(subsets):
            left = ids[chosen[:, k]]
            entries.append(f"{xxh64_intdigest(left.tobytes(), seed=k) & 0xFFFFFFFF:08x}" if len(left) else "")
        parts.append(f"{level}:" + ".".join(entries))
    return "|".join(parts)


def likeness(a: str, b: str) -> float:
    """Share of equal entries over the common levels, where either side holds a term; 0 without a common level."""
    if a == b:
        return 1.0
    if "-" in (a, b):
        return 0.0
    left, right = (dict(p.split(":") for p in x.split("|")) for x in (a, b))
    same = held = 0
    for level in left.keys() & right.keys():
        for x, y in zip(left[level].split("."), right[level].split("."), strict=True):
            held += bool(x or y)
            same += bool(x) and x == y
    return same / held if held else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many (or all) from the start of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def in_order(docs: DataFrame, rows_per_block: int = 500, most_blocks: int = 20_000) -> DataFrame:
    """(block, copy, doc_id, text): documents cut into blocks by ascending doc_id, and at the end of each block, with
    ``copy``, the document that follows it (after the last block: the first document).

    Cuts are percentiles of doc_id; beyond ``most_blocks`` blocks, blocks grow instead, as rows stream through their tasks.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    blocks = min(most_blocks, max(1, -(-docs.count() // rows_per_block)))
    at = [i / blocks for i in range(1, blocks)]
    if isinstance(docs.schema["doc_id"].dataType, NumericType):
        cuts = docs.agg(F.percentile_approx("doc_id", at, max(10_000, 10 * blocks)).alias("c")).first().c if at else None
    else:  # of other ids, every blocks-th of some twenty per block, chosen by a hash
        some = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, rows_per_block // 20))) == 0
        ids = sorted(r.doc_id for r in docs.select("doc_id").where(some & F.col("doc_id").isNotNull()).distinct().limit(40 * blocks).collect())
        cuts = ids[:: max(1, len(ids) // blocks)][1:] if at else None
    edges = sorted(set(cuts or []))

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series([0 if null else bisect_right(edges, x) for x, null in zip(ids, ids.isna(), strict=True)], dtype="int32")

    placed = docs.withColumn("block", block_of("doc_id"))
    lows = placed.groupBy("block").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("low")
    )
    own = Window.partitionBy("block").orderBy(F.xxhash64("text"))
    heads = (
        placed.join(
            F.broadcast(lows.select(F.col("block").alias("b"), F.col("low.doc_id").alias("low"))),  # most_blocks rows
            (F.col("block") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("low")),
        )
        .withColumn("r", F.row_number().over(own)).where("r = 1").select("block", "doc_id", "text")
    )
    heads = settle(heads, "fingerprint-heads")
    along = Window.orderBy("block")  # one row per block
    last = F.last("block").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = heads.select("block", F.coalesce(F.lag("block").over(along), last).alias("to"))
    moved = heads.join(F.broadcast(before), "block").select(F.col("to").alias("block"), F.lit(True).alias("copy"), "doc_id", "text")
    return placed.select("block", F.lit(False).alias("copy"), "doc_id", "text").unionByName(moved)


def prints(docs: DataFrame, words: set[str], subsets: int = 32) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(words))  # bounded, see the module's text
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon_ = shared.value
        held = None  # the document before, with its block and fingerprint
        for batch in batches:
            out = []
            ids = batch.column(2)
            for block, copy, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = fingerprint(text, lexicon_, subsets)
                if held and held[0] == block:
                    _, old_id, old, old_print = held
                    changed = edited(old, text)
                    changed_print = fingerprint(changed, lexicon_, subsets)
                    out.append((
                        old_id, len(old), hashlib.sha256(changed.encode()).hexdigest(), old_print, changed_print,
                        likeness(old_print, changed_print), likeness(old_print, own),
                    ))
                held = None if copy else (block, doc_id, text, own)
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            kinds = [ids.type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        in_order(docs)
        .repartition("block")
        .sortWithinPartitions("block", "copy", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .mapInArrow(
            rows,
            f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double",
        )
    )
