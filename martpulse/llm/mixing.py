"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words. A document's expected number of copies is target / source size, the prefix sum of
these runs through the source in order of size class, and a document is emitted once per integer boundary that its
stretch of the prefix sum (moved by one random offset per source) crosses.

A source may hold any share of the rows, so no task sees a whole source: rows are counted per (source, size class,
block), the few counts are summed up in order, and ranks are taken within one block only.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; rows that repeat are
rows of their own; rows of the same source, size and doc_id come in the order of a hash of all their columns, so that
reruns take the same ones; an empty table gives no rows; columns of ``docs`` named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martpulse.llm.store import settle

WORD = r"[^\x20\x09-\x0D]+"
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: str | Column) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Four classes per doubling, by integer arithmetic: bit length and the next two bits."""
    bits = F.length(F.bin(size))
    return bits * 8 + F.call_function("shiftright", size, F.greatest(bits - 3, F.lit(0))).cast("int")


def random_offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) per source; a multiple of 2^-16, so that sums with it stay exact."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0000"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") / 65536


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): weights repeat over the sources by code point, null last.

    The water level is found in closed form: in order of cap / weight, the first source that the level left by those
    before it does not fill. One row per source passes through one task here, never rows of documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turns = F.array(*[F.lit(float(w)) for w in weights])
    caps = (
        sources.withColumn("weight", F.element_at(turns, (F.row_number().over(order) - 1) % len(weights) + 1))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    fills = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(fills.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fills.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    levels = caps.withColumn("level", (share * total - before) / rest)
    whole = fills.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = F.first(F.when(F.col("level") <= F.col("fill"), F.col("level")), ignorenulls=True).over(whole)
    return levels.select(
        "source", "source_size", F.coalesce(F.least("cap", found * F.col("weight")), F.col("cap")).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    blocks: int = 256,
) -> DataFrame:
    """Rows of ``docs`` with size, source_size, target, copies and taken (copies times size).

    ``docs`` needs doc_id, source and text. Only the columns handed in travel: drop ``text`` beforehand by giving
    ``size`` instead if the texts are not wanted.
    """
    sized = docs.drop(*ADDED[1:]) if "size" in docs.columns else docs.drop(*ADDED).withColumn("size", word_count("text"))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    block = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % blocks
    sized = sized.withColumn("_class", size_class(F.col("size"))).withColumn("_block", block)
    counts = settle(
        sized.groupBy("source", "_class", "_block").agg(F.count("*").alias("n"), F.sum("size").alias("words")),
        "mix-counts",
    )
    aims = targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    along = Window.partitionBy("source").orderBy("_class", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "source", "_class", "_block", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("_start")
    )
    starts = starts.join(aims.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_s"), F.col("_class").alias("_c"), F.col("_block").alias("_b"), "_start",
        "source_size", "target",
    )
    starts = settle(starts, "mix-starts")
    placed = sized.join(
        starts,
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")) & (F.col("_block") == F.col("_b")),
    )
    # Rows alike in source, size and doc_id are told apart by what else they hold, so that reruns number them alike.
    rest = [c for c, kind in docs.dtypes if "map<" not in kind and kind not in ("variant", "void")]
    inside = Window.partitionBy("source", "_class", "_block").orderBy("size", "doc_id", F.xxhash64(*[f"`{c}`" for c in rest]))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    upto = F.floor(rate * F.col("_rank") + F.col("_u"))
    copies = upto - F.floor(rate * (F.col("_rank") - 1) + F.col("_u"))
    return (
        placed.withColumn("_rank", F.col("_start") + F.row_number().over(inside))
        .withColumn("_u", random_offset(F.col("source"), seed))
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_class", "_block", "_s", "_c", "_b", "_start", "_rank", "_u")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy, with its number in ``copy`` from 1; documents without a word are no copies."""
    return mixed.where("copies > 0 and size > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
