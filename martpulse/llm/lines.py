"""Line dedup by a deletion-neighbourhood join.

Lines are compared as sequences of words. Of lines that are equal, or that one word inserted, deleted or replaced makes
equal, the earliest (by doc_id, then position) stays; a line goes if any earlier line is that near, kept or not, so the
result does not depend on an order of work.

1. Equal lines meet by a hash of 128 bits; what follows works on distinct lines.
2. Two lines one edit apart share their first or their last half (halves of the shorter one, rounded down). Lines that
   share neither half with another line cannot have a partner and emit nothing. This filter loses nothing.
3. Every other line emits its variants with one word deleted, on the side where the edit can be, and itself. A variant's
   key is built in constant time: the XOR over hashes of neighbouring words, with the pairs around the gap exchanged.
4. Lines that share a variant with the gap at the same place differ in that one word; a line equal to a variant of another
   differs by an insertion. So each line need only be held against the earliest of its group and the group's own line: no
   pairs within a group are formed.
5. The pairs left are verified word by word.

Built-in functions only. Common lines (a third of all rows may be one line) are folded before any shuffle; the result is
put together per document, never per line text.

Defined cases: a null text stays null; lines with fewer than ``exact_words`` words stay, lines with fewer than ``near_words`` go
only if equal; a blank line has no words, so with ``exact_words`` of 1 only blank lines always stay; white space within a line does not count; rows with the same doc_id and text are one document;
a null doc_id comes before all others; other columns are kept, those named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martpulse.llm.store import settle

ADDED = ("n_lines", "n_removed")


SPACE = " \t\x0b\f\r"  # what separates words, besides the line feeds that separate lines


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE)) == ""


def _clean(line: Column) -> Column:
    """The words of a line with single spaces between them. Most lines are clean, and spared the pattern."""
    odd = F.lit(False)
    for mark in ("  ", *SPACE[1:]):
        odd = odd | F.contains(line, F.lit(mark))
    return F.trim(F.when(odd, F.regexp_replace(line, r"\s+", " ")).otherwise(line))


def _words(line: Column) -> Column:
    return F.split(_clean(line), " ")


def _count(w: Column) -> Column:
    """Number of words; a blank line has none."""
    return F.when(F.element_at(w, 1) == "", 0).otherwise(F.size(w))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_hash", F.xxhash64("text"))


def _lines(docs: DataFrame, exact_words: int) -> DataFrame:
    """(at, c, n): place (doc_id, text hash, position), clean text and number of words of every line that counts."""
    lines = _keyed(docs.select("doc_id", "text")).select(
        "doc_id", "_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    # The test for blank lines is cheap, and pushed below; one on the words would cut them twice.
    clean = lines.where(~_blank(F.col("line"))).select(
        F.struct(F.col("doc_id").alias("d"), F.col("_hash").alias("h"), F.col("pos").alias("p")).alias("at"),
        _clean(F.col("line")).alias("c"),
    )
    n = F.octet_length("c") - F.octet_length(F.replace(F.col("c"), F.lit(" "), F.lit(""))) + 1
    counted = clean.select("at", "c", n.alias("n"))
    return counted.where(F.col("n") >= exact_words) if exact_words > 1 else counted


def distinct_lines(docs: DataFrame, exact_words: int, near_words: int) -> DataFrame:
    """(a, b, at, n, halves): hash, first place, word count and hashes of the halves of every distinct line."""
    n = F.col("n")

    def half(side: str, size: Column) -> Column:
        part = F.call_function("substring_index", F.col("c"), F.lit(" "), size if side == "first" else -size)
        return F.when(n >= near_words, F.xxhash64(F.lit(side), size, part))

    p, q = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    rows = _lines(docs, exact_words).select(
        F.xxhash64("c").alias("a"), F.xxhash64(F.lit("line"), "c").alias("b"), "at", "n",
        half("first", p).alias("f0"), half("last", p).alias("l0"), half("first", q).alias("f1"), half("last", q).alias("l1"),
    )
    return settle(
        rows.groupBy("a", "b").agg(
            F.min("at").alias("at"), *[F.max(c).alias(c) for c in ("n", "f0", "l0", "f1", "l1")]
        ),
        "lines-distinct",
    )


def partnered(lines: DataFrame) -> DataFrame:
    """(at, first, last): lines that share their first or last half with another line, and which."""
    halves = (
        lines.where(F.col("f0").isNotNull())
        .select(
            "at",
            F.explode(
                F.array_distinct(F.array(*[
                    F.struct(F.col(c).alias("key"), F.lit(c[0] == "f").alias("first")) for c in ("f0", "f1", "l0", "l1")
                ]))
            ).alias("half"),
        )
        .select("at", "half.key", "half.first")
    )
    met = halves.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")
    return settle(
        met.groupBy("at").agg(F.max("first").alias("first"), F.max(~F.col("first")).alias("last")), "lines-partnered"
    )


def _pair(x: Column, y: Column) -> Column:
    return F.xxhash64(x, y)


def variants(lines: DataFrame) -> DataFrame:
    """(at, x, y, v, gap): keys of a line's one-word deletions (gap from 1), and of the line itself (gap 0).

    ``lines`` has at, w, first, last; v is the variant's number of words.
    """
    n = F.size("w")
    padded = lines.withColumn("w", F.concat(F.array(F.lit("\n<"), F.lit("\n<<")), "w", F.array(F.lit("\n>>"), F.lit("\n>"))))
    n = n - 4
    twos = F.transform(
        F.sequence(F.lit(1), F.size("w") - 1), lambda i: _pair(F.element_at("w", i), F.element_at("w", i + 1))
    )
    threes = F.transform(
        F.sequence(F.lit(1), F.size("w") - 2),
        lambda i: F.xxhash64(F.element_at("w", i), F.element_at("w", i + 1), F.element_at("w", i + 2)),
    )

    def fold(c: Column) -> Column:
        return F.aggregate(c, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))

    summed = padded.withColumn("twos", twos).withColumn("threes", threes)
    summed = summed.withColumn("x", fold(F.col("twos"))).withColumn("y", fold(F.col("threes")))
    half = F.floor((n - 1) / 2).cast("int")
    gaps = F.sequence(
        F.when(F.col("last"), F.lit(1)).otherwise(half + 1), F.when(F.col("first"), n).otherwise(n - half)
    )

    def word(i: Column) -> Column:
        return F.element_at("w", i + 2)  # two marks stand before the first word

    def without(i: Column) -> Column:
        two = (
            F.element_at("twos", i + 1).bitwiseXOR(F.element_at("twos", i + 2)).bitwiseXOR(_pair(word(i - 1), word(i + 1)))
        )
        three = (
            F.element_at("threes", i).bitwiseXOR(F.element_at("threes", i + 1)).bitwiseXOR(F.element_at("threes", i + 2))
            .bitwiseXOR(F.xxhash64(word(i - 2), word(i - 1), word(i + 1)))
            .bitwiseXOR(F.xxhash64(word(i - 1), word(i + 1), word(i + 2)))
        )
        return F.struct(
            F.col("x").bitwiseXOR(two).alias("x"), F.col("y").bitwiseXOR(three).alias("y"), (n - 1).alias("v"), i.alias("gap")
        )

    own = F.struct("x", "y", n.alias("v"), F.lit(0).alias("gap"))
    return summed.select("at", F.explode(F.concat(F.array(own), F.transform(gaps, without))).alias("k")).select(
        "at", "k.x", "k.y", "k.v", "k.gap"
    )


def candidates(keys: DataFrame) -> DataFrame:
    """(at, other): each line and the earliest lines it meets, per variant."""
    whole, same = Window.partitionBy("x", "y", "v"), Window.partitionBy("x", "y", "v", "gap")
    met = (
        keys.withColumn("own", F.min(F.when(F.col("gap") == 0, F.col("at"))).over(whole))
        .withColumn("cut", F.min(F.when(F.col("gap") > 0, F.col("at"))).over(whole))
        .withColumn("swap", F.min("at").over(same))
    )
    others = F.when(F.col("gap") == 0, F.array("cut")).otherwise(F.array("own", "swap"))
    return met.select("at", F.explode(others).alias("other")).where(F.col("other") < F.col("at")).distinct()


def within_one(a: Column, b: Column) -> Column:
    """Whether two arrays of words are at most one insertion, deletion or replacement apart."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))

    def common(x: Column, y: Column) -> Column:
        same = F.zip_with(F.slice(x, F.lit(1), short), F.slice(y, F.lit(1), short), lambda p, q: p == q)
        first = F.array_position(same, False)
        return F.when(first == 0, short).otherwise(first - 1)

    return (long - short <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= long - 1)


def _texts(docs: DataFrame, some: DataFrame) -> DataFrame:
    """``some`` with the words of their lines. Documents travel whole and once, and only lines asked for are cut out.

    The join is a merge join at every size: documents with such lines are many, so no side is small for long.
    """
    places = some.groupBy(F.col("at.d").alias("_d"), F.col("at.h").alias("_h")).agg(
        F.collect_list(F.struct(F.col("at.p").alias("p"), "first", "last")).alias("places")
    )
    keyed = _keyed(docs.select("doc_id", "text"))
    met = keyed.join(places.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")))

    def with_line(p: Column) -> Column:
        line = F.element_at("lines", p["p"] + 1)
        return F.struct(*[p[c].alias(c) for c in ("p", "first", "last")], line.alias("line"))

    cut = met.withColumn("lines", F.split("text", "\n")).withColumn("places", F.transform("places", with_line))
    return cut.select("doc_id", "_hash", F.explode("places").alias("p")).select(
        F.struct(F.col("doc_id").alias("d"), F.col("_hash").alias("h"), F.col("p.p").alias("p")).alias("at"),
        "p.first", "p.last", _words(F.col("p.line")).alias("w"),
    )


def near_copies(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(at): first places of distinct lines that are one edit from an earlier line."""
    texts = settle(_texts(docs, partnered(lines)), "lines-texts")
    pairs = settle(candidates(variants(texts)), "lines-pairs")
    words = texts.select("at", "w")
    left = pairs.join(words, "at")
    right = words.select(F.col("at").alias("other"), F.col("w").alias("v"))
    return left.join(right, "other").where(within_one(F.col("w"), F.col("v"))).select("at").distinct()


def dedup(docs: DataFrame, exact_words: int = 1, near_words: int = 5) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and n_lines and n_removed.

    By default every line but blank ones counts, and those of five words or more may differ by a word.
    """
    docs = docs.drop(*ADDED)
    lines = distinct_lines(docs, exact_words, near_words)
    stay = lines.select("at").join(near_copies(docs, lines), "at", "left_anti")
    places = stay.groupBy(F.col("at.d").alias("_d"), F.col("at.h").alias("_h")).agg(
        F.array_sort(F.collect_list("at.p")).alias("_stay")
    )
    keyed = _keyed(docs)
    joined = keyed.join(places, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")), "left")
    split = F.split("text", "\n")

    def stays(line: Column) -> Column:
        return _blank(line) if exact_words <= 1 else _count(_words(line)) < exact_words

    small = F.filter(F.transform("_lines", lambda line, i: F.when(stays(line), i)), lambda i: i.isNotNull())
    kept = F.array_sort(F.concat(small, F.coalesce("_stay", F.array().cast("array<int>"))))
    return (
        joined.withColumn("_lines", split)
        .withColumn("_kept", kept)
        .withColumn("n_lines", F.coalesce(F.size("_lines"), F.lit(0)).cast("long"))
        .withColumn("n_removed", F.col("n_lines") - F.coalesce(F.size("_kept"), F.lit(0)))
        .withColumn("text", F.array_join(F.transform("_kept", lambda i: F.element_at("_lines", i + 1)), "\n"))
        .select(*docs.columns, *ADDED)
    )
