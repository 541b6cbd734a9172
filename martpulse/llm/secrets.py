"""Secret scans with multipart credential linking.

Strong finds are reported as they are: assignments, access identifiers and long hexadecimal runs. Weak candidates say too
little alone: tokens of mixed characters, short or oddly named assignments, user names, addresses of services. They are joined by
interval with the parts around them (same text, gaps of at most ``reach`` code points from the end of one to the start of the other) and reported only where
complementary parts stand together:

* a weak secret beside a strong access identifier, or beside a weak identifier and an endpoint;
* a weak identifier, or an endpoint, beside both other roles.

Built-in functions only. Offsets are prefix sums over the pieces around the matches, kept in the row; only parts of
texts that hold weak candidates are shuffled. The interval join is an equi-join on text and stretch of ``reach`` code
points: a weak part is in each stretch that it covers, the other parts in each that they cover when widened by ``reach``, and
a pair counts in the first stretch they share. Parts of one kind do not overlap, so rows are bounded by the text's length.

Defined cases: a null text is empty; rows that repeat get equal results; a null doc_id is kept; columns other than
doc_id and text are left alone by :func:`scan`, those with a clashing name are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The forms of the base kinds.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
BASE = ("assign", "access", "hex")

# Weak candidates; short assignments are found with ASSIGN.
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
NAMED = r"(?i:access_?key_?id|client_?id|user_?name|user|login|account)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}"
ENDPOINT = r"[a-z][a-z0-9+]{2,9}://[^\s\"'<>]{4,}"
WEAK = ("weak_secret", "weak_id", "endpoint")
KINDS = (*BASE, *WEAK)
CHUNK = 256


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def ends(lengths: Column) -> Column:
    """Running sums of an array of lengths: sums of chunks first, so that long arrays stay cheap."""
    n = F.size(lengths)
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")),
        lambda c: _sum(F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK))),
    )
    before = F.transform(F.sequence(F.lit(0), F.size(chunks) - 1), lambda c: _sum(F.slice(chunks, F.lit(1), c)))
    return F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.element_at(before, (F.floor((i - 1) / CHUNK) + 1).cast("int"))
        + _sum(F.slice(lengths, (F.floor((i - 1) / CHUNK) * CHUNK + 1).cast("int"), (i - 1) % CHUNK + 1)),
    )


def matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Leftmost matches, not overlapping: array of (start, end, value), in code points, end exclusive."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    gaps = F.slice(F.transform(F.split(text, pattern, -1), lambda g: F.length(g)), F.lit(1), F.size(hits))
    lengths = F.zip_with(gaps, hits, lambda g, h: g + F.length(h))
    found = F.zip_with(
        F.arrays_zip(ends(lengths).alias("end"), hits.alias("hit")), values,
        lambda m, v: F.struct(
            (m["end"] - F.length(m["hit"])).alias("start"), m["end"].alias("end"), v.alias("value")
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _spans(found: Column, kind: int) -> Column:
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    )


def span_text(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ), ",",
    )


def finds(docs: DataFrame) -> DataFrame:
    """Adds ``assign``, ``access``, ``hex`` and ``short`` (assignments of 6 to 11 characters): arrays of matches."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.withColumn("_assign", matches(text, ASSIGN, 2))
        .withColumn("access", F.filter(matches(text, ACCESS), lambda m: m["end"] - m["start"] >= 18))
        .withColumn("hex", matches(text, HEX))
        .withColumn("assign", F.filter("_assign", lambda m: F.length(m["value"]) >= 12))
        .withColumn("short", F.filter("_assign", lambda m: F.length(m["value"]).between(6, 11)))
        .drop("_assign")
    )


def _parts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end): all parts of texts that hold a weak candidate."""
    text = F.coalesce(F.col("text"), F.lit(""))
    weak = text.rlike(TOKEN) | text.rlike(NAMED) | text.rlike(ENDPOINT) | text.rlike(ASSIGN)
    found = finds(docs.where(weak))
    strong = F.concat(_spans(F.col("assign"), 0), _spans(F.col("access"), 1), _spans(F.col("hex"), 2))
    secret = F.filter(
        matches(text, TOKEN), lambda m: m["value"].rlike("[A-Z]") & m["value"].rlike("[a-z]") & m["value"].rlike("[0-9]")
    )
    likely = F.concat(
        _spans(secret, 3), _spans(F.col("short"), 3), _spans(matches(text, NAMED), 4), _spans(matches(text, ENDPOINT), 5)
    )
    free = F.filter("likely", lambda w: ~F.exists("strong", lambda s: (w["start"] < s["end"]) & (s["start"] < w["end"])))
    rows = (
        found.select("doc_id", F.xxhash64(text).alias("text_hash"), strong.alias("strong"), likely.alias("likely"))
        .where(F.size("likely") > 0)
        .withColumn("free", free)
        .where(F.size("free") > 0)
    )
    return (
        rows.select("doc_id", "text_hash", F.explode(F.concat("strong", "free")).alias("p"))
        .select("doc_id", "text_hash", "p.kind", "p.start", "p.end")
        .distinct()  # rows that repeat
    )


def link(parts: DataFrame, reach: int = 200) -> DataFrame:
    """Weak parts with complementary parts around them: (doc_id, text_hash, kind, start, end)."""
    start, end = F.col("start"), F.col("end")
    first, wide = F.floor(start / reach), F.floor((start - reach) / reach)
    weak = parts.where("kind >= 3").select(
        *parts.columns, first.alias("first"), F.explode(F.sequence(first, F.floor(end / reach))).alias("stretch")
    )
    near = parts.select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("kind").alias("k"), start.alias("s"), end.alias("e"),
        wide.alias("f"), F.explode(F.sequence(wide, F.floor((end + reach) / reach))).alias("b"),
    )
    met = weak.join(
        near,
        weak.doc_id.eqNullSafe(near.d) & (weak.text_hash == near.h) & (weak.stretch == near.b)
        & (weak.stretch == F.greatest(weak["first"], near["f"])) & (near.s - weak.end <= reach) & (weak.start - near.e <= reach),
    )

    def has(*kinds: int) -> Column:
        return F.max(F.col("k").isin(*kinds))

    roles = met.groupBy("doc_id", "text_hash", "kind", "start", "end").agg(
        has(1).alias("strong_id"), has(4).alias("weak_id"), has(0, 2, 3).alias("secret"), has(5).alias("endpoint")
    )
    identifier = F.col("strong_id") | F.col("weak_id")
    joined = (
        F.when(F.col("kind") == 3, F.col("strong_id") | (F.col("weak_id") & F.col("endpoint")))
        .when(F.col("kind") == 4, F.col("secret") & F.col("endpoint"))
        .otherwise(F.col("secret") & identifier)
    )
    return roles.where(joined).select("doc_id", "text_hash", "kind", "start", "end")


def scan(docs: DataFrame, reach: int = 200) -> DataFrame:
    """(doc_id, base, linked): strong finds and linked weak ones, arrays of (start, kind, end)."""
    linked = (
        link(_parts(docs), reach)
        .groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    )
    base = finds(docs).select(
        "doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
        F.concat(_spans(F.col("assign"), 0), _spans(F.col("access"), 1), _spans(F.col("hex"), 2)).alias("base"),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return base.join(
        linked, base.doc_id.eqNullSafe(linked.d) & (base.text_hash == linked.h), "left"
    ).select("doc_id", "base", F.coalesce("linked", none).alias("linked"))


def report(found: DataFrame) -> DataFrame:
    """The digest columns of :func:`scan`."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "linked")).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
