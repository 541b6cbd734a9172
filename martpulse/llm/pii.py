"""Personal data by candidate gradient boosting.

Generators of high recall propose overlapping spans per kind. Boosted trees judge each by its format and context, Platt
scaling makes their margins probabilities, and a threshold per kind, chosen on rows held out, selects the redactions.
Spans of the base forms are always kept; the model adds what those forms miss or swallow: numbers that stand beside
each other, written-out addresses, forms with other separators.

No labels of personal data exist, so the model learns from the data itself: candidates that pass the check of their
kind and stand free count as positive. It learns from every candidate of every text, each text once: features are cut at
fixed edges, Spark counts the candidates of equal bins and label, and trees, scaling and thresholds come from sums over
these counts, a distributed pass each. The driver holds the sums and the model, both of a fixed size.

Defined cases: a null text is empty; repeated rows get equal results; a null doc_id is kept; other columns are ignored.
Without candidates of both labels only base spans are reported. No text is cut.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martpulse.llm.boost import Trees, calibrate, platt, sigmoid, summed, to_bins
from martpulse.llm.store import pieces, settle

# The kinds and their base forms.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match cannot begin within a run of digits whose first digit begins none, so only those first are tried.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators of candidates.
WRITTEN_DOMAIN = re.compile(r"\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]+)+", re.I)
LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AT = re.compile(r"[(\[]at[)\]]", re.I)
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
RUN = re.compile(r"[0-9]+(?:[\x20.-][0-9]+)*")
CALL = re.compile(r"(?:\+[0-9]|\([0-9]|[0-9])[\x20().0-9-]{6,}[0-9]")
GROUP = re.compile(r"[0-9]+")
DATE = re.compile(r"(?:19|20)[0-9]{2}[.-][0-9]{1,2}[.-][0-9]{1,2}(?![0-9])|[0-9]{1,2}[.-][0-9]{1,2}[.-](?:19|20)[0-9]{2}(?![0-9])")
CUES = (
    re.compile(r"mail|contact|write", re.I), re.compile(r"\bip\b|host|server|addr", re.I),
    re.compile(r"card|visa|master|pay", re.I), re.compile(r"tel|phone|call|fax|mobile", re.I),
)
REACH = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(re.findall(r"[0-9]", s))


def valid(kind: int, s: str) -> bool:
    """The check of a kind, on the text of a span."""
    if kind == 0:
        return "." in s or "dot" in s.lower()
    if kind == 1:
        parts = s.split(".")
        return len(parts) == 4 and all(p.isdecimal() and len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    digits = only_digits(s)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the base form, found from the at signs outwards, so that long words cost no more than once."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return out


def written(text: str) -> list[tuple[int, int]]:
    """Addresses with a written-out at sign, found from there outwards."""
    out, last = [], 0
    for m in AT.finditer(text):
        end = m.start() - (m.start() > last and text[m.start() - 1] == " ")
        start = end
        while start > last and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        found = WRITTEN_DOMAIN.match(text, m.end()) if start < end else None
        if found:
            out.append((start, found.end()))
            last = found.end()
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Per kind, the leftmost matches that pass the check."""
    out: list[list[tuple[int, int]]] = [emails(text) if "@" in text else [], [], [], []]
    for kind, form in ((1, IP), (2, CARD), (3, PHONE)):
        if kind == 3 and "+" not in text:
            continue
        out[kind] = [m.span() for m in form.finditer(text) if valid(kind, m.group())]
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), overlapping: base forms, parts of longer runs at their joints, written-out forms."""
    found: set[tuple[int, int, int]] = set()
    if "@" in text:
        found.update((0, *s) for s in emails(text))
    found.update((0, *s) for s in written(text))
    for m in DOTTED.finditer(text):
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        found.update((1, a[0], b[1]) for a, b in zip(groups, groups[3:], strict=False))
    for m in RUN.finditer(text):
        if m.end() - m.start() < 13:
            continue
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        for i, (start, _) in enumerate(groups):
            n = 0
            for a, b in groups[i : i + 20]:  # every group has a digit
                n += b - a
                if n > 19:
                    break
                if n >= 13:
                    found.add((2, start, b))
    for m in CALL.finditer(text):
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        for i, (start, _) in enumerate(groups):
            opened = start - (start > m.start() and text[start - 1] in "+(")
            if i and opened == start:
                continue
            n = 0
            for a, b in groups[i : i + 16]:
                n += b - a
                if n > 15:
                    break
                if n >= 9:
                    found.add((3, opened, b))
    return sorted(found)


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    s = text[start:end]
    digits = only_digits(s)
    before, after = text[max(0, start - 1) : start], text[end : end + 1]
    near = text[max(0, start - REACH) : start]
    groups = [len(g) for g in re.findall(r"[0-9]+", s)] or [0]
    round_it = text[max(0, start - 8) : start] + text[end : end + 8]
    return [
        float(kind), float(len(s)), float(len(digits)), float(len(groups)), float(max(groups)), float(min(groups)),
        float(luhn(digits)) if digits else 0.0,
        float(max((int(g) for g in re.findall(r"[0-9]{1,9}", s)), default=0)) if kind == 1 else 0.0,
        float(s[0] == "+"), float(s[0] == "("), float(s.count(" ")), float(s.count("-")), float(s.count(".")),
        float(s.count("@")), float(before.isalnum()), float(after.isalnum()), float(before in ".-+" and before != ""),
        float(len(set(re.findall(r"[^0-9]", s)))), float(bool(CUES[kind].search(near))),
        sum(c.isdigit() for c in round_it) / 16.0, float(after in "@.-" and after != ""),
    ]


def called(text: str, start: int, end: int) -> bool:
    """Whether a number without plus or brackets is a phone number by a cue before it and its groups of digits."""
    s = text[start:end]
    groups = [len(g) for g in GROUP.findall(s)]
    grouped = 2 <= len(groups) <= 6 and max(groups) <= 8 and sum(n == 1 for n in groups) <= 1
    cue = CUES[3].search(text[max(0, start - REACH) : start])
    return bool(cue and (grouped or s.startswith("00")) and not DATE.match(s) and not valid(1, s) and not valid(2, s))


def label(text: str, kind: int, start: int, end: int) -> int:
    """The weak label: the check passes, the span stands free, and calls show a plus, brackets or a cue and groups."""
    s = text[start:end]
    free = not text[max(0, start - 1) : start].isalnum() and not text[end : end + 1].isalnum()
    return int(free and valid(kind, s) and (kind != 3 or s[0] in "+(" or called(text, start, end)))


@dataclass
class Model:
    trees: Trees
    slope: float
    offset: float
    thresholds: tuple[float, ...]

    def chances(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.trees.margin(x) + self.offset)


# Edges of the bins, per feature: every number up to 64, then four per doubling; for the largest part of an address tens, the
# bound of 256 and powers of ten; shares in sixteenths. A vector of bins is a string of bytes, led by the label.
FLAG = np.array([1.0])
NUMBER = np.unique([*range(1, 65), *np.rint(64 * 2 ** (np.arange(1, 57) / 4))]).astype(float)
PART = np.array([*range(1, 10), *range(10, 250, 10), 250, 255, 256, 300, 500, 1000, *(10.0**k for k in range(4, 10))])
SHARE = np.arange(1, 17) / 16.0
EDGES = [
    np.array([1.0, 2.0, 3.0]), NUMBER, NUMBER, NUMBER, NUMBER, NUMBER, FLAG, PART, FLAG, FLAG, NUMBER, NUMBER, NUMBER, NUMBER,
    FLAG, FLAG, FLAG, NUMBER, FLAG, SHARE, FLAG,
]
CUTS = (0.5, 0.6, 0.7, 0.8, 0.9)


def counted(docs: DataFrame) -> DataFrame:
    """(vector, n, held): the candidates of all texts, each text once, by label and bins; every fourth of each is held out."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(F.xxhash64("text").alias("h"), "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found: Counter[tuple[int, bytes]] = Counter()
            whose, held = [], []

            def count() -> None:
                got = np.array(held, float)
                vectors = np.column_stack([got[:, 0], to_bins(got[:, 1:], EDGES)]).astype(np.uint8)
                found.update(zip(whose, (v.tobytes() for v in vectors), strict=True))
                whose.clear()
                held.clear()

            for h, text in dict(zip(*(c.to_pylist() for c in batch.columns), strict=True)).items():
                for c in candidates(text):
                    whose.append(h)
                    held.append([label(text, *c), *features(text, *c)])
                    if len(held) == 5000:
                        count()
            if held:
                count()
            arrays = [pa.array([h for h, _ in found], pa.int64()), pa.array([v for _, v in found], pa.binary()), pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["h", "vector", "n"])

    each = texts.mapInArrow(rows, "h long, vector binary, n long").distinct()  # copies of a text have equal rows
    total = each.groupBy("vector").agg(F.sum("n").alias("n"))
    return total.withColumn("held", F.floor((F.col("n") + F.pmod(F.xxhash64("vector"), F.lit(4))) / 4))


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(labels, bins, numbers to learn from, numbers held out) of a block."""
    rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, len(EDGES) + 1)
    n, held = (c.to_numpy() for c in batch.columns[1:])
    return rows[:, 0], np.asfortranarray(rows[:, 1:]), n - held, held


def fit(docs: DataFrame, precision: float = 0.99, block: int = 100_000) -> Model | None:
    """Fits on the candidates of all texts; ``block`` is the number of different vectors that a task works on in a pass."""
    table = settle(counted(docs), "pii-candidates")
    by_label = table.groupBy((F.substring("vector", 1, 1) == F.lit(b"\1")).alias("y"))
    totals = {r.y: r for r in by_label.agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.sum("held").alias("held")).collect()}
    if len(totals) < 2:
        return None
    n0, n1 = (totals[y].n - totals[y].held for y in (False, True))
    vectors = table.repartition(-(-sum(r.rows for r in totals.values()) // block)).persist()
    trees = Trees(edges=EDGES)

    def histograms(feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            y, b, n, _ = unpacked(batch)
            return trees.histogram(b, n, n * y, feature, cut, level)

        return summed(vectors, part, trees.slots(level))

    trees.learn(n1 / max(1, n0 + n1), histograms)
    targets = 1 / (totals[False].held + 2), (totals[True].held + 1) / (totals[True].held + 2)

    def steps(a: float, b: float) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            y, bins, _, n = unpacked(batch)
            return platt(trees.total(bins), y, n, targets, a, b)

        return summed(vectors, part, 10)

    slope, offset = calibrate(steps)

    def over(batch: pa.RecordBatch) -> np.ndarray:
        y, b, _, n = unpacked(batch)
        chance = sigmoid(slope * trees.total(b) + offset)
        ones = [[n[of].sum(), (n * y)[of].sum()] for k in range(len(KINDS)) for c in CUTS for of in [(b[:, 0] == k) & (chance >= c)]]
        return np.array(ones, np.int64).ravel()

    passed = summed(vectors, over, len(KINDS) * len(CUTS) * 2).reshape(len(KINDS), len(CUTS), 2)
    vectors.unpersist()
    thresholds = tuple(next((c for c, (n, right) in zip(CUTS, of, strict=True) if n and right >= precision * n), 0.9) for of in passed.tolist())
    return Model(trees, slope, offset, thresholds)


def select(text: str, model: Model | None, base: list[list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """Added spans: likeliest first, where nothing is taken yet."""
    if model is None:
        return []
    kept = {(k, s, e) for k, spans in enumerate(base) for s, e in spans}
    rest = [c for c in candidates(text) if c not in kept]
    if not rest:
        return []
    chance = model.chances(np.array([features(text, *c) for c in rest]))
    taken = bytearray(len(text))
    for _, start, end in kept:
        taken[start:end] = b"\1" * (end - start)
    out = []
    for p, (kind, start, end) in sorted(zip(-chance, rest, strict=True)):
        if -p >= model.thresholds[kind] and valid(kind, text[start:end]) and not any(taken[start:end]):
            taken[start:end] = b"\1" * (end - start)
            out.append((kind, start, end))
    return out


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def scan(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # trees of a fixed number and depth

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
        for batch in batches:
            counts, digests, texts, extra = [], [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                spans = [(k, *s) for k, own in enumerate(base) for s in own]
                added = select(text, shared.value, base)
                counts.append([len(own) for own in base])
                digests.append(hashlib.sha256(span_text(spans).encode()).hexdigest())
                texts.append(span_text(spans + added))
                extra.append(len(added))
            by_kind = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            arrays = [*by_kind, pa.array(digests, pa.string()), pa.array(texts, pa.string()), pa.array(extra, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(a) for a in arrays)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        rows, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long"
    )
