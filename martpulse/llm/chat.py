"""Multi-party perspective rotation: every participant's view of a dialogue, as training text with masks.

For each participant (distinct speaker other than ``system``), the dialogue is rendered with that speaker's turns under
the assistant's header and everyone else's under a user header with their name; the mask names the code points to train on:
the participant's own words and the end mark after them.

A dialogue of any length is cut into parts of ``part_turns`` turns, so that no row or task holds a whole one. Each part
begins with the dialogue's opening: the system turns it starts with, as far as they lie in the first part. In later parts they are
context carried over (``carried`` tells how many) and not counted in ``turns``; they are never trained on, as a system turn is nobody's
own. Numbers of turns come from counts per block of turn numbers, never from a pass over one dialogue.

Defined cases: a null or empty role speaks as ``unknown``; a null text is empty; null turns come first; equal turns are
ordered by role, then text; repeated rows are turns of their own; a null conv_id is a dialogue of its own; a dialogue
of system turns only has no participant and gives no row; ``<|`` in texts and roles is written ``< |``, and line ends and other
control characters in roles are blanks, so that no text can forge a mark and no role a header; roles that become equal are one speaker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martpulse.llm.store import settle

# The marks of the ChatML format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"


def _clean(col: Column) -> Column:
    return F.replace(F.coalesce(col, F.lit("")), F.lit("<|"), F.lit("< |"))


def _named(role: Column) -> Column:
    return F.regexp_replace(_clean(role), r"[\x00-\x1F\x7F\x{85}\x{2028}\x{2029}]", " ")


def ranked(turns: DataFrame, block_turns: int = 64) -> DataFrame:
    """(conv_id, speaker, said, rank): place of each turn in its dialogue, from 0."""
    speaker = F.when(F.coalesce(F.col("role"), F.lit("")) == "", F.lit("unknown")).otherwise(_named(F.col("role")))
    rows = turns.select(
        "conv_id", "turn", speaker.alias("speaker"), _clean(F.col("text")).alias("said"),
        F.floor(F.col("turn") / block_turns).alias("block"),
    )
    counts = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    along = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(
        counts.select(
            F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(along), F.lit(0)).alias("start")
        ),
        "chat-starts",
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "speaker", "said")
    return rows.join(
        starts, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    ).select("conv_id", "speaker", "said", (F.col("start") + F.row_number().over(inside) - 1).alias("rank"))


def rotate(turns: DataFrame, part_turns: int = 64) -> DataFrame:
    """(conv_id, participant, part, turns, carried, text, mask): one row per participant and part of a dialogue.

    ``mask`` is an array of (start, end) code points within ``text``, end exclusive.
    """
    rows = ranked(turns, part_turns)
    people = rows.where(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("c"), F.col("speaker").alias("participant")
    ).distinct()
    parts = (
        rows.withColumn("part", F.floor(F.col("rank") / part_turns))
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "speaker", "said"))).alias("said"))
    )
    # In a part that is sorted by rank, the system turns it begins with; those of part 0 open every part.
    lead = F.coalesce(F.array_position(F.transform("said", lambda t: t["speaker"] != SYSTEM), True), F.lit(0)) - 1
    openings = parts.where((F.col("part") == 0) & (F.get("said", F.lit(0))["speaker"] == SYSTEM)).select(
        F.col("conv_id").alias("o"), F.slice("said", F.lit(1), F.when(lead < 0, F.size("said")).otherwise(lead)).alias("opening")
    )
    led = parts.join(openings, F.col("conv_id").eqNullSafe(F.col("o")), "left").withColumn(
        "opening", F.when((F.col("part") > 0) & F.col("opening").isNotNull(), F.col("opening")).otherwise(F.slice("said", 1, 0))
    )
    views = led.select(
        "conv_id", "part", F.size("said").alias("turns"), F.size("opening").alias("carried"), F.concat("opening", "said").alias("said")
    ).join(people, F.col("conv_id").eqNullSafe(F.col("c")))

    def head(t: Column) -> Column:
        return (
            F.when(t["speaker"] == F.col("participant"), F.lit(f"{OPEN}assistant\n"))
            .when(t["speaker"] == SYSTEM, F.lit(f"{OPEN}system\n"))
            .otherwise(F.concat(F.lit(f"{OPEN}user name="), t["speaker"], F.lit("\n")))
        )

    def piece(t: Column) -> Column:
        return F.struct(
            F.concat(head(t), t["said"], F.lit(CLOSE)).alias("text"),
            F.length(head(t)).alias("head"),
            (t["speaker"] == F.col("participant")).alias("own"),
        )

    pieces = views.withColumn("pieces", F.transform("said", piece))
    ends = pieces.withColumn(
        "ends",  # at most twice part_turns entries
        F.transform(
            F.sequence(F.lit(1), F.size("pieces")),
            lambda i: F.aggregate(
                F.slice("pieces", F.lit(1), i), F.lit(0), lambda acc, p: acc + F.length(p["text"])
            ),
        ),
    )
    spans = F.zip_with(
        "pieces", "ends",
        lambda p, end: F.struct(
            p["own"].alias("own"), (end - F.length(p["text"]) + p["head"]).alias("start"), end.alias("end")
        ),
    )
    own = F.filter(spans, lambda s: s["own"])
    return ends.select(
        "conv_id", "participant", "part", "turns", "carried",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"),
        F.transform(own, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("mask"),
    )


def mask_text(mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
