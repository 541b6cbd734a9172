"""Places in a topic's log that a table has taken, so that a message delivered again changes nothing.

A message's place is its topic, partition and offset. Taken offsets are stored as runs without gaps, one row each, cut at every
``BLOCK`` offsets, so that a lookup is an equality on the block and no row meets more than a block's runs. Messages of
feeds without places have none; all of them are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martpulse.sources.sinks import read_before, write_batch

PLACE = {"topic": "string", "partition": "int", "offset": "bigint"}
TAKEN = "topic STRING, partition INT, block BIGINT, low BIGINT, high BIGINT"
BLOCK = 4096


def placed(feed: DataFrame) -> DataFrame:
    """The feed with columns for places, empty where it has none."""
    return feed.withColumns({name: F.lit(None).cast(kind) for name, kind in PLACE.items() if name not in feed.columns})


def block_of(offset: Column) -> Column:
    return F.floor(offset / BLOCK)


def taken_by(rows: DataFrame) -> DataFrame:
    """The runs of offsets among rows with places."""
    keys = ["topic", "partition", "block"]
    places = rows.select("topic", "partition", "offset", block_of(F.col("offset")).alias("block")).where(F.col("offset").isNotNull()).distinct()
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("offset"))
    return places.withColumn("start", F.col("offset") - nth).groupBy(*keys, "start").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high")
    ).select(*keys, "low", "high")


def not_taken(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows at places that are not taken, each place once; rows without a place as they are."""
    with_place = rows.where(F.col("offset").isNotNull()).dropDuplicates(list(PLACE))
    met = taken.select(*[F.col(name).alias(f"taken_{name}") for name in ("topic", "partition", "block", "low", "high")])
    fresh = with_place.join(
        met,
        F.col("topic").eqNullSafe(F.col("taken_topic")) & F.col("partition").eqNullSafe(F.col("taken_partition"))
        & (block_of(F.col("offset")) == F.col("taken_block")) & F.col("offset").between(F.col("taken_low"), F.col("taken_high")),
        "left_anti",
    )
    return fresh.unionByName(rows.where(F.col("offset").isNull()))


PLACES = "_places"  # Spark's readers of a table skip names that begin so


def fresh_rows(rows: DataFrame, low: int | None, high: int | None, batch_id: int, table: str) -> DataFrame:
    """The rows of a batch at places that no other batch of the table has taken, whichever run wrote it.

    ``low`` and ``high`` are the batch's least and largest block; only the runs stored for blocks between them are read.
    """
    if high is None:
        return rows
    taken = read_before(rows.sparkSession, f"{table}/{PLACES}", TAKEN, batch_id)
    return not_taken(rows, taken.where(F.col("block").between(low, high)))


def take(rows: DataFrame, batch_id: int, table: str) -> None:
    """Note the places of a batch. One that is done again overwrites its own, and never meets them."""
    write_batch(taken_by(rows), batch_id, f"{table}/{PLACES}")
