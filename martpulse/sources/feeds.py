"""Message feeds: rows of (topic, value, timestamp, pos, partition, offset) from a broker or from files, and their parsing.

The same parsing serves streams and tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martpulse.functions.numbers import MONEY
from martpulse.functions.times import is_millis
from martpulse.schemas import CASTS, CHANGE_ENTRY, PLACED_FEED


def broker_options(servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None) -> dict:
    """Options of Spark's ``kafka`` source for one topic."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def broker_feed(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic as a stream; needs Spark's kafka connector on the class path."""
    stream = spark.readStream.format("kafka").option("includeHeaders", "true").options(**broker_options(servers, topic, **options)).load()
    pos = F.element_at(F.map_from_entries(F.col("headers")), F.lit("pos")).cast("string").try_cast("int")
    return stream.select(
        "topic", F.col("value").cast("string").alias("value"), "timestamp", pos.alias("pos"), "partition", "offset"
    )


def file_feed(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of Parquet files with feed rows as a stream; files without places in the log have empty ones."""
    reader = spark.readStream.schema(PLACED_FEED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def topic_of(feed: DataFrame, topic: str) -> DataFrame:
    """One topic of a folder that holds several."""
    return feed.where(F.col("topic") == topic)


def file_changes(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of Parquet files with change entries as a stream; ``max_files`` bounds a batch."""
    reader = spark.readStream.schema(CHANGE_ENTRY)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def changes_of(feed: DataFrame) -> DataFrame:
    """Change entries that a broker delivers as JSON."""
    return feed.select(F.inline(F.array(F.from_json("value", CHANGE_ENTRY)))).where(F.col("entry_type").isNotNull())


def to_feed(records: DataFrame, topic: str, timestamp: Column) -> DataFrame:
    """Records as feed rows, all columns in the JSON value."""
    return records.select(
        F.lit(topic).alias("topic"), F.to_json(F.struct("*")).alias("value"), timestamp.alias("timestamp"),
        F.lit(None).cast("int").alias("pos"),
    )


def _cast(name: str) -> Column:
    kind = CASTS.get(name, "string")
    if kind == "date":
        return F.try_to_timestamp(F.col(name), F.lit("yyyy-MM-dd")).cast("date").alias(name)
    return F.col(name).try_cast(kind).alias(name)


def parse(feed: DataFrame, schema: T.StructType, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of a feed: JSON fields by name, numbers and dates cast, feed columns in ``keep`` carried along.

    Values that are no JSON object, lack ``key``, or whose ``ts`` or amount is out of range are left out; ``rejected``
    returns exactly those.
    """
    # As the input of ``inline`` the text is parsed once; a filter on a parsed field would be pushed below the
    # projection and parse it again.
    fields = feed.select(*keep, F.inline(F.array(F.from_json("value", schema))))
    good = fields.where(_sound(schema, key, F.col))
    return good.select(*[_cast(f.name) for f in schema.fields], *keep)


def only(schema: T.StructType, *names: str) -> T.StructType:
    """The named fields of a schema, and those by which ``parse`` tells whether a record is sound."""
    return T.StructType([f for f in schema.fields if f.name in (*names, "ts", "total_amount")])


def _sound(schema: T.StructType, key: str, field: Callable[[str], Column]) -> Column:
    """The key is there, event times are times, and amounts that are numbers are money."""
    sound = field(key).isNotNull()
    names = schema.fieldNames()
    if "ts" in names:
        sound = sound & F.coalesce(is_millis(field("ts").try_cast("bigint")), F.lit(False))
    if "total_amount" in names:
        amount = field("total_amount").try_cast("double")
        sound = sound & (amount.isNull() | amount.try_cast(MONEY).isNotNull())
    return sound


def rejected(feed: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Feed rows that ``parse`` leaves out."""
    record = F.from_json("value", schema)
    return feed.where(unsound(schema, key, lambda name: record[name]))


def unsound(schema: T.StructType, key: str, field: Callable[[str], Column]) -> Column:
    return ~F.coalesce(_sound(schema, key, field), F.lit(False))


def ahead(ts: Column, arrived: Column, most: str) -> Column:
    """Whether a device's clock runs ahead of the arrival of its message by more than ``most``."""
    return F.coalesce(ts > arrived + F.expr(f"interval '{most}'"), F.lit(False))
