"""Orders and lines that wait for each other: the join of two feeds over rows kept in a table.

A batch's rows are appended below ``side`` and ``slot``. A slot is as long as the wait, so partners of a row lie in its own slot
or in one beside it, and a batch reads those slots only. Joins of a batch are ordinary queries: they are re-planned at run time, spill to
disk and split hot orders, and no row costs a lookup of its own. Rows keep the rules of a join of streams with watermarks: the watermark is the smaller of both sides'
largest times less the wait; what comes behind it is left out, and what it has passed waits no longer.

The table belongs to one checkpoint and lies in it. A batch that is done again overwrites its own rows and finds the marks of those
before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martpulse.functions.times import micros
from martpulse.sources.sinks import _files, _names, latest_mark, put_mark, read_all, run_number, write_batch

TIMES = {"order": "order_ts", "detail": "detail_ts"}


def both(orders: DataFrame, details: DataFrame) -> DataFrame:
    """The rows of both sides as one stream; columns of the other side are empty."""
    rows = [df.withColumn("side", F.lit(side)) for side, df in (("order", orders), ("detail", details))]
    return rows[0].unionByName(rows[1], allowMissingColumns=True)


def _at() -> Column:
    return F.unix_micros(F.coalesce(*TIMES.values()))


class Waiting:
    """The waiting rows as a batch finds them, its own among them; times are in microseconds."""

    def __init__(self, batch: DataFrame, batch_id: int, path: str, expiry: str):
        self.spark, self.batch_id, self.path = batch.sparkSession, batch_id, path
        self.columns = {side: [c for c in batch.columns if c != "side"] for side in TIMES}
        self.length = self.spark.range(1).select(micros(expiry)).first()[0]
        self.run = run_number(self.spark, path)
        self.before = {side: latest_mark(self.spark, f"{path}/_{side}", self.run, batch_id) for side in TIMES}
        self.passed = self._watermark(self.before)
        on_time = _at().isNotNull() if self.passed is None else _at() > self.passed
        slot = F.floor(_at() / self.length).cast("bigint")
        # In order of arrival a task holds few slots: nothing is shuffled for this write.
        write_batch(batch.where(on_time).withColumn("slot", slot), batch_id, path, ["side", "slot"], even=False)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
        self.rows = read_all(self.spark, path, f"{schema}, slot BIGINT")
        own = self.rows.where(F.col("batch_id") == batch_id).groupBy("side").agg(F.min(_at()).alias("low"), F.max(_at()).alias("high"))
        self.spans = {r.side: (r.low, r.high) for r in own.collect()}  # two rows
        self.after = {
            side: max((m for m in (self.before[side], self.spans.get(side, (None, None))[1]) if m is not None), default=None) for side in TIMES
        }
        self.passing = self._watermark(self.after)

    def _watermark(self, marks: dict[str, int | None]) -> int | None:
        return None if None in marks.values() else min(marks.values()) - self.length

    def new(self, side: str, high: int | None = None) -> DataFrame:
        """The batch's rows of a side, those not after ``high``."""
        return self._between(side, None, high).where(F.col("batch_id") == self.batch_id)

    def old(self, side: str, low: int, high: int) -> DataFrame:
        """Rows of earlier batches, of the slots from ``low`` to ``high``."""
        return self._between(side, low, high).where(F.col("batch_id") < self.batch_id)

    def all(self, side: str, low: int | None, high: int) -> DataFrame:
        return self._between(side, low, high)

    def _between(self, side: str, low: int | None, high: int | None) -> DataFrame:
        rows = self.rows.where((F.col("side") == side) & (F.col("batch_id") <= self.batch_id))
        if low is not None:
            rows = rows.where(F.col("slot") >= low // self.length)
        return rows if high is None else rows.where(F.col("slot") <= high // self.length)

    def reach(self, side: str) -> tuple[int, int]:
        """The least and largest time that partners of the batch's rows of a side can have."""
        low, high = self.spans[side]
        return low - self.length, high + self.length

    def done(self) -> None:
        """Note how far both sides have come, and forget slots that no row can reach any more, also if this batch is done again."""
        for side, mark in self.after.items():
            if mark is not None:
                put_mark(self.spark, f"{self.path}/_{side}", self.run, self.batch_id, mark)
        if self.passed is None:
            return
        gone = (self.passed - 2 * self.length) // self.length
        for batch in _names(self.spark, f"{self.path}/run={self.run}"):
            folder, left = f"{self.path}/run={self.run}/{batch}", batch == f"batch_id={self.batch_id}"
            for side in TIMES:
                for name in _names(self.spark, f"{folder}/side={side}"):
                    if name.startswith("slot=") and int(name.partition("=")[2]) < gone:
                        self._delete(f"{folder}/side={side}/{name}")
                    else:
                        left = True
            if not left:
                self._delete(folder)

    def _delete(self, path: str) -> None:
        files, at = _files(self.spark, path)
        files.delete(at, True)
