"""Feeding a table to a streaming job piece by piece."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def time_span(feed: DataFrame, time: str) -> tuple[int, int]:
    """Smallest and largest time of a feed, in microseconds."""
    return tuple(feed.agg(F.unix_micros(F.min(time)), F.unix_micros(F.max(time))).first())


def replay(
    feeds: dict[str, DataFrame],
    start: Callable[[], StreamingQuery] | list[Callable[[], StreamingQuery]],
    pieces: int = 3,
    time: str = "timestamp",
    closing: dict[str, DataFrame] | None = None,
    timeout: int = 600,
) -> list[dict]:
    """Append the feeds to their folders slice by slice and run the job over each slice.

    ``start`` starts the job over those folders with the ``availableNow`` trigger and always the same
    checkpoint, so each slice also resumes the job from it; jobs of a list are run one after the other, each over what those
    before it have written. Within a slice Spark reads any number of files at
    once; between slices time moves forward, so nothing comes late. ``closing`` rows are appended last, to move
    the watermark past the end. Returns the progress reports of all runs.
    """
    spans = [time_span(feed, time) for feed in feeds.values()]
    low, high = min(s[0] for s in spans), max(s[1] for s in spans)
    step = (high - low) // pieces + 1
    edges = [F.timestamp_micros(F.lit(low + i * step)) for i in range(pieces + 1)]
    reports = []
    for piece in range(pieces + (1 if closing else 0)):
        for path, feed in feeds.items():
            if piece == pieces:
                rows = closing[path]
            else:
                rows = feed.where((F.col(time) >= edges[piece]) & (F.col(time) < edges[piece + 1]))
            rows.write.mode("append").parquet(path)
        for begin in start if isinstance(start, list) else [start]:
            query = begin()
            try:
                if not query.awaitTermination(timeout):
                    raise TimeoutError(f"streaming job not done after {timeout} s")
                reports += query.recentProgress
            finally:
                query.stop()
    return reports
