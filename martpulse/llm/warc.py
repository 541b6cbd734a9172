"""WARC archives with an external merge of their capture index.

Pages are written as WARC records (one gzip member each) into archives in the shared folder. Every write task sorts the index
entries of its archives by URL key, timestamp and page: a locally sorted capture run. Runs are then dealt out by key
range, and each range merges its pieces of the k runs with a loser tree, so that the ranges in order hold the globally
ordered capture history. Ranges cut within a URL too, since timestamp and page belong to the key.

Payloads of at least ``least`` bytes that occur more than once are stored once, by the page with the largest page_id;
the others are revisit records that refer to it. Rows with that same page_id and payload are all responses.

A retried or doubled task writes archives of another name; only those of committed tasks are in the index table, and
only the index leads readers to archives.

Defined cases: null html is an empty payload; a null page_id is written as ``null`` and is the smallest; a null url has the key
``-``; without a timestamp column, pages are dated by their page_id in seconds from ``EPOCH``; other columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martpulse.llm.store import settle
from martpulse.session import work_dir

EPOCH = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
ROLL_BYTES = 64 << 20  # an archive is closed beyond this size
RUN_ROWS = 100_000  # a run is closed at this length
RANGE_ROWS = 100_000  # captures that one merge task is meant to hold

INDEX = (
    "run string, urlkey string, ts string, page_id long, file string, offset long, length long, digest string, "
    "record_type string"
)
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "intact boolean"
)


def url_key(url: str | None) -> str:
    """The host's labels in reverse, then path and query, in lower case, without scheme, ``www.`` and fragment."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host = re.sub(r"^www\d*\.", "", parts.hostname or "")
    except ValueError:
        return (url or "-").strip().lower() or "-"
    if not host:
        return (url or "-").strip().lower() or "-"
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def record(page_id: int | None, url: str | None, date: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has headers only, with the digest and length of the payload it stands for."""
    kind = "response" if refers_to is None else "revisit"
    target = re.sub(r"[\x00-\x1f\x7f]", "", url or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        lines += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    block = head if refers_to is not None else head + payload
    return ("\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one record; ``intact`` tells whether the payload has the length and digest it is said to have."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    number = lambda name: None if "null" in fields[name] else int(re.search(r"-?\d+", fields[name])[0])
    if kind == "response":
        digest_read, size = hashlib.sha1(payload).hexdigest(), len(payload)
    else:
        digest_read, size = digest, told
    return {
        "page_id": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": size,
        "payload_digest": digest_read, "record_type": kind,
        "refers_to": number("WARC-Refers-To") if kind == "revisit" else None,
        "intact": digest_read == digest and size == told and rest[len(block) :] == b"\r\n\r\n",
    }


def decide(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Pages with digest and ``refers_to`` (null for responses). Only digests travel for this, unless they repeat."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    date = F.col("ts").cast("timestamp") if "ts" in pages.columns else F.lit(None).cast("timestamp")
    hashed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), date.alias("date"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"),
    )
    shared = settle(
        hashed.where(F.col("bytes") >= least).groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("d"), "first"),
        "warc-shared",
    )
    hit = (F.col("digest") == F.col("d")) & (F.col("bytes") >= least)
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    return hashed.join(shared, hit, "left").select("page_id", "url", "payload", "date", "digest", refers.alias("refers_to"))


def write(decided: DataFrame, folder: str) -> DataFrame:
    """Writes the archives; returns the sorted runs of their index as a table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        out, at, archive, runs, entries = None, 0, 0, 0, []

        def close_run() -> pa.RecordBatch:
            nonlocal runs, entries
            entries.sort()
            columns = [[f"{name}-{runs}"] * len(entries), *zip(*entries, strict=True)]
            columns[3] = [p if known else None for known, p in columns[3]]
            runs, entries = runs + 1, []
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in INDEX.split(", ")]
            )

        for batch in batches:
            for page_id, url, payload, date, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    file = f"{name}-{archive:03d}.warc.gz"
                    out, at = store.open_output_stream(f"{root}/{file}", compression=None), 0
                when = date or EPOCH + datetime.timedelta(seconds=(page_id or 0) % 10**9)
                raw = record(page_id, url, when.strftime("%Y-%m-%dT%H:%M:%SZ"), payload, digest, refers_to)
                press = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = press.compress(raw) + press.flush()
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                known = (page_id is not None, page_id or 0)
                entries.append((url_key(url), when.strftime("%Y%m%d%H%M%S"), known, file, at, len(member), digest, kind))
                at += len(member)
                if at >= ROLL_BYTES:
                    out.close()
                    out, archive = None, archive + 1
                if len(entries) >= RUN_ROWS:
                    yield close_run()
        if out is not None:
            out.close()
        if entries:
            yield close_run()

    return settle(decided.mapInArrow(rows, INDEX), "warc-runs")


class LoserTree:
    """k-way merge: every inner node keeps the loser of its match, so a new head replays one path of log2(k) matches."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.at = runs, [0] * len(runs)
        self.k = max(1, len(runs))
        self.losers = [-1] * self.k
        self.winner = self._build()

    def _head(self, r: int) -> tuple:
        """Run r's head; a finished run loses every match."""
        if r < len(self.runs) and self.at[r] < len(self.runs[r]):
            return (0, self.runs[r][self.at[r]], r)
        return (1, (), r)

    def _build(self) -> int:
        winners = [-1] * self.k + list(range(self.k))
        for n in range(self.k - 1, 0, -1):
            a, b = winners[2 * n], winners[2 * n + 1]
            winners[n], self.losers[n] = (a, b) if self._head(a) < self._head(b) else (b, a)
        return winners[1] if self.k > 1 else 0

    def __iter__(self) -> Iterator[tuple]:
        while (head := self._head(self.winner))[0] == 0:
            yield head[1]
            self.at[self.winner] += 1
            here, n = self.winner, (self.winner + self.k) // 2
            while n:
                if self._head(self.losers[n]) < self._head(here):
                    here, self.losers[n] = self.losers[n], here
                n //= 2
            self.winner = here


def merge(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The global index: ranges in order of (urlkey, ts, page_id), each merged from its pieces of the runs.

    Column ``range`` numbers the ranges, ``place`` the captures within; (range, place) is the global order.
    """
    spark = runs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // range_rows))
    key = [F.col("urlkey"), F.col("ts"), F.col("page_id").asc_nulls_first()]
    names = [f.split()[0] for f in INDEX.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[tuple]] = {}
        for batch in batches:
            for run, *entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                entry[2] = (entry[2] is not None, entry[2] or 0)
                pieces.setdefault(run, []).append(tuple(entry))
        place = 0
        pid = TaskContext.get().partitionId()
        stream = iter(LoserTree(list(pieces.values())))
        while chunk := [e for _, e in zip(range(10_000), stream)]:  # noqa: B905
            columns = [list(c) for c in zip(*chunk, strict=True)]
            columns[2] = [p if known else None for known, p in columns[2]]
            n = len(chunk)
            arrays = [pa.array([pid] * n, pa.int32()), pa.array(range(place, place + n), pa.int64())]
            arrays += [
                pa.array(c, pa.int64() if f in ("page_id", "offset", "length") else pa.string())
                for f, c in zip(names[1:], columns, strict=True)
            ]
            place += n
            yield pa.RecordBatch.from_arrays(arrays, ["range", "place", *names[1:]])

    dealt = runs.repartitionByRange(parts, *key).sortWithinPartitions("run", *key)  # the pieces of a run come whole
    return settle(dealt.mapInArrow(rows, "range int, place long, " + INDEX.partition(", ")[2]), "warc-index")


def read(index: DataFrame, folder: str, stretch: int = 4 << 20) -> DataFrame:
    """Every capture of the index, read back from the archives in stretches of ``stretch`` bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in batches:
            out = []
            for path, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != name:
                    if file:
                        file.close()
                    name, file = path, store.open_input_file(f"{root}/{path}")
                file.seek(offset)
                out.append(parse(zlib.decompress(file.read(length), 31)))
            yield pa.RecordBatch.from_pylist(out, SCHEMA)
        if file:
            file.close()

    return (
        index.select("file", "offset", "length")
        .repartition("file", F.floor(F.col("offset") / stretch))
        .sortWithinPartitions("file", "offset")
        .mapInArrow(rows, READ)
    )


SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_()),
])


def archive(pages: DataFrame, least: int = 1000) -> tuple[str, DataFrame]:
    """(folder of the archives, global index)."""
    folder = work_dir(pages.sparkSession, "warc")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return folder, merge(write(decide(pages, least), folder))
