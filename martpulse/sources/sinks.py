"""Document tables: every batch is appended, the newest document per id is what readers see.

A micro-batch writes only its own rows, below ``run=<r>/batch_id=<n>``; rewriting that folder makes a replayed batch
harmless. A run is one streaming query with one checkpoint: a job that starts with a new checkpoint on an existing
table counts its batches from 0 again, but gets the next run number, so it replaces nothing. Newest is what was seen last,
by the time in the rows (``order``); run and batch only decide between rows of the same time, so that a job that
goes over an old feed again leaves newer rows alone.

Rewriting whole day partitions for each batch of a few seconds would cost far more than the batch. ``fold_days`` folds the batches of closed days
into one while the job runs; ``compact`` folds a whole table into a new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martpulse.operators.keyed import latest_per

WRITTEN = "run BIGINT, batch_id BIGINT"
RUNS = "_runs"  # hidden from readers of the table
FOLDED = "_folded"  # folders whose rows a fold has copied, to be deleted by the next


def _files(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path as its own."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    files, at = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []


def run_number(spark: SparkSession, path: str) -> int:
    """The run that the current batch belongs to: 0 outside of streams, else one per streaming query of this table.

    The query's id lives in its checkpoint, so a restart finds its number again. A table has one writer at a time.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        return 0
    known = dict(reversed(name.split("_", 1)) for name in _names(spark, f"{path}/{RUNS}"))
    if query not in known:
        known[query] = str(max((int(n) for n in known.values()), default=0) + 1)
        files, at = _files(spark, f"{path}/{RUNS}/{known[query]}_{query}")
        files.mkdirs(at)
    return int(known[query])


def even_files(rows: DataFrame, *partition: str) -> DataFrame:
    """Rows arranged for a write by ``partition``: small days share a task, a huge day is split."""
    return rows.hint("rebalance", *partition)


def write_batch(
    rows: DataFrame, batch_id: int, path: str, partition: str | list[str] | None = None, even: bool = True,
) -> None:
    """``even=False`` writes the tasks' rows as they lie, without a shuffle: for rows whose tasks hold few folders each."""
    target = f"{path}/run={run_number(rows.sparkSession, path)}/batch_id={batch_id}"
    if partition:
        by = [partition] if isinstance(partition, str) else partition
        (even_files(rows, *by) if even else rows).write.mode("overwrite").partitionBy(*by).parquet(target)
    else:
        rows.write.mode("overwrite").parquet(target)


def read_all(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All appended rows with their run and batch."""
    return spark.read.schema(f"{schema}, {WRITTEN}").parquet(path)


def any_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table has any batch."""
    return any(name.startswith("run=") for name in _names(spark, path))


def read_before(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """All rows but those of the running batch, which a replay of it must not meet; none if there is no table yet."""
    run = run_number(spark, path)
    if not any_rows(spark, path):
        return spark.createDataFrame([], f"{schema}, {WRITTEN}")
    return read_all(spark, path, schema).where(~((F.col("run") == run) & (F.col("batch_id") >= batch_id)))


def stream_all(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table's rows as a stream, batch by batch as they are written; a replayed batch may be delivered twice."""
    files, at = _files(spark, path)
    files.mkdirs(at)
    return spark.readStream.schema(f"{schema}, {WRITTEN}").parquet(path)


def read_latest(
    spark: SparkSession, path: str, schema: str, keys: list[str], order: list[str] = (), columns: list[str] | None = None
) -> DataFrame:
    """The newest row per key: the largest ``order`` wins, then later runs and batches.

    Name columns that never change for an id, such as the day a table is stored by, among ``keys``: filters on them then
    reach the scan. ``columns`` are those wanted besides the keys; others are not read.
    """
    rows = read_all(spark, path, schema)
    newest = [*order, "run", "batch_id"]
    if columns is not None:
        wanted = [*keys, *columns, *newest]
        rows = rows.select(*[c for c in rows.columns if c in wanted])
    found = latest_per(rows, keys, newest).drop("run", "batch_id")
    return found if columns is None else found.select(*[c for c in found.columns if c in (*keys, *columns)])


def save_partitioned(rows: DataFrame, path: str, partition: str) -> None:
    """Write a new table by ``partition``."""
    even_files(rows, partition).write.mode("errorifexists").partitionBy(partition).parquet(path)


def compact(
    spark: SparkSession, source: str, target: str, schema: str, keys: list[str], partition: str,
    order: list[str] = (),
) -> None:
    """Write the newest rows of ``source`` as the first batch of the new table ``target``."""
    latest = read_latest(spark, source, schema, keys, order)
    save_partitioned(latest, f"{target}/run=0/batch_id=0", partition)


def fold_days(
    spark: SparkSession, path: str, schema: str, keys: list[str], partition: str, days: list[str], order: list[str] = (),
) -> None:
    """Fold the batches of some days into one, while the job goes on; ``keys`` must include ``partition``.

    Only what is finished is touched: all batches but the newest. The folded rows go to a new batch of run 0; the folders they
    came from are noted, and the next fold deletes them, so that a reader that has listed them can finish. Till then readers see rows
    twice, which changes nothing, as they take the newest per key; a fold that breaks off is mended by the next.
    ``order`` must be that of ``read_latest``: which row is newest must not depend on the batch it lies in.
    """
    _delete_folded(spark, path)
    places = [
        (int(run.partition("=")[2]), int(batch.partition("=")[2]))
        for run in _names(spark, path) if run.startswith("run=")
        for batch in _names(spark, f"{path}/{run}") if batch.startswith("batch_id=")
    ]
    done = sorted(places)[:-1]
    found = {
        day: [(run, folder) for run, batch in done
              if _files(spark, folder := f"{path}/run={run}/batch_id={batch}/{partition}={day}")[0].exists(_files(spark, folder)[1])]
        for day in days
    }
    # A day that lies in one folder of run 0 is folded already.
    folders = [folder for of in found.values() if [run for run, _ in of] != [0] for _, folder in of]
    if len(folders) < 2:
        return
    rows = spark.read.schema(f"{schema}, {WRITTEN}").option("basePath", path).parquet(*folders)
    folded = max((batch for run, batch in places if run == 0), default=-1) + 1
    latest = latest_per(rows, keys, [*order, "run", "batch_id"]).drop("run", "batch_id")
    even_files(latest, partition).write.mode("errorifexists").partitionBy(partition).parquet(f"{path}/run=0/batch_id={folded}")
    note = spark.createDataFrame([(f,) for f in folders], "folder string")
    note.coalesce(1).write.text(f"{path}/{FOLDED}/{folded}")


def _delete_folded(spark: SparkSession, path: str) -> None:
    """Delete the folders that earlier folds have copied."""
    for name in _names(spark, f"{path}/{FOLDED}"):
        note = f"{path}/{FOLDED}/{name}"
        if _files(spark, f"{note}/_SUCCESS")[0].exists(_files(spark, f"{note}/_SUCCESS")[1]):
            for row in spark.read.text(note).collect():  # one line per folder of a fold
                files, at = _files(spark, row.value)
                files.delete(at, True)
            files, at = _files(spark, note)
            files.delete(at, True)


MARKS = "_marks"


def latest_mark(spark: SparkSession, path: str, run: int, batch_id: int) -> int | None:
    """The largest time of all batches of a table before this one, in microseconds."""
    marks = [tuple(int(x) for x in name.split("_")) for name in _names(spark, f"{path}/{MARKS}")]
    return max((m for r, b, m in marks if (r, b) != (run, batch_id)), default=None)


def put_mark(spark: SparkSession, path: str, run: int, batch_id: int, micros: int) -> None:
    """Note the largest time up to a batch; a batch that is replayed has the marks of those before it, never its own."""
    files, at = _files(spark, f"{path}/{MARKS}/{run}_{batch_id}_{micros}")
    files.mkdirs(at)
    for name in _names(spark, f"{path}/{MARKS}"):
        r, b, m = (int(x) for x in name.split("_"))
        if r == run and b < batch_id - 1 and m <= micros:
            files, old = _files(spark, f"{path}/{MARKS}/{name}")
            files.delete(old, True)
