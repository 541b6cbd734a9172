"""Exact top-k search by inner product: columnar branch and bound over blocks.

1. Candidates are packed into blocks of ``rows`` vectors in vertical layout (one row of the block per dimension); queries into
   blocks too. Every block of candidates meets every block of queries once, as rows of a join on (query block, salt), so that
   the work is spread over salts and query blocks, and no table is broadcast.
2. A query starts with a threshold: its k-th best score among the ``seeds`` longest vectors, which no result can be below.
3. Of a pair of blocks, scores are summed up dimension block by dimension block, those with most of the queries' mass first. A candidate
   whose sum so far plus the product of both remaining masses (Cauchy and Schwarz) stays below the threshold is out; the
   survivors are compacted, and only they are read on. What is left has its exact score, and moves the threshold up.
4. A task keeps the k best per query of what it has seen and gives out these; the best of all tasks are ranked.

Components are floor(256 * x); sums are exact whole numbers. Bounds are widened by more than doubles can err, and a candidate
goes only if it is strictly below the threshold, so that ties are never lost.

Defined cases: a vector that is null or holds a null or a component that is not finite takes no part, as query or candidate; shorter
vectors count as filled up with zeros; a query's own row is every row with its id; repeated rows are candidates each, a
query that is repeated with the same vector is one query, with other vectors one query each; a null id is no query, and as a
candidate comes after all others of its score; with fewer candidates all are given; an empty table gives no rows; other columns are
ignored. A score must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martpulse.llm.store import settle
from martpulse.llm.vectors import matrix, sound, whole

STEP = 8  # dimensions of a block
WIDER = 1 + 1e-9  # bounds are doubles; this is far beyond what they can err by
NO_ID = np.iinfo(np.int64).max  # a null id, last in order


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _pack(width: int, kind: str, rows: int | None = None):
    """Blocks (ids, body) of up to ``rows`` vectors, or (q, ids, body) per number ``q``; body in vertical layout."""

    def block(q: int | None, ids: list, parts: list) -> pa.RecordBatch:
        body = np.ascontiguousarray(np.concatenate(parts).T).astype(kind)
        cells = {"ids": pa.array([np.concatenate(ids).tobytes()], pa.binary()), "body": pa.array([body.tobytes()], pa.binary())}
        return pa.RecordBatch.from_pydict(cells if rows else {"q": pa.array([q], pa.int64()), **cells})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, ids, parts, held = None, [], [], 0
        for batch in batches:
            own, vectors, start = _ids(batch["id"]), matrix(batch["vector"], width), 0
            numbers = None if rows else batch["q"].to_numpy()
            while start < len(own):
                if rows:
                    taken = min(rows - held, len(own) - start)
                else:
                    if held and numbers[start] != q:
                        yield block(q, ids, parts)
                        ids, parts, held = [], [], 0
                    q = numbers[start]
                    taken = int(np.searchsorted(numbers[start:], q, side="right"))
                ids.append(own[start : start + taken])
                parts.append(vectors[start : start + taken])
                held, start = held + taken, start + taken
                if held == rows:
                    yield block(q, ids, parts)
                    ids, parts, held = [], [], 0
        if held:
            yield block(q, ids, parts)

    return run


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class Block:
    """Candidates in vertical layout, dimensions in the order given, with what each has left after every dimension block."""

    def __init__(self, ids: np.ndarray, body: np.ndarray, order: np.ndarray):
        self.ids = ids
        self.body = np.ascontiguousarray(body[order])
        squares = np.square(self.body.astype(np.float64))
        after = np.cumsum(squares[::-1], axis=0)[::-1]
        self.left = [np.sqrt(after[d] if d < len(body) else np.zeros(len(ids))) * WIDER for d in range(STEP, len(body) + STEP, STEP)]

    def search(self, query: np.ndarray, own: int, least: float, k: int, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of candidates that may be among the k best, all those that reach ``least`` in fact.

        ``query`` has its dimensions in the block's order; ``first`` its sums over the first dimension block.
        """
        masses = np.append(np.sqrt(np.cumsum(np.square(query.astype(np.float64))[::-1])[::-1]), 0.0) * WIDER
        live = np.flatnonzero(self.ids != own)
        sums = (query[:STEP] @ self.body[:STEP] if first is None else first)[live]
        for step, left in enumerate(self.left, 1):
            at = step * STEP
            if least > -np.inf:
                reach = sums.astype(np.float64) + left[live] * masses[min(at, len(query))]
                stay = reach + np.abs(reach) * 1e-9 >= least
                if not stay.all():
                    live, sums = live[stay], sums[stay]
            if at >= len(query) or not len(live):
                break
            sums = sums + query[at : at + STEP] @ self.body[at : at + STEP, live]
        return best(sums, self.ids[live], k)


def _merged(held: tuple[np.ndarray, np.ndarray], more: tuple[np.ndarray, np.ndarray], k: int):
    return best(np.concatenate([held[0], more[0]]), np.concatenate([held[1], more[1]]), k)


def _seeded(seeds, k: int, width: int, kind: str):
    """Query blocks with the k-th best score of each query among the seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = seeds.value
        for batch in batches:
            least = []
            for own, body in zip(batch["ids"].to_pylist(), batch["body"].to_pylist(), strict=True):
                own, queries = np.frombuffer(own, np.int64), np.frombuffer(body, kind).astype(np.float64).reshape(width, -1).T
                found = np.full(len(own), -np.inf)
                for start in range(0, len(own) if len(ids) >= k else 0, 256):
                    some = queries[start : start + 256]
                    scores = some @ vectors.T  # in doubles: lowered below for what they may err
                    scores -= np.sqrt(np.square(some).sum(1))[:, None] * np.sqrt(np.square(vectors).sum(1)) * 1e-9
                    scores[own[start : start + 256, None] == ids] = -np.inf
                    found[start : start + 256] = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
                least.append(found.tobytes())
            yield batch.append_column("least", pa.array(least, pa.binary()))

    return run


def _search(k: int, width: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {}

        def given() -> pa.RecordBatch:
            places = [i for i, (scores, _) in held.items() for _ in scores]
            scores = [int(s) for h in held.values() for s in h[0]]
            ids = [None if i == NO_ID else int(i) for h in held.values() for i in h[1]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([current] * len(places), pa.int64()), pa.array(places, pa.int32()), pa.array([int(own[i]) for i in places], pa.int64()),
                    pa.array(ids, pa.int64()), pa.array(scores, pa.int64()),
                ],
                names=["block", "place", "query_id", "vec_id", "score"],
            )

        for batch in batches:
            for row in range(batch.num_rows):
                at = batch["q"][row].as_py()
                if at != current:
                    if held:
                        yield given()
                    current, held = at, {}
                    own = np.frombuffer(batch["ids"][row].as_buffer(), np.int64)
                    queries = np.frombuffer(batch["body"][row].as_buffer(), kind).astype(np.float64).reshape(width, -1).T
                    least = np.frombuffer(batch["least"][row].as_buffer(), np.float64).copy()
                    order = np.argsort(-np.square(queries).sum(0), kind="stable")
                    queries = queries[:, order]
                    most = np.abs(queries).max(initial=0)
                body = np.frombuffer(batch["c_body"][row].as_buffer(), kind).astype(np.float64).reshape(width, -1)
                bound = width * most * np.abs(body).max(initial=0)
                block = Block(np.frombuffer(batch["c_ids"][row].as_buffer(), np.int64), whole(body, bound), order)
                exact = whole(queries, bound)
                for start in range(0, len(own), 64):
                    firsts = exact[start : start + 64, :STEP] @ block.body[:STEP]
                    for i in range(start, min(start + 64, len(own))):
                        found = block.search(exact[i], own[i], least[i], k, firsts[i - start])
                        if not len(found[0]):
                            continue
                        held[i] = now = _merged(held[i], found, k) if i in held else found
                        if len(now[0]) == k:
                            least[i] = max(least[i], float(now[0][-1]))
        if held:
            yield given()

    return run


def top(
    vectors: DataFrame, queries: Column, k: int = 5, id_column: str = "vec_id", column: str = "embedding",
    rows: int = 2048, query_rows: int = 2048, salts: int = 64, seeds: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every row that ``queries`` holds for."""
    spark = vectors.sparkSession
    # floor(256 * x) of a float is a float too, that of a double may not be.
    kind = "<f4" if dict(vectors.dtypes)[column] == "array<float>" else "<f8"
    rows_of = sound(vectors, column).select(
        F.col(id_column).cast("long").alias("id"), F.col(column).alias("vector"), queries.alias("asks")
    )
    width = -(-(rows_of.agg(F.max(F.size("vector"))).first()[0] or 1) // STEP) * STEP

    asked = settle(rows_of.where("asks and id is not null").select("id", "vector").distinct(), "search-queries")
    blocks = -(-asked.count() // query_rows)
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shapes = "ids binary, body binary"
    mass = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    longest = rows_of.select("id", "vector").orderBy(mass.desc(), "id").limit(seeds)  # a fixed number, whatever the table
    packed = longest.mapInArrow(_pack(width, kind, seeds), shapes).collect()
    seed_ids = np.concatenate([np.frombuffer(r.ids, np.int64) for r in packed])
    seed_body = np.concatenate([np.frombuffer(r.body, kind).astype(np.float64).reshape(width, -1) for r in packed], axis=1).T
    shared = spark.sparkContext.broadcast((seed_ids, seed_body))

    questions = (
        asked.withColumn("q", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)))
        .repartition("q").sortWithinPartitions("q")
        .mapInArrow(_pack(width, kind), f"q long, {shapes}")
        .mapInArrow(_seeded(shared, k, width, kind), f"q long, {shapes}, least binary")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    candidates = settle(
        rows_of.select("id", "vector").mapInArrow(_pack(width, kind, rows), shapes).select(
            F.col("ids").alias("c_ids"), F.col("body").alias("c_body"),
            F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int").alias("salt"),
        ),
        "search-candidates",
    )
    met = candidates.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(
        questions, ["q", "salt"]
    )
    found = met.mapInArrow(_search(k, width, kind), "block long, place int, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
