"""Exact top-k search by inner product, by distributed histogram selection.

Every query is scored against every row, block by block, once per round. A round counts scores in equal steps of each
query's open interval, over all blocks, and keeps the step that holds the k-th highest score; after a few rounds the
interval holds one score, the k-th. A last pass keeps the scores from there up, and ties go to the smaller id.

Blocks meet by an equality join on (query block, lane), so each task holds two blocks. A block only reports counts
from the top down to its own k-th score, since the k-th of all is never lower: at most k numbers a query and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.storage import materialize

QUERY_ROWS, ROWS = 512, 4096
STEPS = 256
BLOCK = "dim int, n int, ids binary, vectors binary, largest bigint"


def usable(vector: Column) -> Column:
    """Not null, not empty, and all components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def _blocks(rows: int):
    """Rows of (id, vector of longs) as blocks of one dimension."""

    def emit(dim: int, part: list) -> pa.RecordBatch:
        ids = np.array([i for i, _ in part], np.int64)
        m = np.array([v for _, v in part], np.int64)
        low, high = int(m.min()), int(m.max())
        return pa.RecordBatch.from_pydict(
            {"dim": pa.array([dim], pa.int32()), "n": pa.array([len(part)], pa.int32()), "ids": [ids.tobytes()], "vectors": [m.tobytes()],
             "largest": pa.array([min(max(high, -low), 1 << 62)], pa.int64())}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = held.setdefault(len(v), [])
                part.append((i, v))
                if len(part) == rows:
                    yield emit(len(v), held.pop(len(v)))
        for dim, part in held.items():
            yield emit(dim, part)

    return run


def _scores(row: dict, exact_in: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of a pair of blocks with the own row of a query set below all others, and the ids of both."""
    dim = row["dim"]
    q = np.frombuffer(row["q_vectors"], np.int64).reshape(-1, dim).astype(exact_in)
    c = np.frombuffer(row["vectors"], np.int64).reshape(-1, dim).astype(exact_in)
    return q @ c.T, np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)


def _exact_in(largest: int, dim: int) -> type:
    """The fastest number type that holds all sums exactly; beyond doubles, longs that wrap."""
    bound = largest * largest * dim
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


def _count(k: int, steps: int):
    """Counts of scores by step, from the top of each query's interval down to the block's own k-th."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s, qids, ids = _scores(row, _exact_in(row["reach"], row["dim"]))
                low = np.array(row["low"], np.int64)
                width = np.array(row["width"], np.int64)
                step = np.floor((s - low[:, None]) / width[:, None]).astype(np.int64)
                step = np.minimum(step, steps)  # above the interval: still part of the count from the top
                step[(step < 0) | (ids[None, :] == qids[:, None])] = steps + 1
                flat = step + (np.arange(len(qids)) * (steps + 2))[:, None]
                counts = np.bincount(flat.ravel(), minlength=len(qids) * (steps + 2)).reshape(len(qids), -1)[:, : steps + 1]
                above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
                q, b = np.nonzero((counts > 0) & (above < k))
                yield pa.RecordBatch.from_pydict(
                    {"q_block": pa.array(np.full(len(q), row["q_block"]), pa.int64()), "place": pa.array(q, pa.int64()),
                     "step": pa.array(b, pa.int64()), "rows": pa.array(counts[q, b], pa.int64())}
                )

    return run


def _take(k: int):
    """Scores from each query's k-th up, at most k of them a block: the highest, ties by smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s, qids, ids = _scores(row, _exact_in(row["reach"], row["dim"]))
                low = np.array(row["low"], np.int64)
                q, c = np.nonzero((s >= low[:, None]) & (ids[None, :] != qids[:, None]))
                score = s[q, c].astype(np.int64)
                order = np.lexsort((ids[c], -score, q))
                q, c, score = q[order], c[order], score[order]
                first = np.searchsorted(q, np.arange(len(qids)))
                keep = np.arange(len(q)) - first[q] < k
                q, c, score = q[keep], c[keep], score[keep]
                yield pa.RecordBatch.from_pydict(
                    {"q_block": pa.array(np.full(len(q), row["q_block"]), pa.int64()), "place": pa.array(q, pa.int64()), "query_id": pa.array(qids[q], pa.int64()),
                     "vec_id": pa.array(ids[c], pa.int64()), "score": pa.array(score, pa.int64())}
                )

    return run


def _packed(name: str) -> Column:
    """Numbers of a query block in the order of their places, as an array."""
    return F.transform(F.array_sort(F.collect_list(F.struct("place", name))), lambda x: x[name])


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20, steps: int = STEPS) -> DataFrame:
    """The ``k`` highest scores of each query: query_id, rank, vec_id, score.

    Both frames hold (id long, vector array<long>) without nulls. A row with the query's id is its own and no candidate;
    vectors of another dimension are no candidates either. Repeated candidates count as often as they occur, a
    repeated query (same id and vector) gives one result. Scores beyond a long wrap around, as its sums do in SQL.
    Queries without any candidate, or an empty table, give no rows.
    """
    spark = rows.sparkSession
    lanes = spark.sparkContext.defaultParallelism
    rows = materialize(rows.mapInArrow(_blocks(ROWS), BLOCK), "rows")
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)))
    q = queries.distinct().mapInArrow(_blocks(QUERY_ROWS), BLOCK)
    q = materialize(q.select(F.xxhash64("ids", "vectors").alias("q_block"), "dim", F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "largest"), "queries")
    far = rows.groupBy("dim").agg(F.max("largest").alias("c")).join(q.groupBy("dim").agg(F.max("largest").alias("q")), "dim")
    bounds = far.agg(F.max(F.greatest("c", "q")), F.max("dim")).first()
    if bounds[0] is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    reach, dim = bounds
    most = min(reach * reach * dim, (1 << 62) - 1)
    heads = q.select("q_block", "dim", "q_n")
    state = heads.select("q_block", F.posexplode(F.sequence(F.lit(1), F.col("q_n"))).alias("place", "x")).select(
        "q_block", F.col("place").cast("bigint").alias("place"), F.lit(-most).cast("bigint").alias("low"), F.lit(2 * most + 1).cast("bigint").alias("span")
    )
    by_dim = rows.select("dim", "lane", "ids", "vectors")

    def pairs(state: DataFrame) -> DataFrame:
        per = state.groupBy("q_block").agg(_packed("low").alias("low"), _packed("width").alias("width"))
        blocks = q.join(per, "q_block").withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).drop("largest")
        numbers = by_dim.join(heads.select("q_block", "dim"), "dim")
        return numbers.join(blocks.drop("dim"), ["q_block", "lane"]).select(
            "q_block", "dim", "ids", "vectors", "q_ids", "q_vectors", "low", "width", F.lit(reach).cast("bigint").alias("reach")
        )

    span = 2 * most + 1
    while span > 1:
        width = -(-span // steps)
        state = state.withColumn("width", F.lit(width).cast("bigint"))
        counts = pairs(state).mapInArrow(_count(k, steps), "q_block bigint, place bigint, step bigint, rows bigint")
        counts = counts.groupBy("q_block", "place", "step").agg(F.sum("rows").alias("rows"))
        # The step in which the count from the top reaches k; with fewer rows, the lowest there is.
        tops = counts.groupBy("q_block", "place").agg(F.array_sort(F.collect_list(F.struct((-F.col("step")).alias("down"), "rows"))).alias("tops"))
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(-1).cast("bigint").alias("step"))
        found = F.aggregate("tops", start, lambda a, x: F.when(a["seen"] >= k, a).otherwise(F.struct((a["seen"] + x["rows"]).alias("seen"), (-x["down"]).alias("step"))))
        found = tops.select("q_block", "place", found.alias("f")).select("q_block", "place", "f.step", (F.col("f.seen") >= k).alias("full"))
        state = state.join(found, ["q_block", "place"], "left")
        up = F.when(F.col("full"), F.col("low") + F.col("step") * F.col("width")).otherwise(F.col("low"))
        state = materialize(state.select("q_block", "place", F.coalesce(up, F.col("low")).alias("low")), "state")
        span = width
    last = pairs(state.withColumn("width", F.lit(1).cast("bigint")))
    near = last.mapInArrow(_take(k), "q_block bigint, place bigint, query_id bigint, vec_id bigint, score bigint")
    best = near.groupBy("q_block", "place", "query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    out = best.select("query_id", F.posexplode("best").alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score"))

