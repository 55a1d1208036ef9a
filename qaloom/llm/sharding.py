"""Uniform shuffle into shards of exact size, in DataFrame operations only.

How many rows of each partition go to each shard is drawn first, as a matrix of multivariate hypergeometric counts:
what a uniform permutation of all rows would give. Each partition permutes its rows and deals them out by its row of the
matrix; each shard permutes what it got. Together that is a uniform permutation, and shard sizes are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaloom.storage import materialize

from .columns import fresh


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` taken without return are good; inversion outwards from the mode, for any population."""
    lo, hi = max(0, draws - bad), min(draws, good)
    if lo == hi:
        return lo
    mode = min(hi, max(lo, (draws + 1) * (good + 1) // (good + bad + 2)))
    n, share = float(draws), good / (good + bad)
    reach = int(12 * (n * share * (1 - share)) ** 0.5) + 40
    up = np.arange(mode, min(hi, mode + reach), dtype=np.float64)
    up = np.cumprod((good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1)))
    down = np.arange(mode, max(lo, mode - reach), -1, dtype=np.float64)
    down = np.cumprod(down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1)))
    weight = np.concatenate([down[::-1], [1.0], up])
    at = np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), side="right")
    return mode - len(down) + int(min(at, len(weight) - 1))


def communication_matrix(rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard; column sums differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(rows)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for n in rows:
        line, rest, pool = [], n, sum(left)
        for s in range(shards):
            pool -= left[s]
            line.append(hypergeometric(rng, left[s], pool, rest))
            rest -= line[-1]
        left = [a - b for a, b in zip(left, line)]
        matrix.append(line)
    return matrix


def shuffle_to_shards(rows: DataFrame, shards: int = 16, seed: int = 11) -> DataFrame:
    """All rows with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    The rows are written once, so a partition is a written file and every row has a place of its own: equal rows, null
    keys and ties are told apart, and a repeated task deals alike. The driver gets one count per file and sends back
    one line of ``shards`` counts per file; with files of a task's output each, that is thousands of numbers, however
    many rows there are. Slots come from random numbers: rows are counted in bins of them, a window numbers each bin.
    An empty table gives an empty result; columns named shard or slot must be renamed before.
    """
    spark = rows.sparkSession
    part, row, at, line, rnd, bin_, base = fresh(rows, "part", "row", "at", "line", "rnd", "bin", "base")
    names = rows.columns
    kept = materialize(rows, "shards")
    # The whole name but for the run's random part: a task may write several files, told apart by the number at the end.
    file = F.regexp_replace(F.col("_metadata.file_name"), "[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "")
    kept = kept.select(*names, file.alias(part), F.col("_metadata.row_index").alias(row))
    counts = sorted((r[0], r[1]) for r in kept.groupBy(part).count().collect())
    total = sum(n for _, n in counts)
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    bounds = [(p, [int(x) for x in np.cumsum(line)]) for (p, _), line in zip(counts, matrix)]
    lines = spark.createDataFrame(bounds, f"{part} string, {line} array<bigint>")
    local = Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed), part, row), row)
    dealt = kept.withColumn(at, F.row_number().over(local).cast("bigint")).join(lines, part)
    dealt = dealt.withColumn("shard", F.size(F.filter(line, lambda x: x < F.col(at))).cast("int")).drop(at, line)
    # Inside a shard: the order of a second random number, numbered bin by bin.
    bins = int((total / shards) ** 0.5) + 1
    draw = F.xxhash64(F.lit(seed + 1), part, row)
    dealt = dealt.withColumns({rnd: draw, bin_: F.pmod(draw, F.lit(bins))})
    before = Window.partitionBy("shard").orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", bin_).count().select("shard", bin_, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy("shard", bin_).orderBy(rnd, part, row)
    out = dealt.withColumn(at, F.row_number().over(inside)).join(starts, ["shard", bin_])
    return out.select(*names, "shard", (F.col(base) + F.col(at) - 1).cast("bigint").alias("slot"))
