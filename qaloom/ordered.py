"""Places of rows in the order of their group, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that clash with no column of the frame."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, group: str, order: list[Column], pos: str = "pos", total: str = "total") -> DataFrame:
    """All rows with their place in the group (from 0) and the number of its rows.

    Rows are sorted by group and ``order`` over ranges; a last key spreads rows alike in all of these. A row's place is
    its place in the written range and the rows of its group in earlier ranges, of which there is one count a range.
    ``group`` must not be null. Rows alike in ``order`` get places in any order, so nothing else may tell them apart.
    """
    part, at, least, size, before, spread = fresh(df, "part", "at", "least", "size", "before", "spread")
    keys = [F.col(f"`{group}`"), *order, F.col(spread)]
    df = df.withColumn(spread, F.xxhash64(F.monotonically_increasing_id()))
    run = df.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(spread)
    run = materialize(run.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}), "sorted")
    parts = run.groupBy(group, part).agg(F.min(at).alias(least), F.count("*").alias(size))
    own = Window.partitionBy(group)
    earlier = own.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.withColumns({before: F.coalesce(F.sum(size).over(earlier), F.lit(0)), total: F.sum(size).over(own)}).drop(size), "parts")
    placed = run.join(parts, [group, part]).withColumn(pos, F.col(at) - F.col(least) + F.col(before))
    return placed.drop(part, at, least, before)
