"""Connected components of links, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize


def forest(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """For links a-b: every node that is not the smallest of its group, with the smallest."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for x, y in zip(a, b):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if top(x) != x]
    return nodes, [top(x) for x in nodes]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a batch by those of its forest: no more than nodes."""
    for batch in batches:
        a, b = forest(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one link and is nobody's ``b``: then each group is a star around its smallest id."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("b", F.lit(0), F.lit(1)))
    once = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return once.filter("down > 1 OR down = 1 AND up = 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to (id, component): the smallest id that is reachable, for every id that is not itself that.

    Each batch of links is first replaced by its forest. Then large and small stars alternate until all groups are stars,
    which takes a number of rounds that grows with the logarithm of the longest chain. A hub's links are spread by the
    join, since the smallest neighbours are a written table; nothing is gathered on the driver but one number a round.
    """
    links = links.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).filter("a <> b")
    edges = materialize(links.mapInArrow(_contract, "a bigint, b bigint").distinct(), "links")
    while not _stars(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = materialize(both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        met = large.join(least, "a")
        pair = F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        edges = materialize(met.select(pair.alias("p")).select("p.a", "p.b").filter("a <> b").distinct(), "small")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
