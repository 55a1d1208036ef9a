"""Near duplicates of vectors: exact pairs at a cosine threshold by dual traversal of cover trees.

Vectors of one label lie on the unit sphere, where a cosine is a distance. Cells split by nearest pivots until they are
small; each small cell is a block with a cover tree of its own (nested levels of centers, radii halving), built once.
Blocks side by side form tiles and tiles form groups, each with a center and a covering radius, so blocks are the leaves
of one tree over the label. Pairs of its nodes further apart than their radii and the threshold are dropped unseen, from
the top down; what is left are pairs of tiles. A task gets one such pair, so a block's vectors travel once for several
others, drops pairs of blocks by the same bound and descends the cover trees of the rest together, down to exact cosines.
Where a split would only list its members (vectors without clusters), a node stays whole and is one matrix product.

Equal vectors are one node with a count. A pair of tiles reports counts of links and a forest, never its pairs, so a
group of near copies costs what its vectors cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.storage import materialize

from .graph import components
from .ordered import numbered
from .topk import usable

CELL, PIVOTS, LEAF, DEPTH = 1024, 24, 48, 12
#: Blocks of a tile, tiles or groups of a group, and how many products of members end a descent.
TILE, FAN, PRODUCT = 4, 16, 1 << 16
#: A split into more children than one for so many members is not made.
WORTH = 8
BLOCK = "label string, cell bigint, cut bigint, nodes binary, ids binary, rows binary, vectors binary, tree binary, members binary, center array<double>, radius double"
COVER = "label string, at bigint, center array<double>, radius double"
TREE = np.dtype([("start", "<i4"), ("end", "<i4"), ("center", "<i4"), ("first", "<i4"), ("count", "<i4"), ("radius", "<f8")])
NODE = ["label", "node", "id", "rows", "unit", "cell"]


def _distances(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, ((x - center) ** 2).sum(axis=1)))


class Tree:
    """A cover tree of unit vectors: nodes with a center, a covering radius, a range of members and consecutive children."""

    def __init__(self, x: np.ndarray, nodes: np.ndarray | None = None, members: np.ndarray | None = None):
        self.x = x
        if nodes is None:
            nodes, members = _grown(x)
        self.nodes, self.order = nodes, members
        self.size = nodes["end"] - nodes["start"]
        self.centers = x[nodes["center"]]

    def members(self, node: int) -> np.ndarray:
        return self.order[self.nodes["start"][node] : self.nodes["end"][node]]


def _grown(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Nodes, each after its parent, and the members in the order of their ranges."""
    order = np.arange(len(x))
    start = int(_distances(x, x.mean(axis=0)).argmin())
    reach = float(_distances(x, x[start]).max())
    nodes, scales, at = [[0, len(x), start, 0, 0, reach]], [reach], 0
    while at < len(nodes):
        begin, end, own, _, _, radius = nodes[at]
        left, parts = order[begin:end], []
        if end - begin > leaf and radius >= 1e-9:
            # The node's own center first, then others until all members are covered at half the radius.
            while len(left) and len(parts) * WORTH <= end - begin:
                distance = _distances(x[left], x[own])
                near = distance <= scales[at] / 2
                near[left == own] = True
                parts.append((own, left[near], float(distance[near].max())))
                left, distance = left[~near], distance[~near]
                if len(left):
                    own = int(left[distance.argmax()])
        if parts and not len(left):
            nodes[at][3:5] = len(nodes), len(parts)
            place = begin
            for center, part, radius in parts:
                order[place : place + len(part)] = part
                nodes.append([place, place + len(part), center, 0, 0, radius])
                scales.append(scales[at] / 2)
                place += len(part)
        at += 1
    return np.array([tuple(n) for n in nodes], TREE), order


def _children(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``first`` and hold ``count``."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


def dual(a: Tree, b: Tree, chord: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members of node pairs that may hold a pair within ``chord``; for one tree twice, each pair of nodes once."""
    same = a is b
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(i):
        gap = _distances(a.centers[i], b.centers[j])
        near = gap <= chord + a.nodes["radius"][i] + b.nodes["radius"][j] + 1e-9
        i, j = i[near], j[near]
        kids_a, kids_b = a.nodes["count"][i].astype(np.int64), b.nodes["count"][j].astype(np.int64)
        done = (kids_a + kids_b == 0) | (a.size[i].astype(np.int64) * b.size[j] <= PRODUCT)
        for p, q in zip(i[done].tolist(), j[done].tolist()):
            own = a.members(p)
            yield own, own if same and p == q else b.members(q)
        twin = ~done & (i == j) & same
        left = ~done & ~twin & (kids_a > 0) & ((kids_b == 0) | (a.nodes["radius"][i] >= b.nodes["radius"][j]))
        right = ~done & ~twin & ~left
        first = [a.nodes["first"][i[left]].astype(np.int64), b.nodes["first"][j[right]].astype(np.int64)]
        more_i = [_children(first[0], kids_a[left]), np.repeat(i[right], kids_b[right])]
        more_j = [np.repeat(j[left], kids_a[left]), _children(first[1], kids_b[right])]
        for node in i[twin].tolist():
            p, q = np.triu_indices(int(a.nodes["count"][node]))
            more_i.append(p + a.nodes["first"][node])
            more_j.append(q + a.nodes["first"][node])
        i, j = np.concatenate(more_i), np.concatenate(more_j)


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least number that links i-j reach from each of n."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[i], least[j])
        before = least.copy()
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
        least = least[least]
        if np.array_equal(before, least):
            return least


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cell of the nearest pivot below a cell."""
    for batch in batches:
        unit, pivots = batch.column("unit"), batch.column("pivots")
        x = np.split(unit.flatten().to_numpy(zero_copy_only=False), np.cumsum(unit.value_lengths().to_numpy(zero_copy_only=False))[:-1])
        out = []
        made: dict[tuple[str, int], np.ndarray] = {}  # a cell has its number within a label
        for i, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("cell").to_pylist())):
            if not pivots[i].is_valid:
                out.append(key[1])
                continue
            if key not in made:
                made[key] = np.array(pivots[i].as_py())
            out.append(key[1] * 64 + 1 + int(np.argmax(made[key] @ x[i])))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in NODE[:-1]), pa.array(out, pa.int64())], names=NODE)


def _pack(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("node")
    x = np.array(part["unit"].tolist())
    center, tree = x.mean(axis=0), Tree(x)
    return pd.DataFrame({
        "label": [part["label"].iloc[0]], "cell": [part["cell"].iloc[0]], "cut": [part["cut"].iloc[0]],
        **{name: [part[c].to_numpy(np.int64).tobytes()] for name, c in (("nodes", "node"), ("ids", "id"), ("rows", "rows"))},
        "vectors": [x.tobytes()], "tree": [tree.nodes.tobytes()], "members": [tree.order.astype("<i4").tobytes()],
        "center": [center.tolist()], "radius": [float(_distances(x, center).max())],
    })


def _cover(part: pd.DataFrame) -> pd.DataFrame:
    """The center and covering radius of nodes (label, at, center, radius) below one node."""
    centers = np.array(part["center"].tolist())
    center = centers.mean(axis=0)
    reach = float((_distances(centers, center) + part["radius"].to_numpy()).max())
    return pd.DataFrame({"label": [part["label"].iloc[0]], "at": [part["at"].iloc[0]], "center": [center.tolist()], "radius": [reach]})


def _descended(heads: DataFrame, chord: float) -> DataFrame:
    """Pairs (label, a, b), a <= b, of tiles that may hold near vectors, by a dual descent from the top of each label.

    ``heads`` has a center and a radius for every block and the place ``pos`` of the block in its label.
    """
    rows = heads.select("label", F.floor(F.col("pos") / TILE).alias("at"), "center", "radius")
    levels = [materialize(rows.groupBy("label", "at").applyInPandas(_cover, COVER), "tiles")]
    while (levels[-1].agg(F.max("at")).first()[0] or 0) > 0:
        rows = levels[-1].withColumn("at", F.floor(F.col("at") / FAN))
        levels.append(materialize(rows.groupBy("label", "at").applyInPandas(_cover, COVER), "groups"))
    pairs = levels[-1].select("label", F.col("at").alias("a"), F.col("at").alias("b"))
    far = F.sqrt(F.aggregate(F.zip_with("center_a", "center_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x))
    for level in reversed(levels[:-1]):
        up = F.floor(F.col("at") / FAN)
        a, b = (level.select("label", up.alias(s), F.col("at").alias(f"at_{s}"), F.col("center").alias(f"center_{s}"), F.col("radius").alias(f"radius_{s}")) for s in "ab")
        met = pairs.join(a, ["label", "a"]).join(b, ["label", "b"]).filter("at_a <= at_b").filter(far <= F.col("radius_a") + F.col("radius_b") + chord + 1e-9)
        pairs = materialize(met.select("label", F.col("at_a").alias("a"), F.col("at_b").alias("b")), "pairs")
    return pairs


class _Loaded:
    """A block as it is read in a task, with the place of its nodes among those of the task."""

    def __init__(self, row, base: int):
        self.nodes, self.ids, self.rows = (np.frombuffer(getattr(row, c), np.int64) for c in ("nodes", "ids", "rows"))
        x = np.frombuffer(row.vectors, np.float64).reshape(len(self.ids), -1)
        self.tree = Tree(x, np.frombuffer(row.tree, TREE), np.frombuffer(row.members, "<i4"))
        self.center, self.radius = np.array(row.center), row.radius
        self.tile, self.base, self.links = row.tile, base, np.zeros(len(self.ids), np.int64)


def _joined(cosine: float):
    """Counts (node, id, links) and forest links (id, other) of each pair of tiles."""
    chord = float(np.sqrt(max(0.0, 2 - 2 * cosine)))

    def meet(a: _Loaded, b: _Loaded) -> tuple[np.ndarray, np.ndarray]:
        """Links within or between blocks: counted at both ends, and given as a forest of the task's places."""
        n = len(a.ids)
        i_all, j_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for p, q in dual(a.tree, b.tree, chord):
            i, j = np.nonzero(a.tree.x[p] @ b.tree.x[q].T >= cosine)
            if p is q:
                i, j = i[i < j], j[i < j]
            i, j = p[i], q[j]
            a.links += np.bincount(i, b.rows[j], n).astype(np.int64)
            b.links += np.bincount(j, a.rows[i], len(b.ids)).astype(np.int64)
            i_all.append(i)
            j_all.append(j)
        i, j = np.concatenate(i_all), np.concatenate(j_all)
        if a is b:
            least = spanning(i, j, n)
            low = np.flatnonzero(least != np.arange(n))
            return low + a.base, least[low] + a.base
        least = spanning(i, j + n, n + len(b.ids))
        low = np.flatnonzero(least != np.arange(len(least)))
        place = np.concatenate([np.arange(n) + a.base, np.arange(len(b.ids)) + b.base])
        return place[low], place[least[low]]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        blocks, base = [], 0
        for row in part.sort_values("pos").itertuples():
            blocks.append(_Loaded(row, base))
            base += len(blocks[-1].ids)
        a, b = int(part["a"].iloc[0]), int(part["b"].iloc[0])
        low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, x in enumerate(blocks):
            for y in blocks[n:]:
                if (x.tile, y.tile) == (a, b) and np.sqrt(max(0.0, ((x.center - y.center) ** 2).sum())) <= x.radius + y.radius + chord + 1e-9:
                    for side, found in zip((low, high), meet(x, y)):
                        side.append(found)
        ids = np.concatenate([x.ids for x in blocks])
        least = spanning(np.concatenate(low), np.concatenate(high), base)
        below = np.flatnonzero(least != np.arange(base))
        links = np.concatenate([x.links for x in blocks])
        some = links > 0
        counted = {"node": pd.array(np.concatenate([x.nodes for x in blocks])[some], "Int64"), "id": ids[some], "links": links[some], "other": pd.array([None] * int(some.sum()), "Int64")}
        linked = {"node": pd.array([None] * len(below), "Int64"), "id": ids[below], "links": 0, "other": pd.array(ids[least[below]], "Int64")}
        return pd.concat([pd.DataFrame(counted), pd.DataFrame(linked)])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Vectors (id, vector, label) to id, n_links, component and kept.

    Vectors of equal labels and dimensions with a cosine of at least ``cosine`` in double precision are linked; every
    row counts, so equal vectors link with each other. Vectors that are null, empty or zero or hold null or non-finite
    components, and those with a null label or id, link with nothing and are kept. A repeated id counts each of its
    rows and is one node. An empty table gives an empty result.
    """
    double = F.transform("vector", lambda x: x.cast("double"))
    size = F.array_max(F.transform("v", lambda x: F.abs(x)))
    real = vectors.filter(usable(F.col("vector")) & F.col("id").isNotNull() & F.col("label").isNotNull())
    real = real.select(F.concat_ws(":", F.col("label").cast("string"), F.size("vector").cast("string")).alias("label"), "id", double.alias("v")).filter(size > 0)
    scaled = F.transform("v", lambda x: x / F.col("s"))  # so that no square leaves the range of doubles
    norm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x))
    real = real.withColumn("s", size).select("label", "id", scaled.alias("w")).withColumn("norm", norm)
    real = real.select("label", "id", F.transform("w", lambda x: x / F.col("norm")).alias("unit"))
    real = materialize(real.withColumn("mark", F.sha2(F.array_join("unit", ","), 256)), "units")
    # Each different vector of a label is a node with a number of its own, as ids may be repeated: classes from 0, others below.
    number = F.monotonically_increasing_id()
    classes = real.groupBy("label", "mark").agg(F.min("id").alias("rep"), F.count("*").alias("rows")).filter("rows > 1")
    classes = materialize(classes.withColumn("node", number), "classes")
    member = materialize(real.join(classes, ["label", "mark"]).select("node", "id", "rep", "rows"), "members")
    single = real.join(classes.select("label", "mark"), ["label", "mark"], "left_anti").select("label", (-1 - number).alias("node"), "id", F.lit(1).cast("bigint").alias("rows"), "unit")
    several = real.join(classes, ["label", "mark"]).filter("id = rep").dropDuplicates(["label", "mark"]).select("label", "node", "id", "rows", "unit")
    nodes = materialize(single.union(several).withColumn("cell", F.lit(0).cast("bigint")), "nodes")

    for _ in range(DEPTH):
        big = materialize(nodes.groupBy("label", "cell").agg(F.count("*").alias("n")).filter(F.col("n") > CELL), "big")
        if big.isEmpty():
            break
        some = nodes.join(big, ["label", "cell"]).filter(F.pmod(F.xxhash64("node", "cell"), F.greatest(F.lit(1), F.floor(F.col("n") / PIVOTS))) == 0)
        pivots = materialize(some.groupBy("label", "cell").agg(F.slice(F.collect_list("unit"), 1, 63).alias("pivots")), "pivots")
        nodes = materialize(nodes.join(pivots, ["label", "cell"], "left").mapInArrow(_assign, "label string, node bigint, id bigint, rows bigint, unit array<double>, cell bigint"), "nodes")
        if nodes.groupBy("label", "cell").count().agg(F.max("count")).first()[0] <= CELL or (1 << 57) < (nodes.agg(F.max("cell")).first()[0] or 0):
            break

    cells = materialize(nodes.groupBy("label", "cell").agg(F.ceil(F.count("*") / CELL).alias("cuts")), "cells")
    cut = nodes.join(cells, ["label", "cell"]).withColumn("cut", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("cuts")))
    blocks = materialize(cut.groupBy("label", "cell", "cut").applyInPandas(_pack, BLOCK), "blocks")
    heads = materialize(numbered(blocks.select("label", "cell", "cut", "center", "radius"), "label", [F.col("cell"), F.col("cut")]), "heads")
    pairs = _descended(heads, float(np.sqrt(max(0.0, 2 - 2 * cosine))))
    # A pair of tiles is one task's work; each of its blocks is sent there once.
    each = F.explode(F.array_distinct(F.array("a", "b"))).alias("tile")
    sent = pairs.select("label", "a", "b", each)
    places = heads.select("label", "cell", "cut", "pos", F.floor(F.col("pos") / TILE).alias("tile"))
    load = sent.join(places, ["label", "tile"]).join(blocks, ["label", "cell", "cut"])
    found = load.groupBy("label", "a", "b").applyInPandas(_joined(cosine), "node bigint, id bigint, links bigint, other bigint")
    found = materialize(found, "found")

    count = found.filter("other IS NULL").groupBy("node", "id").agg(F.sum("links").alias("links"))
    links = found.filter("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")).union(member.select("id", "rep"))
    group = components(links)
    each = F.coalesce("links", F.lit(0)) + F.col("rows") - 1
    twins = member.join(count.filter("node >= 0").select("node", "links"), "node", "left").select("id", each.alias("links"))
    own = count.filter("node < 0").select("id", "links").union(twins).groupBy("id").agg(F.sum("links").alias("links"))
    out = vectors.select(F.col("id").cast("bigint").alias("id")).join(own, "id", "left").join(group, "id", "left")
    comp = F.coalesce("component", "id")
    return out.select(
        "id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), comp.alias("component"),
        F.coalesce(comp == F.col("id"), F.lit(True)).alias("kept"),
    )
