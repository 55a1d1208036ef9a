"""Near duplicates by bottom-k sketches: one hash function, inverted lists, union-sketch estimates, exact Jaccard.

A document's sketch is its ``K`` smallest shingle hashes. Of the smallest ``K`` hashes of the union of two documents at
the threshold both have about three quarters, and at least that less ``SLACK`` (five standard deviations) with all but a
chance of a millionth; a set of at most 48 shingles has no such chance, as its sketch is the set. So they meet in a
list even if each document is put only into the lists of its rarest values, and values of common passages are left to
the few documents made of nothing else. Of documents that meet, the estimate from the union of the sketches drops most
of those below the threshold, and the whole sets of the others are compared.

Equal sets are one node, that of one row with the smallest number. Documents that lists join, directly or over others,
are a family. A narrow family is one task's unit; the documents of a wide one are cut into blocks, and a unit is two
blocks that share a list, with the documents that share it. A unit returns a forest of the links and never all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.storage import materialize

from . import hashing, memory
from .graph import components, forest

K, SLACK = 64, 18
#: Documents of a unit, about, and the shingles that count as many.
UNIT, SHINGLES = 2048, 1 << 22


def _sketches(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, mark, low = [], [], []
            for s in hashing.shingle_sets(batch.column("text"), width):
                size.append(len(s))
                mark.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                low.append(s[:k].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("code"), pa.array(size, pa.int64()), pa.array(mark, pa.binary()), pa.array(low, pa.binary())],
                names=["doc_id", "code", "n", "mark", "sketch"],
            )

    return run


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per value of a sketch."""
    for batch in batches:
        n = np.array([len(x) // 8 for x in batch.column(1).to_pylist()], np.int64)
        value = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        for at in range(0, len(value), 200_000):
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), n)[at : at + 200_000]
            yield pa.RecordBatch.from_pydict({"node": pa.array(node, pa.int64()), "value": pa.array(value[at : at + 200_000])})


def shared_of_union(low: np.ndarray, size: np.ndarray, pivot: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a pivot and each other document: how many of the smallest values of their union both have, and how many values those are.

    ``low`` holds a sketch a row, filled up with the largest number; ``size`` says how long each is. The place of a value
    in the union is its place in its own sketch plus the pivot's smaller values less the common smaller ones.
    """
    k, mine = low.shape[1], low[pivot, : size[pivot]]
    rows = low[others]
    before = np.searchsorted(mine, rows)
    own = np.arange(k) < size[others][:, None]
    both = own & (mine[np.minimum(before, len(mine) - 1)] == rows)
    seen = np.cumsum(both, axis=1)
    place = np.arange(k) + before - (seen - both)
    return (both & (place < k)).sum(axis=1), np.minimum(k, size[pivot] + size[others] - seen[:, -1])


def common_of(sets: list[np.ndarray], pivot: int, others: np.ndarray) -> np.ndarray:
    """How many numbers the pivot's whole set shares with each other one."""
    mine, out = sets[pivot], np.empty(len(others), np.int64)
    for at, x in enumerate(others.tolist()):
        small, large = (mine, sets[x]) if len(mine) < len(sets[x]) else (sets[x], mine)
        place = np.searchsorted(large, small)
        out[at] = np.count_nonzero(large[np.minimum(place, len(large) - 1)] == small)
    return out


def linked(docs: np.ndarray, known: np.ndarray, sets: list[np.ndarray], lists: list[np.ndarray], k: int, percent: int) -> tuple[list[int], list[int]]:
    """Links of documents that share a list, as a forest.

    Sizes filter first, then the estimate from the sketch of the union, then whole sets decide. Documents already in one
    group (by ``known`` or by links found so far) are not compared again, so a group of near copies takes a few pivots.
    """
    m = len(docs)
    n = np.array([len(x) for x in sets])
    meet = np.zeros((m, m), bool)
    owner, value = np.repeat(np.arange(m), [len(x) for x in lists]), np.concatenate(lists)
    order = np.argsort(value, kind="stable")
    for group in np.split(owner[order], np.flatnonzero(np.diff(value[order])) + 1):
        if len(group) > 1:
            meet[np.ix_(group, group)] = True
    meet &= 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
    size = np.minimum(n, k)
    low = np.full((m, k), np.iinfo(np.uint64).max, np.uint64)
    for row, s in zip(low, sets):
        row[: min(k, len(s))] = s[:k]
    group = np.unique(known, return_inverse=True)[1]
    a, b = [], []
    for pivot in range(m):
        others = pivot + 1 + np.flatnonzero(meet[pivot, pivot + 1 :] & (group[pivot + 1 :] != group[pivot]))
        if len(others):
            both, of = shared_of_union(low, size, pivot, others)
            others = others[both >= needed(of, k, percent)]
        if len(others):
            both = common_of(sets, pivot, others)
            others = others[100 * both >= percent * (n[pivot] + n[others] - both)]
            a += [int(docs[pivot])] * len(others)
            b += docs[others].tolist()
            group[np.isin(group, group[others])] = group[pivot]
    return forest(a, b)


def needed(length: np.ndarray, k: int, percent: int) -> np.ndarray:
    """Values of so many that two documents at the threshold share, but for a chance of a millionth."""
    whole = -(-length * percent // 100)
    return np.maximum(1, whole - np.where(length > k * percent // 100, SLACK, 0))


def _units(k: int, width: int, percent: int):
    """Links of every unit; rows (x, i, j, node, doc_id, comp, text, lists) come sorted by unit and node.

    A node comes once for every row that repeats its doc_id and text, and is taken once.
    """

    def links(docs: list, known: list, sets: list, lists: list) -> Iterator[pa.RecordBatch]:
        if len(docs) > 1:
            a, b = linked(np.array(docs), np.array(known), sets, lists, k, percent)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, docs, known, sets, lists = None, None, [], [], [], []
        for batch in batches:
            unit = zip(*(batch.column(c).to_pylist() for c in ("x", "i", "j")))
            rows = zip(unit, *(batch.column(c).to_pylist() for c in ("node", "doc_id", "comp", "lists")), hashing.shingle_sets(batch.column("text"), width))
            for unit, node, doc, comp, values, s in rows:
                if (unit, node) == last and np.array_equal(s, sets[-1]):
                    continue
                last = unit, node
                if unit != key:
                    yield from links(docs, known, sets, lists)
                    key, docs, known, sets, lists = unit, [], [], [], []
                docs.append(doc)
                known.append(comp)
                sets.append(s)
                lists.append(np.array(values, np.int64))
        yield from links(docs, known, sets, lists)

    return run


def _blocks(met: DataFrame, weights: DataFrame) -> DataFrame:
    """Blocks (x, node, own) of the documents of wide families, of about ``UNIT`` / 4 each.

    A document's home is the longest of its lists. Documents of a long home are dealt to blocks of their own, those of
    short homes go home by home to common blocks, so that what shares lists is mostly in one block.
    """
    home = met.groupBy("x", "node").agg(F.max_by("value", F.struct("rows", "value")).alias("home")).join(weights, "node")
    home = materialize(home, "homes")
    long_ = F.col("held") > UNIT // 32
    held = home.groupBy("x", "home").agg(F.sum("weight").alias("held"))
    short = held.filter(~long_).groupBy("x").agg(F.sum("held").alias("short"))
    cuts = lambda c: F.ceil(4 * F.col(c) / UNIT)
    own = F.when(long_, F.xxhash64("home", F.pmod(F.xxhash64("node"), cuts("held"))))
    own = F.coalesce(own, F.pmod(F.xxhash64("home"), cuts("short")))
    return home.join(held, ["x", "home"]).join(short, "x", "left").select("x", "node", own.alias("own"))


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("i"), F.greatest(a, b).alias("j")]


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, k: int = K) -> DataFrame:
    """Documents (doc_id, text) to doc_id, n_shingles, component_id and kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; a text of fewer words than ``width`` is one shingle. A null,
    empty or blank text has no shingle and is linked with nothing. A row with a null doc_id is linked with nothing and
    kept, its component is null. A repeated doc_id is one node with the links of all its rows. An empty table gives an
    empty result. Other columns are left out.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("code"))
    sets = docs.mapInArrow(memory.over_batches(_sketches(k, width)), "doc_id bigint, code bigint, n bigint, mark binary, sketch binary")
    sets = materialize(sets.withColumn("node", F.monotonically_increasing_id()), "sketches")
    full = sets.filter("n > 0 AND doc_id IS NOT NULL")
    first = full.groupBy("mark").agg(F.min("doc_id").alias("rep"), F.min_by("node", "doc_id").alias("one"), F.count("*").alias("rows"))
    first = materialize(first.filter("rows > 1").drop("rows"), "classes")
    copies = materialize(full.select("doc_id", "node", "mark").join(first, "mark").filter("node <> one").select("node", "doc_id", "rep"), "copies")
    # A node is one row of each class, not all rows of a doc_id: a doc_id that is a copy in one row may stand for others.
    nodes = full.join(copies.select("node"), "node", "left_anti").select("node", "doc_id", "code", "n", "sketch")

    # Lists of the rarest values of each sketch.
    values = nodes.select("node", "sketch").mapInArrow(memory.over_batches(_values), "node bigint, value bigint")
    common = materialize(values.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1"), "values")
    held = values.join(common, "value").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("held"))
    length = F.least(F.col("n"), F.lit(k)).cast("int")
    table = F.array(*[F.lit(int(x)) for x in needed(np.arange(k + 1), k, percent)])
    need = F.element_at(table, length + 1)
    sized = held.join(nodes.select("node", "doc_id", "code", "n"), "node")
    chosen = F.slice("held", F.lit(1), F.greatest(F.lit(0), length - need + 1 - (length - F.size("held"))))
    members = materialize(sized.select("node", "doc_id", "code", "n", F.transform(chosen, lambda x: x["value"]).alias("lists")).filter(F.size("lists") > 0), "members")
    slim = materialize(members.select("node", F.explode("lists").alias("value")), "lists")

    # Families: documents joined by lists, directly or over others. A narrow one is a unit, so that a text travels once
    # and not once a list; the documents of a wide one are cut into blocks, and two blocks with a common list are a unit.
    size = materialize(slim.groupBy("value").agg(F.count("*").alias("rows"), F.min("node").alias("least")).filter("rows > 1"), "sizes")
    met = slim.join(size, "value")
    family = components(met.select(F.col("node").alias("a"), F.col("least").alias("b")))
    family = family.select(F.col("id").alias("node"), F.col("component").alias("x"))
    met = materialize(met.join(family, "node", "left").withColumn("x", F.coalesce("x", "node")), "met")
    weights = members.select("node", (1 + F.floor(F.col("n") * UNIT / SHINGLES)).alias("weight"))
    own = weights.join(family, "node", "left").groupBy(F.coalesce("x", "node").alias("x")).agg(F.sum("weight").alias("held"))
    wide = materialize(own.filter(F.col("held") > UNIT // 2).select("x"), "wide")
    texts = docs.join(members.select("node", "doc_id", "code"), ["doc_id", "code"]).select("node", "doc_id", "text")
    texts = materialize(texts, "texts")

    def compared(met: DataFrame, texts: DataFrame) -> DataFrame:
        units = materialize(met.groupBy("x", "i", "j", "node").agg(F.collect_set("value").alias("lists")), "units")
        rows = units.join(texts, "node").repartition("x", "i", "j").sortWithinPartitions("x", "i", "j", "node")
        return materialize(rows.mapInArrow(memory.over_batches(_units(k, width, percent)), "a bigint, b bigint"), "found")

    zero, columns = F.lit(0).cast("bigint"), ["node", "value", "x"]
    links = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    todo = met.join(wide, "x", "left_anti").select(*columns, zero.alias("i"), zero.alias("j"))
    texts = texts.withColumn("comp", F.col("doc_id"))
    if wide.isEmpty():
        group = components(links.union(compared(todo, texts)))
    else:
        # Each block meets itself and, list by list, the block of the list's least document: a group of near copies is
        # then one component. Other pairs of blocks meet only for lists whose documents are not yet in one component.
        met = met.join(wide, "x")
        blocks = materialize(_blocks(met, weights), "blocks")
        lead = blocks.select("x", F.col("node").alias("least"), F.col("own").alias("lead"))
        met = materialize(met.join(blocks, ["x", "node"]).join(lead, ["x", "least"]).select(*columns, "own", "lead"), "wide_lists")
        held = met.select("value", F.col("own").alias("other"), "lead").distinct()
        todo = todo.union(met.select(*columns, *_pair("own", "own"))).union(met.filter("own <> lead").select(*columns, *_pair("own", "lead")))
        first = met.filter("own = lead").drop("lead").join(held.filter("other <> lead").drop("lead"), "value")
        group = components(links.union(compared(todo.union(first.select(*columns, *_pair("own", "other"))), texts)))
        comp = F.coalesce("component", "doc_id")
        known = texts.drop("comp").join(group.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("node", "doc_id", "text", comp.alias("comp"))
        placed = materialize(met.filter("own <> lead").join(known.select("node", "comp").distinct(), "node"), "placed")
        held = placed.groupBy("value", F.col("own").alias("other")).agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        open_ = held.groupBy("value").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high").select("value")
        rest = placed.join(open_, "value").join(held, "value").filter("other <> own AND (low <> comp OR high <> comp)")
        # The other side must send what it has of other components, so a document goes where its partners go.
        found = compared(rest.select(*columns, *_pair("own", "other")), known)
        group = components(links.union(group.select(F.col("id").alias("a"), F.col("component").alias("b"))).union(found))
    out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(group.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    comp = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))
