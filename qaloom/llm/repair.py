"""Repair of conversation structure: the cheapest edits by dynamic programming, ties by prefix-doubling path ranking.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Edits keep a row, change its role, delete it or
insert an empty one, and each leads from one of four states (nothing yet, after s, u or a) to one other. The cost DP
gives every node (row, state) its least cost to the end; arcs on which that is kept are optimal. Then nodes are ranked by
the least audit (the letters of the edits) of 1, 2, 4, ... steps that optimal arcs spell from them: the rank for twice
the length is the rank of the pair (own rank, rank of the node that the doubled pointer reaches). A node's arcs bear
different letters, so the least audit of each length is one path and one pointer a node is enough. The ranks of the last
doubling choose the arc of every node, and the pointers lead to the end.

No conversation is gathered in one task for this. Rows get places by a distributed sort; ``BLOCK`` rows are a block. A
block of a long conversation is a 4 x 4 min-plus matrix of its costs; matrices of ``BLOCK`` blocks are multiplied to the
next level's, and on the way back every block gets the costs of what follows it. Likewise a block's ranked paths are a
map from its first state to its last; maps are composed upwards and every block gets the state that it starts with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.storage import materialize

from . import memory
from .ordered import numbered

BLOCK = 1024
KEEP, ROLE, DELETE, INSERT, BROKEN = 0, 1, 2, 5, 5
FAR = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a changed or inserted row leads from each state, and the role it takes.
TURN = [USER, USER, ASSISTANT, USER]
NAME = {USER: "user", ASSISTANT: "assistant"}
#: Where a kept row leads, by state and initial.
STAY = {(START, "s"): SYSTEM, **{(x, "u"): USER for x in (START, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
END = [0, FAR, FAR, 0]
WHITE = " \t\n\x0b\x0c\r"
#: Letters of edits in the order of their bytes.
LETTERS = "DIKR"


def _space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with planted faults, by the CRC-32 of ``conv:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats it, 4 makes its role user. A null counts as
    one space in the number, the role and the text.
    """
    kind = F.crc32(F.concat(_space("conv"), F.lit(":"), _space("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(_space("text"), "[.!?]", "")).otherwise(_space("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(_space("role"))
    times = F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))).drop("col")


def _group(conv: Column) -> Column:
    """A conversation's name as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _blocks(batches: Iterator[pa.RecordBatch], keys: int, per: int = 64) -> Iterator[list[tuple[tuple, list[list]]]]:
    """Some blocks at a time: runs of rows alike in the first ``keys`` columns, as (key, columns), across batches."""
    key, columns, out, rows = None, [], [], 0
    for batch in batches:
        values = [c.to_pylist() for c in batch.columns]
        heads = list(zip(*values[:keys]))
        at = 0
        while at < len(heads):
            end = at + 1
            while end < len(heads) and heads[end] == heads[at]:
                end += 1
            if heads[at] == key:
                for have, more in zip(columns, values[keys:]):
                    have += more[at:end]
            else:
                if key is not None:
                    out.append((key, columns))
                    if rows > per * BLOCK:
                        yield out
                        out, rows = [], 0
                key, columns = heads[at], [more[at:end] for more in values[keys:]]
            rows += end - at
            at = end
    if key is not None:
        yield [*out, (key, columns)]


def _sorted_blocks(df: DataFrame, keys: list[str], order: str, run: Callable, schema: str) -> DataFrame:
    """The rows that ``run`` makes of lists of blocks; a block is in one task, its rows in order."""
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    arrow = {"string": pa.string(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _blocks(batches, len(keys)):
            yield pa.RecordBatch.from_arrays([pa.array(x, arrow[k]) for x, k in zip(zip(*run(some)), kinds)], names=names)

    rest = [c for c in df.columns if c not in keys]
    dealt = df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys, order)
    return dealt.mapInArrow(memory.over_batches(over), schema)


def _steps(initial: str, drop: bool, broken: bool) -> list[tuple[int, str, int, int]]:
    """(from, letter, to, cost) of the edits of a row."""
    steps = [(x, "D", x, DELETE) for x in range(4)]
    if not drop:
        extra = BROKEN if broken else 0
        for x in range(4):
            if (x, initial) in STAY:
                steps.append((x, "K", STAY[x, initial], KEEP + extra))
            steps.append((x, "R", TURN[x], ROLE + extra))
    return steps


_known: dict[tuple, list] = {}


def steps(initial: str, drop: bool, broken: bool) -> list[tuple[int, str, int, int]]:
    key = (initial if initial in ("s", "u", "a") else "", drop, broken)
    if key not in _known:
        _known[key] = _steps(*key)
    return _known[key]


def inserted(cost: list[int]) -> list[int]:
    """The least costs before a row if rows may be inserted; two in a row are the most that ever pays."""
    cost = [min(c, INSERT + cost[TURN[x]]) for x, c in enumerate(cost)]
    return [min(c, INSERT + cost[TURN[x]]) for x, c in enumerate(cost)]


def costs(initials: list[str], drops: list[bool], brokens: list[bool], after: list[int], last: bool) -> list[list[int]]:
    """Least costs to the end from every state before each row of a block, and after its last one."""
    out = [inserted(after) if last else after]
    for row in zip(reversed(initials), reversed(drops), reversed(brokens)):
        below, now = out[-1], [FAR] * 4
        for x, _, y, c in steps(*row):
            if c + below[y] < now[x]:
                now[x] = c + below[y]
        out.append(inserted(now))
    return out[::-1]


def ranked(letter: np.ndarray, target: np.ndarray, node: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix doubling over optimal arcs (node, letter, target), sorted by node and letter, letters differing in a node.

    Gives the rank of each node's least audit and the arc that it takes, -1 for nodes without arcs. A path's end spells
    nothing and comes before all letters.
    """
    rank, pointer = np.zeros(nodes, np.int64), np.arange(nodes)
    first = np.ones(len(node), bool)
    first[1:] = node[1:] != node[:-1]
    rank[node[first]] = letter[first] + 1
    pointer[node[first]] = target[first]
    while True:
        _, wider = np.unique(rank * (rank.max(initial=0) + 1) + rank[pointer], return_inverse=True)
        further = pointer[pointer]
        done = np.array_equal(further, pointer)
        rank, pointer = wider, further
        if done:
            break
    order = np.lexsort((rank[target], letter, node))
    best = np.full(nodes, -1)
    lead = np.ones(len(order), bool)
    lead[1:] = node[order][1:] != node[order][:-1]
    best[node[order][lead]] = order[lead]
    return pointer, best


Block = tuple[list[str], list[bool], list[bool], list[int], bool]


def optimal(some: list[Block]) -> tuple[list[int], list[int], list[str], list[int], np.ndarray, list[list[int]]]:
    """The ranked graph of some blocks (initials, drops, brokens, costs after, last).

    Gives the first node of each, the taken arc of every node (-1: none), letters and targets of the arcs, the end that
    each node's doubled pointer reaches, and the costs from each block's four first states.
    """
    nodes, letters, targets, bases, first, at = [], [], [], [], [], 0
    for initials, drops, brokens, after, last in some:
        togo = costs(initials, drops, brokens, after, last)
        for i, row in enumerate([*zip(initials, drops, brokens), None]):
            now, arcs = togo[i], []
            if row is not None:
                arcs = [(x, letter, (i + 1) * 4 + y) for x, letter, y, c in steps(*row) if c + togo[i + 1][y] == now[x]]
            if row is not None or last:
                arcs += [(x, "I", i * 4 + TURN[x]) for x in range(4) if INSERT + now[TURN[x]] == now[x]]
            for x, letter, y in sorted(arcs):
                nodes.append(at + i * 4 + x)
                letters.append(letter)
                targets.append(at + y)
        bases.append(at)
        first.append(togo[0])
        at += 4 * (len(initials) + 1)
    code = np.array([LETTERS.index(x) for x in letters], np.int64)
    pointer, best = ranked(code, np.array(targets, np.int64), np.array(nodes, np.int64), at)
    return bases, best.tolist(), letters, targets, pointer, first


def least_audit(base: int, state: int, arc: list[int], letters: list[str], targets: list[int]) -> str:
    path, here = [], base + state
    while arc[here] >= 0:
        path.append(letters[arc[here]])
        here = targets[arc[here]]
    return "".join(path)


def matrix(initials: list[str], drops: list[bool], brokens: list[bool], last: bool) -> list[int]:
    """Costs from each state before a block to each after it, row by row."""
    columns = [costs(initials, drops, brokens, [0 if x == y else FAR for x in range(4)], last)[0] for y in range(4)]
    return [min(FAR, columns[y][x]) for x in range(4) for y in range(4)]


def times(a: list[int], b: list[int]) -> list[int]:
    """The min-plus product of two matrices."""
    return [min(FAR, min(a[4 * x + z] + b[4 * z + y] for z in range(4))) for x in range(4) for y in range(4)]


def onto(a: list[int], after: list[int]) -> list[int]:
    return [min(FAR, min(a[4 * x + y] + after[y] for y in range(4))) for x in range(4)]


def _matrices(some) -> list[tuple]:
    return [(conv, block, matrix(initial, drop, broken, last[0])) for (conv, block), (_, initial, drop, broken, last) in some]


def _maps(some) -> list[tuple]:
    """Where the least audits lead from each first state of a block."""
    bases, _, _, _, pointer, _ = optimal([(initial, drop, broken, after[0], last[0]) for _, (_, initial, drop, broken, last, after, _) in some])
    return [(*key, [int(pointer[base + x] - base) % 4 for x in range(4)]) for (key, _), base in zip(some, bases)]


def _audits(some) -> list[tuple]:
    """The audit of every block and, with the first block, the cost of the whole conversation."""
    bases, arc, letters, targets, _, first = optimal([(initial, drop, broken, after[0] or END, last[0]) for _, (_, initial, drop, broken, last, after, _) in some])
    out = []
    for (key, columns), base, togo in zip(some, bases, first):
        state = columns[-1][0] or [START]
        out.append((*key, least_audit(base, state[0], arc, letters, targets), togo[START] if key[1] == 0 else 0))
    return out


def _product(values: list[list[int]]) -> list[int]:
    out = values[0]
    for value in values[1:]:
        out = times(out, value)
    return out


def _followed(values: list[list[int]], after: list[int]) -> list[list[int]]:
    """The costs after each of some matrices."""
    out = [after]
    for value in reversed(values[1:]):
        out.append(onto(value, out[-1]))
    return out[::-1]


def _composed(values: list[list[int]]) -> list[int]:
    out = values[0]
    for value in values[1:]:
        out = [value[x] for x in out]
    return out


def _preceded(values: list[list[int]], start: list[int]) -> list[list[int]]:
    """The state before each of some maps."""
    out = [start]
    for value in values[:-1]:
        out.append([value[out[-1][0]]])
    return out


def _through(level: DataFrame, combine: Callable, hand: Callable, given: list[int]) -> DataFrame:
    """(conv, block, given): values of blocks combined level by level, then what each gets from those beside it."""
    up = F.floor(F.col("block") / BLOCK).alias("up")

    def climb(some) -> list[tuple]:
        return [(*key, combine(values)) for key, (_, values) in some]

    def descend(some) -> list[tuple]:
        return [(key[0], b, g) for key, (blocks, values, above) in some for b, g in zip(blocks, hand(values, above[0]))]

    levels = [level]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        higher = _sorted_blocks(levels[-1].select("conv", up, "block", "value"), ["conv", "up"], "block", climb, "conv string, up bigint, value array<bigint>")
        levels.append(materialize(higher.withColumnRenamed("up", "block"), "level"))
    out = levels[-1].select("conv", "block", F.array(*[F.lit(x).cast("bigint") for x in given]).alias("given"))
    for lower in reversed(levels[:-1]):
        both = lower.select("conv", up, "block", "value").join(out.withColumnRenamed("block", "up"), ["conv", "up"])
        out = materialize(_sorted_blocks(both, ["conv", "up"], "block", descend, "conv string, block bigint, given array<bigint>"), "given")
    return out


def placed(rows: DataFrame) -> DataFrame:
    """Rows of conversations in their order, without texts: conv, pos, total, turn, role, digest, initial and the first fault.

    Rows come by turn, null first, then by role and digest of the text, so repeated rows are side by side. Of the flags
    blank, duplicate (role and text came before) and truncated at most one is true.
    """
    last = F.substring(F.rtrim(_space("text"), F.lit(WHITE)), -1, 1)
    plain = rows.select(
        _group(F.col("conv")).alias("conv"), "turn", _space("role").alias("role"), F.sha2(_space("text"), 256).alias("digest"),
        F.substring(_space("role"), 1, 1).alias("initial"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("broken"),
    )
    order = [F.col("turn"), F.col("role"), F.col("digest")]
    out = materialize(numbered(materialize(plain, "turns"), "conv", order), "placed")
    new = out.groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos")).select("conv", "pos", F.lit(True).alias("new"))
    out = out.join(new, ["conv", "pos"], "left")
    again = F.col("new").isNull() & ~F.col("blank")
    flags = {"duplicate": again, "truncated": F.col("broken") & ~F.col("blank") & ~again}
    return materialize(out.withColumns(flags).drop("new", "broken"), "faults")


def faults(rows: DataFrame) -> DataFrame:
    """Counts of a conversation's faults from ``placed``: gaps, blank, duplicate, truncated and illegal neighbours."""
    count = lambda c: F.count_if(F.col(c)).alias(c)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps")
    # The first row of a block is also shown to the block before it, so each pair of neighbours is in one block.
    block = F.floor(F.col("pos") / BLOCK)
    edge = (F.col("pos") % BLOCK == 0) & (F.col("pos") > 0)
    shown = rows.select("conv", "pos", "initial", F.explode(F.when(edge, F.array(block - 1, block)).otherwise(F.array(block))).alias("block"))
    before = F.lag("initial").over(Window.partitionBy("conv", "block").orderBy("pos"))
    pairs = shown.select("conv", F.concat(before, "initial").alias("pair")).filter("pair IS NOT NULL")
    illegal = pairs.groupBy("conv").agg(F.count_if(~F.col("pair").isin("su", "ua", "au")).alias("illegal"))
    return rows.groupBy("conv").agg(gaps, count("blank"), count("duplicate"), count("truncated")).join(illegal, "conv", "left").fillna(0, ["illegal"])


def plan(rows: DataFrame) -> DataFrame:
    """The least audit of every block (conv, block, audit, cost); the first block has the conversation's cost."""
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    last = (F.floor(F.col("pos") / BLOCK) == F.floor((F.col("total") - 1) / BLOCK)).alias("last")
    base = rows.select("conv", block, "pos", "initial", (F.col("blank") | F.col("duplicate")).alias("drop"), F.col("truncated").alias("broken"), last, "total")
    long = base.filter(F.col("total") > BLOCK).drop("total")
    given = None
    if not long.isEmpty():
        value = "conv string, block bigint, value array<bigint>"
        level = materialize(_sorted_blocks(long, ["conv", "block"], "pos", _matrices, value), "matrices")
        after = _through(level, _product, _followed, END).withColumnRenamed("given", "after")
        long = long.join(after, ["conv", "block"]).withColumn("start", F.lit(None).cast("array<bigint>"))
        level = materialize(_sorted_blocks(long, ["conv", "block"], "pos", _maps, value), "maps")
        given = after.join(_through(level, _composed, _preceded, [START]).withColumnRenamed("given", "start"), ["conv", "block"])
    if given is None:
        none = F.lit(None).cast("array<bigint>")
        base = base.drop("total").withColumns({"after": none, "start": none})
    else:
        base = base.drop("total").join(materialize(given, "given"), ["conv", "block"], "left")
    out = _sorted_blocks(base, ["conv", "block"], "pos", _audits, "conv string, block bigint, audit string, cost bigint")
    return materialize(out, "audits")


class Rewrite:
    """Applies an audit to the rows of one conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        """The rows that are inserted here."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = TURN[self.state]
            self.at += 1
            yield "I", NAME[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = STAY[self.state, role[:1]]
            yield "K", role, text
        elif letter == "R":
            self.state = TURN[self.state]
            yield "R", NAME[self.state], text


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, Iterator[tuple[str, str, str]]]]:
    """(conversation, audit, repaired rows) of records sorted by conversation, audits before rows; rows must be used up."""
    def records() -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield from batch.slice(at, 64).to_pylist()

    def edited(audit: str, group: Iterator[dict]) -> Iterator[tuple[str, str, str]]:
        rewriter = Rewrite(audit)
        for r in group:
            yield from rewriter.row(r["role"], r["text"])
        yield from rewriter.inserts()

    for conv, group in groupby(records(), key=lambda r: r["conv"]):
        parts, head = [], None
        for head in group:
            if head["kind"]:
                break
            parts.append(head["text"])
        audit = "".join(parts)
        yield conv, audit, edited(audit, chain([head] if head["kind"] else [], group))


def _rewritten(rows: DataFrame, audits: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` of the stream of each task: audits and rows of a conversation meet once, sorted as for their places."""
    text = _space("text")
    own = rows.select(
        _group(F.col("conv")).alias("conv"), F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("block"), "turn",
        _space("role").alias("role"), F.sha2(text, 256).alias("digest"), text.alias("text"),
    )
    told = audits.select("conv", F.lit(0).alias("kind"), "block", F.lit(None).cast(own.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), F.col("audit").alias("text"))
    order = ["conv", "kind", "block", "turn", "role", "digest"]
    dealt = told.union(own).repartition("conv").sortWithinPartitions(*order)
    return dealt.select("conv", "kind", "role", "text").mapInArrow(memory.over_batches(run), schema)


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: conv, place (from 0), edit (K, R or I), role and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "place", "edit", "role", "text"]
        for conv, _, edits in _stream(batches):
            numbers = enumerate(edits)
            while part := [(conv, n, *e) for n, e in islice(numbers, 256)]:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*part)], names=names)

    out = _rewritten(rows, audits, run, "conv string, place bigint, edit string, role string, text string")
    kind = rows.schema["conv"].dataType
    return out.withColumn("conv", F.when(F.col("conv") != "", F.expr("substring(conv, 2)").cast(kind)))


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256): SHA-256 of the repaired rows ``role:text``, newlines between them.

    A hash of a sequence can only be taken in its order, so a conversation is one task's stream here, of one row at a
    time; its audit is the only value that grows with it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, audit, edits in _stream(batches):
            hasher = sha256()
            for n, (_, role, text) in enumerate(edits):
                hasher.update(f"{chr(10) if n else ''}{role}:{text}".encode())
            out.append((conv, audit, hasher.hexdigest()))
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["conv", "audit", "repaired_sha256"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["conv", "audit", "repaired_sha256"])

    return _rewritten(rows, audits, run, "conv string, audit string, repaired_sha256 string")


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per ``conv`` of ``conversations``: faults, least cost, audit and the digest of the repaired rows.

    ``rows`` are conv, turn, role and text. Null roles and texts are one space; a null conversation is one like others;
    null turns come first and count in no gap. A conversation without rows has zeros, an empty audit and the digest of
    the empty text; empty tables give empty results. Other columns are not looked at.
    """
    order = placed(rows)
    audits = plan(order)
    cost = audits.groupBy("conv").agg(F.sum("cost").alias("cost"))
    per = faults(order).join(cost, "conv").join(digests(rows, audits), "conv")
    all_ = conversations.select(F.col("conv").alias("conv_id"), _group(F.col("conv")).alias("conv")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = {"audit": "", "repaired_sha256": sha256(b"").hexdigest()}
    return all_.join(per, "conv", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts], *[F.coalesce(c, F.lit(x)).alias(c) for c, x in empty.items()]
    )
