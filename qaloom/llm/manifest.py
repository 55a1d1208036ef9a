"""Merkle manifest of a dataset by time-forward processing.

Nodes of a tree are labelled by (level, place), so a node comes after its children. Children send their digests forward
to the label of their parent; a priority queue ordered by label hands a node all that was sent to it. The queue is
external: digests that leave a block of ``run ** height`` consecutive nodes are written to the shared folder as the next
round's queue, and are read sorted by label; inside a block it is a heap of at most the block's nodes. Then the sweep is
reversed: from the last label to the first each node delivers the proof suffix (the siblings from its level up to the
root) to its children, prefixed by their own siblings, and blocks hand theirs to the blocks below.

A tree of n leaves takes log(n) / log(block) rounds each way, whatever the number of groups. No task holds more than a
block and no row more than one path; a group with a third of all rows is as many blocks as its size asks for.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.storage import materialize

from .ordered import numbered

#: A block is run ** height nodes; 512 nodes in runs of two.
BLOCK = 512
HEX = 64


def field(value: Column) -> Column:
    """``-`` if null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of a row: H of its fields."""
    return F.sha2(F.concat(*map(field, values)), 256)


def h(parts) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(run: int) -> int:
    """Levels of a block."""
    levels = 0
    while run ** (levels + 1) <= BLOCK:
        levels += 1
    return max(1, levels)


def levels_up(total: int, run: int, most: int) -> int:
    """Levels that a block climbs: ``most``, or fewer if its tree ends before."""
    levels = 0
    while total > 1 and levels < most:
        total = -(-total // run)
        levels += 1
    return levels


def sweep(digests: list[str], run: int, levels: int) -> dict[tuple[int, int], list[str]]:
    """Forward: what every inner node of a block receives, by label; its own digest is H of that."""
    queue = [(1, i // run, i, d) for i, d in enumerate(digests)] if levels else []
    got: dict[tuple[int, int], list[str]] = {}
    while queue:
        level, at, _, digest = heapq.heappop(queue)
        got.setdefault((level, at), []).append(digest)
        if not queue or queue[0][:2] != (level, at):  # all messages to this node have come
            if level < levels:
                heapq.heappush(queue, (level + 1, at // run, at, h(got[level, at])))
    return got


def reversed_sweep(got: dict[tuple[int, int], list[str]], run: int, levels: int, suffix: str, n: int) -> list[str]:
    """Backward: the siblings from each leaf of a block up to the root, left to right and level by level."""
    out = [suffix] * n
    queue = [(-levels, 0, suffix)] if levels else []
    while queue:
        level, at, above = heapq.heappop(queue)
        below = got[-level, -at]
        for i, _ in enumerate(below):
            path = "".join(below[:i] + below[i + 1 :]) + above
            if level == -1:
                out[-at * run + i] = path
            else:
                heapq.heappush(queue, (level + 1, at * run - i, path))
    return out


def fold(digest: str, pos: int, total: int, proof: str, run: int) -> tuple[str, str]:
    """The root that a leaf and its siblings give in one tree, and the siblings that are left for the tree above."""
    at = 0
    while total > 1:
        first = pos - pos % run
        others = min(run, total - first) - 1
        own = at + (pos - first) * HEX
        end = at + others * HEX
        digest = sha256((proof[at:own] + digest + proof[own:end]).encode()).hexdigest()
        at, pos, total = end, pos // run, -(-total // run)
    return digest, proof[at:]


def _up(nodes: DataFrame, run: int) -> DataFrame:
    """The next round's queue: one node a block."""
    most = height(run)

    def block(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        total = int(part["total"].iloc[0])
        levels = levels_up(total, run, most)
        got = sweep(part["digest"].tolist(), run, levels)
        return pd.DataFrame({
            "tree": [part["tree"].iloc[0]], "pos": [int(part["pos"].iloc[0]) // run**most],
            "total": [-(-total // run**most)], "digest": [h(got[levels, 0])],
        })

    blocks = nodes.filter("total > 1").withColumn("block", F.floor(F.col("pos") / run**most))
    return blocks.groupBy("tree", "block").applyInPandas(block, "tree string, pos bigint, total bigint, digest string")


def _down(nodes: DataFrame, above: DataFrame, run: int, finish, schema: str) -> DataFrame:
    """``finish`` of a round's nodes, block by block, with their proofs from that of the block above and its note."""
    most = height(run)

    def block(part: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        levels = levels_up(int(part["total"].iloc[0]), run, most)
        part["proof"] = reversed_sweep(sweep(part["digest"].tolist(), run, levels), run, levels, top["proof"].iloc[0], len(part))
        return finish(part, top["note"].iloc[0])

    blocks = nodes.withColumn("block", F.floor(F.col("pos") / run**most))
    above = above.select(F.col("tree").alias("of"), F.col("pos").alias("at"), "proof", "note")
    return blocks.groupBy("tree", "block").cogroup(above.groupBy("of", "at")).applyInPandas(block, schema)


def forest(leaves: DataFrame, run: int = 2) -> tuple[list[DataFrame], DataFrame]:
    """Queues (tree, pos, total, digest) of all rounds, the leaves first, and the roots (tree, digest)."""
    queues = [leaves]
    roots = leaves.filter("total = 1").select("tree", "pos", "total", "digest")
    while (queues[-1].agg(F.max("total")).first()[0] or 0) > 1:
        queues.append(materialize(_up(queues[-1], run), "queue"))
        roots = roots.union(queues[-1].filter("total = 1"))
    return queues, roots.select("tree", "digest")


def _message(part: pd.DataFrame, note: str) -> pd.DataFrame:
    return part[["tree", "pos", "proof"]].assign(note=note)


MESSAGE = "tree string, pos bigint, proof string, note string"


def proofs(queues: list[DataFrame], roots: DataFrame, run: int = 2, finish=_message, schema: str = MESSAGE) -> DataFrame:
    """``finish`` of all leaves with their proofs; ``roots`` (tree, proof, note) holds what follows above each root."""
    out = None
    for n, queue in reversed(list(enumerate(queues))):
        ends = queue.filter("total = 1").select("tree", "pos").join(roots, "tree")
        above = ends if out is None else out.union(ends)
        out = materialize(_down(queue, above, run, _message, MESSAGE), "proofs") if n else _down(queue, above, run, finish, schema)
    return out


def root_message(top: DataFrame) -> DataFrame:
    """What the root of the last tree starts the reversed sweep with: nothing follows above it."""
    return top.select("tree", F.lit("").alias("proof"), F.lit("").alias("note")).distinct()


def manifest(rows: DataFrame, order: Column, group: Column, digest: Column, check: Column, run: int = 2) -> DataFrame:
    """One row per row of ``rows``: id, leaf, subroot, root, proof, folded_root and verified.

    ``digest`` is a row's leaf and ``check`` the digest that is verified against the manifest. Leaves of a group ascend by
    ``order``, null first; repeated ids come by leaf, so equal rows are equal leaves side by side. While a level has
    several nodes, every ``run`` consecutive ones become their H, the last fewer. The roots of the groups, null first and
    then bytewise, are the leaves of one more tree. A proof is the text of all siblings up to the root. An empty table
    gives an empty result. Columns of ``rows`` may have any names.
    """
    tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    leaves = rows.select(order.alias("id"), tree.alias("tree"), digest.alias("digest"), check.alias("check"))
    leaves = leaves.withColumn("check", F.when(F.col("check") != F.col("digest"), F.col("check")))
    leaves = materialize(numbered(materialize(leaves, "digests"), "tree", [F.col("id"), F.col("digest")]), "leaves")
    queues, subroots = forest(leaves, run)
    top = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    top = materialize(numbered(materialize(top, "subroots"), "tree", [F.col("of")]), "top")
    top_queues, root = forest(top, run)
    root = root.first()
    above = proofs(top_queues, root_message(top), run).select("pos", "proof")
    note = F.concat_ws(":", F.col("digest"), F.col("pos"), F.col("total")).alias("note")
    above = materialize(top.join(above, "pos").select(F.col("of").alias("tree"), "proof", note), "above")

    def verify(part: pd.DataFrame, note: str) -> pd.DataFrame:
        subroot, top_pos, top_total = note.split(":")
        folded = []
        for leaf, check, pos, total, proof in zip(part["digest"], part["check"], part["pos"], part["total"], part["proof"]):
            digest, proof = fold(check or leaf, pos, total, proof, run)
            folded.append(fold(digest, int(top_pos), int(top_total), proof, run)[0])
        return part[["id", "digest", "proof"]].assign(subroot=subroot, folded_root=folded)

    schema = f"id {leaves.schema['id'].dataType.simpleString()}, digest string, proof string, subroot string, folded_root string"
    out = proofs(queues, above, run, verify, schema)
    known = F.lit(root["digest"] if root else None).cast("string")
    return out.select(
        "id", F.col("digest").alias("leaf"), "subroot", known.alias("root"), "proof", "folded_root", (F.col("folded_root") == known).alias("verified")
    )
