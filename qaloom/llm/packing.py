"""Best-fit packing whose groups are certified by lower bounds.

Pieces are dealt to groups; each group packs its own by best-fit decreasing and compares its number of bins with lower
bounds from dual feasible functions. A group that meets its bound is proved to be optimal and done. The others keep
their full bins and give the rest away: what they give is dealt to larger groups of other neighbours, packed again, and
so on for a fixed number of rounds. Only keys and lengths move, never texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.storage import materialize

from .tokens import pieces as token_pieces

PLACED = "piece_key bigint, length bigint, sequence_id bigint, offset bigint, settled boolean"


def lower_bound(lengths: np.ndarray, limit: int) -> int:
    """The best of several lower bounds on the number of bins, from the counts of lengths."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=limit + 1).astype(np.int64)
    weight = count * np.arange(limit + 1)
    n, total = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(weight)])
    best = -(-int(total[-1]) // limit)
    # Lengths above limit - a fill a bin, those below a count nothing, large ones take small ones into their gaps.
    a = np.arange(0, limit // 2 + 1)
    huge, half = n[-1] - n[limit - a + 1], limit // 2 + 1
    large = n[limit - a + 1] - n[np.minimum(half, limit - a + 1)]
    room = large * limit - (total[limit - a + 1] - total[np.minimum(half, limit - a + 1)])
    small = total[half] - total[np.minimum(a, half)]
    best = max(best, int((huge + large + np.maximum(0, -(-(small - room) // limit))).max()))
    # x -> floor((k + 1) x) / k, but x itself where (k + 1) x is whole.
    x = np.arange(limit + 1)
    for k in range(1, 33):
        scaled = (k + 1) * x
        share = np.where(scaled % limit == 0, x / limit, (scaled // limit) / k)
        best = max(best, int(np.ceil((share * count).sum() - 1e-6)))
    return best


def best_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and each bin's free room, by best-fit decreasing.

    Bins with the same room lie on one stack, and a bit mask of the stacks in use finds the tightest one that fits.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(limit + 1)]
    free: list[int] = []
    mask = 0
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                mask &= ~(1 << room)
        else:
            room, b = limit, len(free)
            free.append(limit)
        bins[i], offsets[i] = b, limit - room
        left = room - size
        free[b] = left
        if left:
            stacks[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.asarray(free, np.int64)


def _packer(limit: int, turn: int, last: bool):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("piece_key")
        lengths = part["length"].to_numpy(np.int64)
        bins, offsets, free = best_fit(lengths, limit)
        proved = len(free) <= lower_bound(lengths, limit)
        settled = np.full(len(lengths), True) if last or proved else free[bins] == 0
        base = (turn << 58) | (int(part["grp"].iloc[0]) << 26)
        return pd.DataFrame(
            {"piece_key": part["piece_key"].to_numpy(), "length": lengths, "sequence_id": base + bins, "offset": offsets, "settled": settled}
        )

    return run


def pack(pieces: DataFrame, limit: int = 2048, group: int = 8192, rounds: int = 4) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of ``pieces`` (piece_key, length): piece_key, sequence_id, offset.

    ``pieces`` must be a written table. Pieces of the full length are sequences of their own. A group holds about
    ``group`` pieces and twice as many in each later round, whatever the table's size. An empty table gives none.
    """
    whole = pieces.filter(F.col("length") >= limit).select("piece_key", (-F.col("piece_key") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    todo = pieces.filter(F.col("length") < limit).select("piece_key", "length")
    done = [whole]
    for turn in range(rounds):
        n = todo.count()
        if n == 0:
            break
        groups = max(1, round(n / (group << turn)))
        last = turn == rounds - 1 or groups == 1

        dealt = todo.withColumn("grp", F.pmod(F.xxhash64(F.lit(turn), "piece_key"), F.lit(groups)))
        placed = materialize(dealt.groupBy("grp").applyInPandas(_packer(limit, turn, last), PLACED), "packed")
        done.append(placed.filter("settled").select("piece_key", "sequence_id", "offset"))
        todo = placed.filter(~F.col("settled")).select("piece_key", "length")
        if last:
            break
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def packed_pieces(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """Pieces of all documents (see ``tokens.pieces``) with the sequence and the offset of each."""
    cut = materialize(token_pieces(docs, tokenizer, limit), "pieces")
    placed = pack(cut.select("piece_key", "length"), limit)
    return cut.join(placed, "piece_key").drop("piece_key")
