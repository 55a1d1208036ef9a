"""Repeated passages by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of ``WIDTH`` bytes over it also starts in a document with a smaller number. Only suffixes that can
be repeated are sorted. Every window of ``WIDTH`` bytes names the smallest of its grams as its anchor, and equal windows
name the same; batches exchange the hashes of their anchors' grams, and an anchor that only one document has is done.

For the other anchors, a batch takes the suffix from the anchor's first window, cut behind its last one. It sorts them
to a run, drops repeats, and sends the run front-coded: each suffix as the length of the prefix it shares with the one
before, and the rest. A task merges the runs with a loser tree whose players carry the prefix length they share with
the last winner; a comparison starts behind it, and often need not look at a byte. Equal suffixes fall together and
get their smallest document. Where suffixes of one gram differ, their windows are compared as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.storage import materialize

from . import hashing, memory

WIDTH, GRAM, CHUNK, BATCH, PART = 50, 24, 1 << 17, 1 << 22, 1 << 23
LAST = np.iinfo(np.int64).max
LOCAL = np.uint64(20)


# --- windows and anchors --------------------------------------------------------
def anchors(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of neighbouring windows with one anchor: first and last window start, gram (40 bits), document."""
    first, last, key, owner = [], [], [], []
    span = width - gram + 1
    for at in range(0, max(0, len(data) - width + 1), CHUNK):
        part = data[at : at + CHUNK + width - 1]
        n = len(part) - width + 1
        p = np.arange(len(part) - gram + 1)
        h = hashing.span_hash(hashing.prefix_hash(part), p, p + gram)
        rank = ((h >> LOCAL) << LOCAL) | p.astype(np.uint64)
        padded = np.full(-(-len(rank) // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(rank)] = rank
        table = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(table, axis=1).ravel()
        back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(back[:n], ahead[span - 1 : span - 1 + n]) & np.uint64((1 << 20) - 1)).astype(np.int64)
        start = np.arange(at, at + n)
        doc = (np.searchsorted(offsets, start, side="right") - 1).astype(np.int32)
        valid = start + width <= offsets[doc + 1]
        start, doc, place = start[valid], doc[valid], place[valid]
        if not len(start):
            continue
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)]))
        first.append(start[new])
        last.append(start[np.concatenate([new[1:], [len(start)]]) - 1])
        key.append(h[place[new]] >> np.uint64(24))
        owner.append(doc[new])
    if not first:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), empty
    return np.concatenate(first), np.concatenate(last), np.concatenate(key), np.concatenate(owner)


def _five(x: np.ndarray) -> bytes:
    """Numbers of 40 bits in five bytes each, byte by byte."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes()


def _from_five(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(5, -1).T
    return out.view("<u8").ravel()


def _codec() -> pa.Codec:
    return pa.Codec("zstd", 3)


def _small(raw: bytes) -> bytes:
    """Compressed, behind its length."""
    return len(raw).to_bytes(8, "little") + (_codec().compress(raw, asbytes=True) if raw else b"")


def _wide(raw: bytes, kind: type = np.uint8) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(_codec().decompress(raw[8:], size, asbytes=True) if size else b"", kind)


class Batch:
    """Documents of one batch: numbers (null last), bytes, and the groups of windows whose gram others have too."""

    def __init__(self, row: dict, width: int, gram: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.raw = _codec().decompress(row["blob"], int(self.offsets[-1]), asbytes=True) if self.offsets[-1] else b""
        self.data = np.frombuffer(self.raw, np.uint8)
        self.first, self.last, self.key, self.doc = anchors(self.data, self.offsets, width, gram)

    def keep(self, grams: list[bytes]) -> None:
        shared = np.sort(np.concatenate([np.zeros(0, np.uint64), *(_from_five(x) for x in grams)]))
        if not len(shared):
            here = np.zeros(len(self.key), bool)
        else:
            here = shared[np.minimum(np.searchsorted(shared, self.key), len(shared) - 1)] == self.key
        self.first, self.last, self.key, self.doc = self.first[here], self.last[here], self.key[here], self.doc[here]

    def suffixes(self, width: int) -> tuple[list[bytes], np.ndarray]:
        """Different suffixes in order, and for each group of windows which of them it is."""
        text = [self.raw[a : b + width] for a, b in zip(self.first.tolist(), self.last.tolist())]
        order = sorted(set(text))
        at = {x: n for n, x in enumerate(order)}
        return order, np.fromiter((at[x] for x in text), np.int64, len(text))


def _pack(rest: T.DataType):
    """Documents to batches of about ``BATCH`` bytes, or one document; ``rest`` holds their other columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = hashing.text_bytes(batch.column(1))
            ids = np.array([LAST if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH, side="right")) - 1)
                blob = data[offsets[at] : offsets[stop]].tobytes()
                other = batch.column(2).slice(at, stop - at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], pa.int64()), pa.array([len(blob)], pa.int64()), pa.array([ids[at:stop].tobytes()], pa.binary()),
                     pa.array([(offsets[at : stop + 1] - offsets[at]).tobytes()], pa.binary()), pa.array([_codec().compress(blob, asbytes=True)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, stop - at], pa.int32()), pa.concat_arrays([other]))],
                    names=["batch", "size", "ids", "offsets", "blob", "rest"],
                )
                key, at = key + 1, stop

    return run


# --- grams ------------------------------------------------------------------------
def _grams(parts: int, width: int, gram: int):
    """A batch's grams by part: those of one document, and those of several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in memory.rows(batch):
                b = Batch(row, width, gram)
                both = np.unique((b.key << np.uint64(24)) | b.doc.astype(np.uint64))  # a batch has fewer than 2**24 documents
                value, count = np.unique(both >> np.uint64(24), return_counts=True)
                part = (value % np.uint64(parts)).astype(np.int64)
                for p in np.unique(part).tolist():
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([p], pa.int64()), "batch": pa.array([row["batch"]], pa.int64()),
                        "one": pa.array([_five(value[(part == p) & (count == 1)])], pa.binary()), "several": pa.array([_five(value[(part == p) & (count > 1)])], pa.binary()),
                    })

    return run


def _shared(part: pd.DataFrame) -> pd.DataFrame:
    """For each batch, its grams that several documents have, in it or in all batches."""
    one, several = ([_from_five(x) for x in part[c]] for c in ("one", "several"))
    value, count = np.unique(np.concatenate(one + several), return_counts=True)
    many = np.unique(np.concatenate([value[count > 1], *several]))
    out = []
    for batch, a, b in zip(part["batch"], one, several):
        both = np.concatenate([a, b])
        if len(many) and len(both):
            both = both[many[np.minimum(np.searchsorted(many, both), len(many) - 1)] == both]
            if len(both):
                out.append((batch, _five(np.sort(both))))
    return pd.DataFrame(out, columns=["batch", "grams"]).astype({"batch": "int64"})


# --- runs ---------------------------------------------------------------------------
def common(a: bytes, b: bytes, at: int = 0) -> int:
    """How long the common prefix is, if the first ``at`` bytes are known to be equal."""
    n = min(len(a), len(b))
    while at < n:
        if a[at : at + 8] != b[at : at + 8]:
            while at < n and a[at] == b[at]:
                at += 1
            return at
        at += 8
    return n


def encode_run(sorted_: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Front coding: shared prefix lengths, lengths of the rests, and the rests."""
    shared = [0] + [common(a, b) for a, b in zip(sorted_, sorted_[1:])]
    return np.array(shared, np.int32), np.array([len(x) - n for x, n in zip(sorted_, shared)], np.int32), b"".join(x[n:] for x, n in zip(sorted_, shared))


def decode_run(shared: np.ndarray, lengths: np.ndarray, rests: bytes) -> Iterator[tuple[bytes, int]]:
    last, at = b"", 0
    for n, length in zip(shared.tolist(), lengths.tolist()):
        last = last[:n] + rests[at : at + length]
        at += length
        yield last, n


def merge(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """Merge sorted runs: strings, the prefix length shared with the string before, and the run.

    A loser tree: node i holds the loser of its match, and a player's number is what it shares with the last winner.
    Of two players the one that shares more is smaller; only players that share the same are compared, from there on.
    """
    k = len(runs)
    head: list[bytes | None] = [None] * k
    known = [0] * k
    for r in range(k):
        head[r], known[r] = next(runs[r], (None, 0))
    loser = [-1] * max(1, k)

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser."""
        a, b = head[x], head[y]
        if a is None:
            return y, x
        if b is None or known[x] > known[y]:
            return x, y
        if known[x] < known[y]:
            return y, x
        n = common(a, b, known[x])
        if n == len(a) or (n < len(b) and a[n] < b[n]):
            known[y] = n
            return x, y
        known[x] = n
        return y, x

    top = [0] * (2 * k)
    for r in range(k):
        top[k + r] = r
    for node in range(k - 1, 0, -1):
        top[node], loser[node] = play(top[2 * node], top[2 * node + 1])
    winner = top[1] if k > 1 else 0
    while head[winner] is not None:
        yield head[winner], known[winner], winner
        head[winner], known[winner] = next(runs[winner], (None, 0))
        node = (k + winner) >> 1
        while node:
            winner, loser[node] = play(winner, loser[node])
            node >>= 1


RUN = "part bigint, batch bigint, shared binary, lengths binary, rests binary, places binary, docs binary, grams binary"
ANSWER = "batch bigint, places binary, least binary, odd binary, odd_least binary"


def _runs(parts: int, width: int, gram: int):
    """A batch's suffixes of shared grams by part, sorted and front-coded, with the smallest document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in memory.rows(batch):
                b = Batch(row, width, gram)
                b.keep(row["grams"] or [])
                order, which = b.suffixes(width)
                least = np.full(len(order), LAST, np.int64)
                np.minimum.at(least, which, b.ids[b.doc])
                grams = np.zeros(len(order), np.uint64)
                grams[which] = b.key
                part = (grams % np.uint64(parts)).astype(np.int64)
                for p in np.unique(part).tolist():
                    places = np.flatnonzero(part == p)
                    shared, lengths, rests = encode_run([order[x] for x in places.tolist()])
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([p], pa.int64()), "batch": pa.array([row["batch"]], pa.int64()), "shared": [_small(shared.astype(np.int32).tobytes())], "lengths": [_small(lengths.tobytes())],
                        "rests": [_small(rests)], "places": [_small(np.diff(places, prepend=0).astype(np.int32).tobytes())], "docs": [_small(least[places].tobytes())], "grams": [_five(grams[places])],
                    })

    return run


def _merged(width: int):
    """Smallest documents of all windows of a part's suffixes, sent back to the batches."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("batch")
        runs = [decode_run(_wide(a, np.int32), _wide(b, np.int32), _wide(c).tobytes()) for a, b, c in zip(part["shared"], part["lengths"], part["rests"])]
        docs = [_wide(x, np.int64).tolist() for x in part["docs"]]
        grams = [_from_five(x).tolist() for x in part["grams"]]
        seen = [0] * len(runs)
        kind: list[list[int]] = [[] for _ in runs]  # which different suffix each of a run's is
        text, least, by_gram = [], [], {}
        for suffix, shared, r in merge(runs):
            n = seen[r]
            if text and shared == len(suffix) == len(text[-1]):
                least[-1] = min(least[-1], docs[r][n])
            else:
                text.append(suffix)
                least.append(docs[r][n])
                by_gram.setdefault(grams[r][n], []).append(len(text) - 1)
            kind[r].append(len(text) - 1)
            seen[r] = n + 1
        windows: dict[int, list[int]] = {}  # of suffixes whose windows differ in their smallest document
        for group in by_gram.values():
            if len(group) == 1:
                continue
            best: dict[bytes, int] = {}
            for x in group:
                s, doc = text[x], least[x]
                for i in range(len(s) - width + 1):
                    w = s[i : i + width]
                    if best.get(w, LAST) >= doc:
                        best[w] = doc
            for x in group:
                s = text[x]
                found = [best[s[i : i + width]] for i in range(len(s) - width + 1)]
                if min(found) < least[x]:
                    windows[x] = found
        out = []
        for r, (batch, places) in enumerate(zip(part["batch"], part["places"])):
            place = np.cumsum(_wide(places, np.int32))
            odd = [(p, x) for p, x in zip(place.tolist(), kind[r]) if x in windows]
            out.append((
                batch, places, _small(np.array([least[x] for x in kind[r]], np.int64).tobytes()), _small(np.array([p for p, _ in odd], np.int32).tobytes()),
                _small(np.array([d for _, x in odd for d in windows[x]], np.int64).tobytes()),
            ))
        return pd.DataFrame(out, columns=["batch", "places", "least", "odd", "odd_least"]).astype({"batch": "int64"})

    return run


def _cut(width: int, gram: int, rest: T.DataType, texts: bool):
    """Documents of a batch without the bytes of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, row in enumerate(memory.rows(batch.select(["ids", "offsets", "blob", "grams", "answers"]))):
                b = Batch(row, width, gram)
                b.keep(row["grams"] or [])
                order, which = b.suffixes(width)
                least = np.full(len(order), LAST, np.int64)
                odd: dict[int, np.ndarray] = {}
                for a in row["answers"] or []:
                    least[np.cumsum(_wide(a["places"], np.int32))] = _wide(a["least"], np.int64)
                    values, at = _wide(a["odd_least"], np.int64), 0
                    for x in _wide(a["odd"], np.int32).tolist():
                        size = len(order[x]) - width + 1
                        odd[x] = values[at : at + size]
                        at += size
                mark = np.zeros(len(b.data) + 1, np.int32)
                own = b.ids[b.doc]
                whole = least[which] < own
                np.add.at(mark, b.first[whole], 1)
                np.add.at(mark, b.last[whole] + width, -1)
                for g in [g for g in np.flatnonzero(~whole).tolist() if which[g] in odd]:
                    hit = b.first[g] + np.flatnonzero(odd[which[g]] < own[g])
                    np.add.at(mark, hit, 1)
                    np.add.at(mark, hit + width, -1)
                gone = np.cumsum(mark, out=mark)[:-1] > 0
                rows = []
                for i in range(len(b.ids)):
                    lo, hi = b.offsets[i], b.offsets[i + 1]
                    g = gone[lo:hi]
                    kept = b.data[lo:hi][~g].tobytes() if g.any() else b.raw[lo:hi]
                    spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                    rows.append((None if b.ids[i] == LAST else int(b.ids[i]), hi - lo, int(g.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if texts else None))
                ids, size, removed, spans, digest, kept = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()),
                     pa.array(kept, pa.string()), pa.concat_arrays([batch.column("rest").slice(n, 1).flatten()])],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "rest"],
                )

    return run


def remove_repeats(docs: DataFrame, others: Column | None = None, texts: bool = False, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Documents (doc_id, text) to doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept and rest.

    Matches are judged on the whole input texts and never cross documents. A null text is empty. A null doc_id counts
    as larger than all others, and documents with the same number do not touch each other. ``kept`` is the remaining
    text if ``texts`` (characters that a cut leaves incomplete are dropped), else null. ``rest`` is the struct of
    ``others``, handed through row by row. An empty table gives an empty result.
    """
    rest = F.struct(F.lit(0).alias("none")) if others is None else others
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", rest.alias("rest"))
    kind = source.schema["rest"].dataType
    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("batch", T.LongType()), ("size", T.LongType()), ("ids", T.BinaryType()), ("offsets", T.BinaryType()), ("blob", T.BinaryType()), ("rest", T.ArrayType(kind)),
    )])
    batches = materialize(source.mapInArrow(memory.over_batches(_pack(kind)), schema), "batches")
    parts = max(1, -(-(batches.agg(F.sum("size")).first()[0] or 0) // PART), 2 * docs.sparkSession.sparkContext.defaultParallelism)
    load = batches.select("batch", "ids", "offsets", "blob")
    grams = load.mapInArrow(memory.over_batches(_grams(parts, width, gram)), "part bigint, batch bigint, one binary, several binary")
    shared = grams.groupBy("part").applyInPandas(memory.over_group(_shared), "batch bigint, grams binary")
    shared = materialize(shared.groupBy("batch").agg(F.collect_list("grams").alias("grams")), "grams")
    runs = load.join(shared, "batch").mapInArrow(memory.over_batches(_runs(parts, width, gram)), RUN)
    answers = runs.groupBy("part").applyInPandas(memory.over_group(_merged(width)), ANSWER)
    answers = materialize(answers.groupBy("batch").agg(F.collect_list(F.struct("places", "least", "odd", "odd_least")).alias("answers")), "answers")
    back = shared.join(answers, "batch")
    out = T.StructType([T.StructField(c, t) for c, t in (
        ("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()),
        ("kept", T.StringType()), ("rest", kind),
    )])
    return batches.drop("size").join(back, "batch", "left").mapInArrow(memory.over_batches(_cut(width, gram, kind, texts)), out)
