"""Token ids of whole texts by a public word-level BPE vocabulary, as pieces of a fixed length.

The vocabulary drops white space and never looks across it, so a text's ids are those of its chunks between white space.
A chunk met before needs no second run: known ones are joined from a bounded table of each Python worker, new ones go to
the library in one batch. Whether a vocabulary works like that is read from its file; texts of any other kind, and texts
with separators that only Python takes for white space, go to the library whole.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import memory

#: The steps before the vocabulary that never look across white space: a known form, compared with that of the file.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {
    "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True,
}
KNOWN = 600_000
LONG = 64
#: A chunk between others when many are encoded as one text; it has one id, which no chunk without it can have.
MARK = "^"
TOGETHER = 1000
#: Chunks of this Python worker: chunk -> ids as little-endian 32-bit numbers, under the vocabulary's path.
_known: dict[str, dict[str, bytes]] = {}
_tokenizers: dict = {}

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, piece_key bigint"


def by_chunks(path: str) -> bool:
    """Whether the file's vocabulary encodes each chunk between white space by itself."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    first = (told.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
    specials = [x["content"] for x in told.get("added_tokens") or [] if x["lstrip"] or x["rstrip"] or x["single_word"] or x["content"].split() != [x["content"]]]
    return (told.get("normalizer") or {}).get("normalizers") == NORMALIZERS and first[0] == SPLIT and not specials and not told.get("post_processor")


def _tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path), by_chunks(path)
    return _tokenizers[path]


def _raw(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _core(chunk: str) -> tuple[str, str]:
    """A chunk as a word, in lower case where that is plain, and one mark that ends it, which is a word of its own."""
    tail = ""
    if chunk[-1] in ".,;:!?" and len(chunk) > 1 and chunk[-2].lower().isalnum():
        chunk, tail = chunk[:-1], chunk[-1]
    return chunk.lower() if chunk.isascii() else chunk, tail


def _learn(chunks: set[str], tokenizer, known: dict[str, bytes]) -> dict[str, bytes]:
    """Ids of new chunks and their words; many words are encoded in one text with marks between them."""
    parts = {w: (w, "") if len(w) > LONG else _core(w) for w in chunks}
    words = {x for p in parts.values() for x in p if x and x not in known}
    short = [w for w in words if len(w) <= LONG and MARK not in w]
    mark = tokenizer.encode(MARK, add_special_tokens=False).ids
    out: dict[str, bytes] = {}
    for at in range(0, len(short) if len(mark) == 1 else 0, TOGETHER):
        some = short[at : at + TOGETHER]
        (one,) = tokenizer.encode_batch_fast([f" {MARK} ".join(some)], add_special_tokens=False)
        ids = np.asarray(one.ids, "<u4")
        ends = [*np.flatnonzero(ids == mark[0]).tolist(), len(ids)]
        if len(ends) == len(some):
            raw, start = ids.tobytes(), 0
            for word, end in zip(some, ends):
                out[word] = raw[4 * start : 4 * end]
                start = end + 1
    for word in words - out.keys():
        out[word] = _raw(tokenizer.encode(word, add_special_tokens=False).ids)
    for chunk, (core, tail) in parts.items():
        if chunk not in out:
            ids = out[core] if core in out else known[core]
            out[chunk] = ids + (out[tail] if tail in out else known[tail]) if tail else ids
    return out


def encode(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers."""
    (tokenizer, chunked), known = _tokenizer(path), _known.setdefault(path, {})
    ids = known.__getitem__
    out: list[bytes] = []
    late: list[tuple[int, list[str]]] = []
    new: set[str] = set()
    for text in texts:
        if not chunked or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            out.append(_raw(tokenizer.encode(text, add_special_tokens=False).ids))
            continue
        chunks = text.split()
        try:
            out.append(b"".join(map(ids, chunks)))
        except KeyError:
            new.update(chunks)
            late.append((len(out), chunks))
            out.append(b"")
    learnt = _learn({w for w in new if w not in known}, tokenizer, known)
    known.update(learnt)
    for n, chunks in late:
        out[n] = b"".join(map(ids, chunks))
    for chunk in learnt if len(known) > KNOWN else [w for w in learnt if len(w) > LONG]:
        del known[chunk]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches with about ``size`` bytes of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(lengths):
            stop, total = at + 1, lengths[at]
            while stop < len(lengths) and total + lengths[stop] <= size:
                total += lengths[stop]
                stop += 1
            yield batch.slice(at, stop - at)
            at = stop


def pieces(docs: DataFrame, path: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32 and a key of the piece.

    A document is its ids and ``end_id``; one longer than ``limit`` is cut into pieces of that length, the last may be
    shorter. A null text is empty, so its only id is ``end_id``. Every row is a document, also with a null or repeated
    id. The key is unique as long as the result is written before it is used twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = TaskContext.get().partitionId() << 40
        tail = _raw([end_id])
        for batch in _blocks(batches):
            rows = []
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts, path)):
                ids += tail
                for i, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    rows.append((doc, i, at // 4, len(part) // 4, zlib.crc32(part), key))
                    key += 1
            doc, piece, start, length, crc, keys = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, keys))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "piece_key"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(memory.over_batches(run), PIECE)
