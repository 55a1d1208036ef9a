"""Memory of Python workers: rows one at a time, and free memory given back when a task is done.

A Python worker serves many tasks. What its allocators keep after a large task counts against the executor while other
stages run, so functions over batches that build large tables give it back at their end.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Free memory of Arrow's pool and of the C library (where it can) to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch as Python values, one at a time, so that a batch of large blobs is never held twice."""
    for n in range(batch.num_rows):
        yield batch.slice(n, 1).to_pylist()[0]


def over_batches(run: Callable) -> Callable:
    """A function over an iterator of batches that gives free memory back after the last one."""

    def inner(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return inner


def over_group(run: Callable) -> Callable:
    """A function over one group that gives free memory back after it."""

    def inner(group):
        out = run(group)
        give_back()
        return out

    return inner
