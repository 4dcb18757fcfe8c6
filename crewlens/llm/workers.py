"""Memory of Python workers.

Spark keeps a worker for later tasks, of other stages too. What a task has freed stays with its
worker unless it is handed back, so that an executor would hold for each worker the most that
any stage before has needed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Bytes of a group from which memory is handed back after it.
LARGE = 1 << 20
Batches = Iterator[pa.RecordBatch]


def hand_back() -> None:
    """Give freed memory back to the system, where the C library can (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` of ``mapInArrow``; memory is handed back at the task's end."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            hand_back()

    return run


def lean_group(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` of ``applyInArrow``; memory is handed back after every large group."""

    def run(rows):
        size = rows.nbytes
        out = work(rows)
        if size >= LARGE:
            del rows
            hand_back()
        return out

    return run


def lean_cogroup(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for two groups that meet."""

    def run(left, right):
        size = left.nbytes + right.nbytes
        out = work(left, right)
        if size >= LARGE:
            del left, right
            hand_back()
        return out

    return run
