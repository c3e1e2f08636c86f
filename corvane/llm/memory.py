"""Memory that a Python worker holds between tasks.

Spark keeps its workers for later stages, and a worker's allocators keep what a task has freed.  Jobs of several stages
hand it back when a task's work is done, so that an idle worker takes no room from the stages after it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, other C libraries do without


def give_back() -> None:
    """Return freed memory of Arrow's pool and of the C library to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` over the batches of a task, which gives memory back at the end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
