"""Memory of Python workers, which Spark keeps alive for the tasks to come."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system; the C library keeps it for the process where blocks in use lie above it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def handing_back(run: Callable[[Iterator], Iterable]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, and what it freed is returned when the task ends.

    An idle worker counts against its executor like a busy one, also in later stages that run no Python.
    """

    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
