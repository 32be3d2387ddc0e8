"""Memory of Python workers, which stay for the tasks that follow."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa


def release() -> None:
    """Give what Arrow and the C library hold, but no longer use, back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[Any]], Iterator[Any]]) -> Callable[[Iterator[Any]], Iterator[Any]]:
    """The function of a task, which releases memory when it has ended."""

    @functools.wraps(run)
    def tidied(batches: Iterator[Any]) -> Iterator[Any]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied
