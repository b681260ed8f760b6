"""Giving memory back between tasks: Python workers live on, and share an executor's memory with what follows."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
from collections.abc import Callable, Iterator
from functools import wraps


def trim() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    try:
        ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library; it keeps what it has


def released(fn: Callable[[Iterator], Iterator], forget: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """``fn`` over batches; when a task ends, what ``forget`` drops and what has been freed goes back to the system."""
    @wraps(fn)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from fn(batches)
        finally:
            if forget is not None:
                forget()
            trim()
    return run
