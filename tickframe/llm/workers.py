"""What Python workers keep: they are used again by later stages, whose memory they share.

A worker keeps the caches of one operator only, and gives freed memory back when a task ends.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

_caches: list = []
_running: str | None = None


def worker_cache(maxsize: int):
    """``functools.lru_cache`` that is emptied when the worker turns to other work."""

    def wrap(fn: Callable) -> Callable:
        cached = functools.lru_cache(maxsize)(fn)
        _caches.append(cached)
        return cached

    return wrap


def give_back() -> None:
    """Return memory that Arrow and the allocator hold without using it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another allocator


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], name: str | None = None):
    """``run`` over Arrow batches, with the caches of other work emptied first and memory given back
    at the end. ``name`` tells works apart that share a function."""
    own = name or f"{run.__module__}.{run.__qualname__}"

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        global _running
        if _running != own:
            for c in _caches:
                c.cache_clear()
            _running = own
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
