"""Memory of the Python workers that run tasks.

A worker runs many tasks one after the other, of several operators; what
the allocators keep of one task's arrays is lost to the next operator.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa


@functools.cache
def _libc():
    """The C library; None where it can't return free memory."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.malloc_trim  # noqa: B018
    except (OSError, AttributeError):
        return None
    return libc


def release() -> None:
    """Return free memory to the system."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def lean(task: Callable) -> Callable:
    """A task function (of batches, or of a group's table) that returns its memory at its end."""

    @functools.wraps(task)
    def run(data):
        out = task(data)
        if isinstance(out, Iterator):
            return _each(out)
        release()
        return out

    return run


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    try:
        yield from batches
    finally:
        release()
