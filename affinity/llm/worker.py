"""What a Python worker keeps from one task to the next.

Workers are reused by all stages of an application. An operator that keeps something large
gets it back in its next task; work of another kind, which calls ``release`` first, finds
the memory free.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import pyarrow as pa

_kept: dict[Any, Any] = {}


def keep(key: Any, make: Callable[[], Any]) -> Any:
    """The kept value of ``key``; nothing else stays kept."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library than glibc
    _trim = None


def trim() -> None:
    """Give freed memory back to the system; it would else stay with this process while others work."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def release() -> None:
    """Keep nothing of earlier work."""
    _kept.clear()
    trim()


def trimmed(run: Callable) -> Callable:
    """A function on batches that gives back after each what it freed, but for what it keeps."""

    @wraps(run)
    def wrapped(batches):
        return _ending(run(_trimming(batches)))

    return wrapped


def lean(run: Callable) -> Callable:
    """A function on batches, or on one group, that starts and ends with as little memory as it can.

    Workers outlive their tasks: what one held at its peak is given back when the task ends.
    """

    @wraps(run)
    def wrapped(given):
        release()
        out = run(given)
        if isinstance(out, Iterator):
            return _ending(out)
        trim()
        return out

    return wrapped


def _ending(batches: Iterator) -> Iterator:
    yield from batches
    trim()


def _trimming(batches: Iterator) -> Iterator:
    for batch in batches:
        yield batch
        trim()
