"""What a worker process keeps from one task to the next: one object at a time.

Workers outlive tasks, and so do their caches. Stages of one session run in the same
workers, so that caches of a stage that has ended would stand beside those of the
next. The slot here holds one object: asking for another drops it first.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable

import pyarrow as pa

_HELD: dict = {}


def release() -> None:
    """Drops what is held and gives free memory back to the system, where the C library can."""
    _HELD.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def resident(key: Hashable, make: Callable):
    """The object held under key; if it is another's, that one goes and ``make()`` gives the new one."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]
