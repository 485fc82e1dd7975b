"""What a Python worker remembers between tasks: one thing at a time, so that no stage pays for the memory of another."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable

import pyarrow as pa

_KEPT: dict = {}


def kept(key: tuple, make: Callable):
    """What make() gave when this worker first asked for the key; anything kept under other keys goes."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """For stages that remember nothing themselves. What was kept is also given back to the system: a worker lives as long
    as its executor, and free memory that it holds adds to that of every later stage."""
    if not _KEPT:
        return
    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
