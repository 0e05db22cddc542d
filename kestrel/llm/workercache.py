"""What a Python worker keeps between tasks: one table at a time.

Spark reuses its Python workers, so looked-up words survive from task to
task.  Asking for another operator's table drops the one before, and so
does a task that needs none: a worker's memory stays that of one operator.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_KEPT: dict[Hashable, Any] = {}


def kept(name: Hashable, make: Callable[[], Any]) -> Any:
    if name not in _KEPT:
        drop()
        _KEPT[name] = make()
    return _KEPT[name]


def drop() -> None:
    """Forget the table and give freed memory back to the system: allocators
    keep it otherwise, and the next task's worker may be another operator's."""
    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)
