"""Python workers serve one task after another, so what a task leaves allocated is there while the next stages run."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import pyarrow as pa


def frugal(function: Callable) -> Callable:
    """A function of Arrow batches that gives freed memory back to the system when its task ends."""
    @functools.wraps(function)
    def own(*a, **kw):
        try:
            yield from function(*a, **kw)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)
    return own
