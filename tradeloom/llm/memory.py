"""Giving memory back between tasks: Python workers are reused, and what one stage has freed would
otherwise stay with them through the next ones."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def release() -> None:
    """Return freed memory to the system, as far as the platform can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def releasing(run):
    """A task's function over batches that gives its memory back when it ends."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task
