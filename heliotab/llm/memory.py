"""Memory that a Python process keeps between steps."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def release() -> None:
    """Give memory that is free in this process back to the system.

    What a fit or an index needed for a moment otherwise stays with the C library and Arrow's pool while
    later steps run, beside the heap of the driver's or an executor's JVM.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's; others have none
    if trim:
        trim(0)
