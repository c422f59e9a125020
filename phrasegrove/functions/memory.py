"""Memory that a worker has freed but still holds."""

from __future__ import annotations

import ctypes

import pyarrow as pa

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library than glibc
    _trim = None


def give_back() -> None:
    """Hand freed memory back to the system: workers stay, and would keep what one batch took."""
    if _trim:
        _trim(0)
    pa.default_memory_pool().release_unused()
