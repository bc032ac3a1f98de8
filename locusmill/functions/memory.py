"""What a driver's namespace holds, by size."""

from __future__ import annotations

import sys
from collections.abc import Mapping
from typing import Any

import pandas as pd


def size_of(value: Any) -> int:
    """Bytes of a value itself: buffers of arrays and frames, else what the interpreter reports."""
    if isinstance(value, pd.DataFrame):
        return int(value.memory_usage(deep=True).sum())
    return int(getattr(value, "nbytes", 0) or sys.getsizeof(value))


def largest(namespace: Mapping[str, Any], most: int = 20) -> list[tuple[str, str, int]]:
    """(name, type, bytes) of the largest values, largest first, ties by name."""
    rows = [(name, type(value).__name__, size_of(value)) for name, value in namespace.items()]
    return sorted(rows, key=lambda r: (-r[2], r[0]))[:most]


def named(namespace: Mapping[str, Any], names: list[str]) -> list[tuple[str, str, int]]:
    """(name, type, bytes) of the given names, in their order; names that are not there are left out."""
    return [(n, type(namespace[n]).__name__, size_of(namespace[n])) for n in names if n in namespace]
