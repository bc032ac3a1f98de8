"""Numbering of rows into batches and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sweep import row_numbers


def batch_of(row: Column, size: int) -> Column:
    """Batch (from 1) of row number `row` (from 1), `size` rows a batch."""
    return (F.floor((row - 1) / size) + 1).cast("int")


def chunk_of(index: Column, n_chunks: int, n: int) -> Column:
    """Chunk (from 1) of item `index` (from 0) of n; items beyond even chunks go to chunks 1, 2, ... one by one."""
    size = max(1, n // n_chunks)
    chunk = F.floor(index / size) + 1
    return F.when(chunk > n_chunks, index - n_chunks * size + 1).otherwise(chunk).cast("int")


def numbered(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """Adds the row number in a total order, by a sweep over ranges."""
    if not order:
        raise ValueError("a total order is needed")
    return row_numbers(df, order, name)
