"""Sweeps over an order that all tasks share: running sums and maxima whose state crosses partition borders.

A window over a group brings the group to one task, and a window without a group brings everything
there. Here rows are ranged over the cluster in the sweep's order, each task sweeps its own range, and what
the ranges before it leave behind, its carry, is added: one number for the group that runs on across its
lower border, so at most one row per partition. Those rows are swept in their turn and sent to all tasks.

Ranges are found by sampling, which two uses of one plan may do differently, so the ranged rows are
written once with the number of their range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..sources.shared import stored

PART = "__part"
_COMBINE = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest}
_AGGREGATE = {"sum": F.sum, "max": F.max}


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`df` with the number of its range in `order` as `__part`, written to the shared folder."""
    return stored(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def with_carry(parts: DataFrame, by: Sequence[str], value: str, how: str, name: str = "__carry", own: DataFrame | None = None) -> DataFrame:
    """Adds what the ranges before leave for each row's group: the sum or maximum of `value` over the group's rows in them, null if there are none.

    own: rows whose `value` counts, if not those of `parts`.
    """
    totals = (parts if own is None else own).groupBy(PART, *by).agg(_AGGREGATE[how](value).alias("__own"))
    before = W.Window.partitionBy(*by).orderBy(PART).rowsBetween(W.Window.unboundedPreceding, -1)  # a row per range of a group
    carry = totals.select(F.col(PART).alias("__p"), *[F.col(c).alias(f"__b{i}") for i, c in enumerate(by)], _AGGREGATE[how]("__own").over(before).alias(name))
    same = F.col(PART) == F.col("__p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__b{i}"))
    # Only a group that starts in an earlier range has a carry: one per range at most.
    return parts.join(F.broadcast(carry.where(F.col(name).isNotNull())), same, "left").drop("__p", *[f"__b{i}" for i in range(len(by))])


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, how: str, name: str) -> DataFrame:
    """Adds the sum or maximum of `value` over the rows before each one of its group, in `order` (total within a group).

    The first row of a group has a sum of 0 and no maximum. `__part` is left on the rows.
    """
    parts = with_carry(in_ranges(df, [*by, *order]), by, value, how)
    inside = W.Window.partitionBy(PART, *by).orderBy(*order).rowsBetween(W.Window.unboundedPreceding, -1)
    return parts.withColumn(name, _COMBINE[how](_AGGREGATE[how](value).over(inside), F.col("__carry"))).drop("__carry")


def islands(df: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """(group, start, end, n_windows): disjoint unions of overlapping or touching windows; those without start or end are left out.

    The running maximum of ends tells where a union starts. Each range sums up its part of every
    union, and what runs on across a border goes by the start that an earlier range found for it.
    """
    rows = df.select(group, start, end).where(F.col(start).isNotNull() & F.col(end).isNotNull())
    swept = running(rows, [group], [start, end], end, "max", "__reach")
    opens = F.col("__reach").isNull() | (F.col(start) > F.col("__reach"))
    upto = W.Window.partitionBy(PART, group).orderBy(start, end).rowsBetween(W.Window.unboundedPreceding, 0)
    swept = swept.withColumn("__island", F.max(F.when(opens, F.col(start))).over(upto))
    pieces = stored(swept.groupBy(PART, group, "__island").agg(F.max(end).alias(end), F.count(F.lit(1)).alias("n_windows")))
    pieces = with_carry(pieces, [group], "__island", "max")
    whole = pieces.groupBy(group, F.coalesce("__island", "__carry").alias(start))
    return whole.agg(F.max(end).alias(end), F.sum("n_windows").alias("n_windows"))


def row_numbers(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds the row number (from 1) in a total order."""
    parts = in_ranges(df, order)
    ones = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("__n"))
    inside = W.Window.partitionBy(PART).orderBy(*order)
    out = with_carry(parts, [], "__n", "sum", own=ones)
    return out.withColumn(name, F.coalesce("__carry", F.lit(0).cast("long")) + F.row_number().over(inside)).drop(PART, "__carry")


def average_ranks(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Adds the rank of `value` within its group, ties averaged; rows with a missing value or group stay unranked."""
    keys = [*by, value]
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    swept = running(counts, by, [value], "__n", "sum", "__before")
    rank: Column = F.col("__before") + (F.col("__n") + 1) / 2
    return df.join(swept.select(*keys, rank.alias(name)), keys, "left")


def quantiles(df: DataFrame, by: Sequence[str], value: str, q: float, name: str) -> DataFrame:
    """(by, name): the exact quantile of each group, between neighbours in proportion, from counts of its distinct values; missing values do not count."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    swept = running(counts, by, [value], "__n", "sum", "__before")
    n = counts.groupBy(*by).agg(F.sum("__n").alias("__all"))
    place = (F.col("__all") - 1) * F.lit(q)
    low, high = F.floor(place), F.ceil(place)
    holds = lambda k: (F.col("__before") <= k) & (k < F.col("__before") + F.col("__n"))
    both = swept.join(n, list(by)) if by else swept.crossJoin(F.broadcast(n))
    ends = both.where(holds(low) | holds(high)).groupBy(*by).agg(F.min(value).alias("__a"), F.max(value).alias("__b"), F.first(place - low).alias("__part"))
    return ends.select(*by, (F.col("__a") + (F.col("__b") - F.col("__a")) * F.col("__part")).alias(name))
