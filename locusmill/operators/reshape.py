"""Widening, lengthening and picking by name, without shuffles where the names are known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_labels(c: Column, separator: str = ",") -> Column:
    """The labels of a joined text, trimmed."""
    return F.transform(F.split(c, f"[{separator}]"), lambda x: F.trim(x))


def distinct_labels(df: DataFrame, column: str, separator: str = ",") -> list[str]:
    """All labels there are, in order; few, as each becomes a column."""
    return [r[0] for r in df.select(F.explode(split_labels(F.col(column), separator)).alias("x")).distinct().orderBy("x").collect()]


def widen_labels(df: DataFrame, column: str, labels: list[str] | None = None, separator: str = ",") -> DataFrame:
    """A boolean column per label instead of the joined text."""
    labels = distinct_labels(df, column, separator) if labels is None else labels
    return df.withColumns({x: F.array_contains(split_labels(F.col(column), separator), x) for x in labels}).drop(column)


def suppress_flag(df: DataFrame, flag: str, others: list[str]) -> DataFrame:
    """`flag` becomes false where any of the others is set."""
    some = F.lit(False)
    for o in others:
        some = some | F.coalesce(F.col(o), F.lit(False))
    return df.withColumn(flag, F.when(some, F.lit(False)).otherwise(F.col(flag)))


def component_value(values: list[Column], index: Column) -> Column:
    """Of columns numbered from 1, the one that an index like L3 names."""
    return F.get(F.array(*values), F.substring(index, 2, 10).try_cast("int") - 1)


def pick_by_name(columns: dict[str, Column], name: Column) -> Column:
    """The value of the column that `name` names, null for a name that is not there."""
    return F.try_element_at(F.create_map(*[x for k, v in columns.items() for x in (F.lit(k), v)]), name)


def to_long(df: DataFrame, keys: list[str], values: list[str], name: str = "sample_id", value: str = "value") -> DataFrame:
    """One row per key and value column."""
    return df.unpivot(keys, values, name, value)


def transpose(df: DataFrame, row: str, name: str = "sample_id") -> DataFrame:
    """Columns other than `row` become rows (`name`), values of `row` become columns."""
    samples = [c for c in df.columns if c != row]
    labels = [r[0] for r in df.select(row).distinct().orderBy(row).collect()]
    return to_long(df, [row], samples, name).groupBy(name).pivot(row, labels).agg(F.first("value"))
