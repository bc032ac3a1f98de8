"""Choosing phenotypes and rows: matches, false-discovery filter, top per cluster, first per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import cluster_id
from .sweep import average_ranks

#: Columns that may rank phenotypes, in order of preference.
P_COLUMNS = ("pval_beta", "pval_perm", "pval_nominal", "pval_true_df", "qval", "p_fdr")


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    gone = [n for n in names if n not in df.columns]
    if gone:
        raise ValueError(f"{what} lacks column(s): {', '.join(gone)}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df


def match_phenotypes(df: DataFrame, column: str, wanted: str, how: str = "exact") -> DataFrame:
    """Rows whose `column` equals `wanted`, contains it literally, or (how="regex") matches it.

    how="line" matches the expression against the whole line, columns joined by tabs and missing ones as NA.
    """
    c = F.col(column)
    line = F.concat_ws("\t", *[F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("NA")) for x in df.columns])
    tests = {"exact": c == wanted, "contains": F.instr(c, wanted) > 0, "regex": c.rlike(wanted), "line": line.rlike(wanted)}
    return df.where(tests[how])


def significant(df: DataFrame, level: float = 0.05, column: str = "p_fdr") -> DataFrame:
    """Strictly below `level`; missing values do not pass."""
    return df.where(F.col(column) < level)


def keep_matching(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows that have a match in `keys` (left semi join; Spark picks broadcast by the keys' own size)."""
    return df.join(keys, on, "left_semi")


def ranking_column(columns: Sequence[str], preferred: str = "qval") -> str:
    """The preferred column, else the first of P_COLUMNS that exists."""
    for name in (preferred, *P_COLUMNS):
        if name in columns:
            return name
    raise ValueError(f"none of {', '.join((preferred, *P_COLUMNS))} is there")


def number_or_null(c: Column) -> Column:
    """A number, null where the text is none or is not a number."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def top_per_cluster(df: DataFrame, phenotype: str = "phenotype_id", preferred: str = "qval") -> DataFrame:
    """The best phenotype of each cluster: smallest p, missing p last, ties by phenotype.

    One row per cluster and input partition survives the map side (`min_by` pre-aggregates), so a
    cluster that holds much of the input does not meet in one task, as under a ranking window.
    """
    p = number_or_null(F.col(ranking_column(df.columns, preferred)))
    order = F.struct(p.isNull().alias("missing"), p.alias("p"), F.col(phenotype).alias("id"))
    best = df.groupBy(cluster_id(F.col(phenotype)).alias("cluster_id")).agg(F.min_by(F.struct(*df.columns), order).alias("row"))
    return best.select("cluster_id", "row.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order, which has to be total."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("row")).select(*keys, "row.*")


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of `columns`."""
    return df.select(*columns).distinct()


def summary_counts(df: DataFrame, by: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """Per group n (rows) and n_<column> (distinct values of each of `distinct`); one row without `by`."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.countDistinct(c).alias(f"n_{c}") for c in distinct])


def sample_group(samples: DataFrame, group: str = "ALL", column: str = "qtl_group") -> DataFrame:
    """The samples of one group; samples without the column are all of group ALL."""
    if column not in samples.columns:
        samples = samples.withColumn(column, F.lit("ALL"))
    return samples.where(F.col(column) == group)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def average_rank(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Adds the rank with ties averaged; missing values stay unranked.

    Distinct values are counted first and summed up by a sweep over ranges of them, so neither the
    whole table (without `by`) nor a large group comes to one task.
    """
    return average_ranks(df, value, by, name)


def pair_samples(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """One-to-one alignment; an error if a row of `left` has no partner."""
    if not left.join(right, on, "left_anti").isEmpty():
        raise ValueError(f"some {on} have no partner")
    return left.join(right, on)
