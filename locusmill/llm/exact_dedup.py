"""Exact dedup by skew-safe combining, in DataFrame operations only.

Texts are equal when they are identical after every run of white space became one space. The
digest (SHA-256) only routes rows: each of the three stages groups by the digest *and* the whole
normalised text.

1. local: the map side of the first aggregation leaves one row per text and input partition;
2. salted: rows of a digest meet in `salts` tasks, one per salt;
3. global: at most `salts` winners per text meet in one task.

A group that holds a third of all rows therefore never puts more than one row per task, and then
`salts` rows, anywhere. Giving every row its group again is a join on the digest, in which groups
large enough to be felt are sent by broadcast: with a threshold of 1/2000 of the rows there are at
most 2000 of them, whatever the input.

Edge cases: a null text counts as empty; an empty table gives an empty result; a null id is larger
than any id, and rows without id form groups as others do. Of every group exactly one row stays:
where rows of a group share its smallest id (or have none), one of them, and a row whose id another
row repeats is judged by its own text. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, materialise, one_of_equal, same, text_of

#: No more than this many groups can be hot.
HOT_GROUPS = 2000


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(text, SPACE, " ")


def sha256(text: Column) -> Column:
    """Lowercase hex of the text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def classes_of(rows: DataFrame, salts: int = 16) -> DataFrame:
    """One row per distinct text of rows(id, digest, norm): digest, norm, keep_id, group_size."""
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "norm")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    )
    return salted.groupBy("digest", "norm").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, digest=sha256) -> DataFrame:
    """One row per row of `docs`: the id, keep_id, group_size, kept, digest.

    `digest` maps the normalised text to the routing key; a weak one gives the same groups, as
    two texts that share a digest are told apart by their content.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_of(text_col)).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    classes = materialise(classes_of(rows, salts).drop("norm"))
    keys = ["digest"]
    if not classes.groupBy("digest").count().where("count > 1").isEmpty():
        # Two texts share a digest: the content itself has to tell every row's group.
        keys = ["digest", "norm"]
        classes = materialise(classes_of(rows, salts))
    members = materialise(rows.select("id", *keys).withColumn("uid", F.monotonically_increasing_id()))
    total = members.count()
    hot = F.col("group_size") > max(1000, total // HOT_GROUPS)
    first = members.join(F.broadcast(classes.where(hot)), keys, "left")
    done, rest = first.where("group_size is not null"), first.where("group_size is null").select("id", "uid", *keys)
    out = done.unionByName(rest.join(classes.where(~hot), keys))
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    again = members.groupBy("id", *keys).agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("least")).where("n > 1")
    if not again.isEmpty():
        # Rows of one text and one id: the first of them stands for all.
        out = materialise(out)
        again = materialise(again.select(F.col("id").alias("i"), F.col("least"), *[F.col(k).alias(f"k_{k}") for k in keys]))
        out = out.join(again, same(out, again, {"id": "i"} | {k: f"k_{k}" for k in keys}), "left")
        kept = kept & (F.col("least").isNull() | (F.col("least") == F.col("uid")))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "digest")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row of `docs` for each distinct text, the one of the smallest id, with all its columns.

    Rows go by text and id together, so that no text is lost where ids repeat.
    """
    groups = exact_groups(docs, id_col, text_col, salts).select(F.col(id_col).alias("__i"), F.col("digest").alias("__d"), F.col(id_col).eqNullSafe(F.col("keep_id")).alias("first"))
    groups = materialise(groups)
    gone = groups.where("not first").select("__i", "__d").distinct()
    repeats = groups.where("first").groupBy(F.col("__i").alias("__id"), F.col("__d").alias("__digest")).count().where("count > 1")
    rows = docs.select(F.struct("*").alias("__row"), F.col(id_col).alias("__id"), sha256(normalised(text_of(text_col))).alias("__digest"))
    rows = rows.join(gone, same(rows, gone, {"__id": "__i", "__digest": "__d"}), "left_anti")
    return one_of_equal(rows, repeats, ["__id", "__digest"]).select("__row.*")
