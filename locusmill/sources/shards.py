"""Result shards: manifests, tolerant reading, union."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .copying import copy_files


def manifest(spark: SparkSession, path: str) -> list[str]:
    """The first token of each line that has one, sorted and each once."""
    rows = spark.read.text(path).select(F.get(F.split(F.trim("value"), r"\s+"), F.lit(0)).alias("p")).where("p <> ''")
    return [r["p"] for r in rows.distinct().orderBy("p").toLocalIterator()]


def read_shards(spark: SparkSession, paths: list[str], schema: T.StructType, strict: bool = True) -> DataFrame:
    """All shards as one table of the given schema; unreadable files and empty ones do not count.

    Columns that a shard lacks are null. An error if nothing is left (`strict`).
    """
    df = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).parquet(*paths)
    if strict and df.isEmpty():
        raise ValueError("every shard is empty or unreadable")
    return df


def concatenate(spark: SparkSession, paths: list[str], sep: str = "\t") -> DataFrame:
    """Text shards with the same header as one table, rows in the order of `paths` and of the lines.

    The order is that of the result's range partitions, so a writer keeps it file by file.
    """
    order = spark.createDataFrame([(p, i) for i, p in enumerate(_whole_paths(spark, paths))], "__path string, __shard int")
    df = spark.read.options(sep=sep, header=True, nullValue="NA").csv(paths)
    names = df.columns
    file = _one_slash(F.col("_metadata.file_path"))
    rows = df.select("*", file.alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__row"))
    # A row per path. A path is a file or a folder of files.
    files, folders = order.toDF("__f", "__in_file"), order.toDF("__d", "__in_folder")
    rows = rows.join(F.broadcast(files), F.col("__file") == F.col("__f"), "left").join(F.broadcast(folders), _folder(F.col("__file")) == F.col("__d"), "left")
    # Files of a folder by task and number, as Spark counts on beyond the digits it pads to.
    number = lambda pattern: F.regexp_extract(F.regexp_extract("__file", "[^/]*$", 0), pattern, 1).try_cast("long")
    return rows.orderBy(F.coalesce("__in_file", "__in_folder"), number(r"^part-(\d+)"), number(r"-c(\d+)[^/]*$"), "__file", "__start", "__row").select(*names)


def _whole_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Each path with its scheme and folder, as Spark names files; a path twice is an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        out.append(re.sub("^file:/+", "file:/", at.getFileSystem(conf).makeQualified(at).toUri().toString()))
    if len(set(out)) < len(out):
        raise ValueError("a shard is listed twice")
    return out


def _one_slash(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def manifest_list(spark: SparkSession, path: str) -> list[str]:
    """The paths of a JSON manifest (sinks.write_sharded)."""
    return json.loads("".join(r[0] for r in spark.read.text(path).collect()))


def skipped_shards(spark: SparkSession, paths: list[str], schema: T.StructType) -> list[str]:
    """Paths that gave no row."""
    seen = read_shards(spark, paths, schema, False).select(_one_slash(F.col("_metadata.file_path")).alias("f")).distinct()
    given = spark.createDataFrame(list(zip(_whole_paths(spark, paths), range(len(paths)))), "p string, i int")
    seen = seen.select(F.explode(F.array("f", _folder(F.col("f")))).alias("p"))
    return [paths[r["i"]] for r in given.join(seen, "p", "left_anti").orderBy("i").toLocalIterator()]


def files_under(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files below a folder, by Spark's file source, without their contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def copy_shards(spark: SparkSession, paths: list[str], folder: str, tasks: int = 64) -> DataFrame:
    """Copies the shards of a manifest into one folder, by tasks (see `copying`); the result, a row per file, is kept under <folder>.copies.

    Names keep their order and stay apart where shards of several folders have the same.
    """
    pairs = spark.createDataFrame([(p, f"{folder}/{i:06d}-{p.rstrip('/').rsplit('/', 1)[-1]}") for i, p in enumerate(paths)], "source string, target string")
    copy_files(pairs, tasks).write.mode("overwrite").parquet(f"{folder}.copies")
    return spark.read.parquet(f"{folder}.copies")
