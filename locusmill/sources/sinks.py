"""Writers of results and prepared inputs."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: str | None = None) -> None:
    """Parquet with pinned types: with a schema, columns are cast and ordered by it."""
    if schema is not None:
        df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_empty(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """A Parquet folder of the schema without rows."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_text(df: DataFrame, path: str, gz: bool = False, header_if_empty: bool = True) -> None:
    """Tab-separated with header and NA; an empty table still gives its header."""
    writer = df.write.mode("overwrite").options(sep="\t", header=True, nullValue="NA")
    writer = writer.option("compression", "gzip") if gz else writer
    if header_if_empty and df.isEmpty():
        df.sparkSession.createDataFrame([("\t".join(df.columns),)], "value string").coalesce(1).write.mode("overwrite").option("compression", "gzip" if gz else "none").text(path)
        return
    writer.csv(path)


def write_dosages(df: DataFrame, path: str) -> None:
    """Folders per chromosome, sorted by position inside, so that a region reads few row groups."""
    ranged = df.repartitionByRange("chromosome", "position").sortWithinPartitions("chromosome", "position")
    ranged.write.mode("overwrite").partitionBy("chromosome").parquet(path)


def part_order(name: str) -> tuple[int, int, str]:
    """Task and number in the task of a file that Spark wrote; its digits are padded, but not cut, to five and three."""
    task, number = re.match(r"part-(\d+)", name), re.search(r"-c(\d+)[^/]*$", name)
    return int(task[1]) if task else -1, int(number[1]) if number else -1, name


def write_sharded(df: DataFrame, path: str, rows_per_file: int) -> list[str]:
    """Text shards of at most `rows_per_file` rows, each with the header, and their names as a JSON list in <path>.manifest."""
    df.write.mode("overwrite").options(sep="\t", header=True, nullValue="NA", maxRecordsPerFile=rows_per_file).csv(path)
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    names = [f.getPath().getName() for f in found]
    names = [f"{path}/{n}" for n in sorted((n for n in names if n.startswith("part-")), key=part_order)]
    spark.createDataFrame([(json.dumps(names),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.manifest")
    return names


def with_skip_row(df: DataFrame, id_column: str) -> DataFrame:
    """One more row, a copy of the first with the id `skip`, for readers that need two rows."""
    extra = df.limit(1).withColumn(id_column, F.lit("skip"))
    return df.unionByName(extra)


def write_ids(df: DataFrame, column: str, path: str) -> None:
    """Distinct ids in order, one a line."""
    df.select(F.col(column).cast("string").alias("value")).distinct().orderBy("value").write.mode("overwrite").text(path)
