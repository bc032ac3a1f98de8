"""The folder that the driver and all executors share, for tables that cut a plan's lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a folder of its own only where none is set, which is right on one machine alone."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        there = f"file://{tempfile.mkdtemp(prefix='locusmill-')}"
        spark.sparkContext.setCheckpointDir(there)
    return there.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet in the shared folder and read back: a lost executor costs a re-read, not a re-computation."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with_count(df: DataFrame, condition) -> tuple[DataFrame, int]:
    """`stored(df)` and how many of its rows meet the condition, counted while they are written."""
    seen = Observation()
    out = stored(df.observe(seen, F.count_if(condition).alias("n")))
    return out, seen.get["n"]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may be gone already
        pass
