"""Result shards as they arrive: a file stream of the fixed schema, merged batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import IN_CS


def arriving_shards(spark: SparkSession, folder: str, schema=IN_CS, max_files: int = 1000) -> DataFrame:
    """Shards of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def merge_arriving(shards: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends every shard once to the folder `target`, one subfolder per batch, so that a batch run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return shards.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def set_counts(shards: DataFrame) -> DataFrame:
    """Running number of variants per credible set, for monitoring."""
    return shards.groupBy("molecular_trait_id", "cs_id").agg(F.count(F.lit(1)).alias("n"))
