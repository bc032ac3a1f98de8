"""Result feed: association results are merged as their shards arrive, and the best variant of each trait is kept up to date.

Fine-mapping runs finish trait by trait over days, each leaving a shard of results. This job takes
the shards that are new since its last run (a file stream with a checkpoint), and writes under
`output`, all partitioned by chromosome:

* `rows`: every result once, also where a shard is delivered again under another name;
* `parts`: for each batch and trait the number of its new rows and the best of them;
* `traits`: per trait the number of results, the best score and its variant (ties: the smaller id);
* `snapshots`: a copy of `traits` after each `snapshot_every` batches;
* `rejected`: rows without trait, variant, chromosome or score, with the reason.

Reruns are safe. A batch that is run again after a failure writes to the same folders of its number
(dynamic partition overwrite), compares its rows with those of other batches only, and `traits` is
made anew, for the chromosomes that the batch touches, from the last snapshot before the batch and the
sums of the batches since. A run without new shards writes nothing.

What a batch costs: its own rows are compared with the stored rows of its chromosomes by a join on
the row's key; totals come from a snapshot, one row per trait, and at most `snapshot_every` batches of `parts`,
however long the feed has run. Nothing is gathered on the driver but the number of a snapshot and the names of the chromosomes of a batch, at most `max_chromosomes`, beyond which the batch is an error.

    spark-submit jobs/result_feed.py --config jobs/result_feed.json --input shards/ --output merged/ --checkpoint feed-state/
"""

from __future__ import annotations

import os
import sys

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import command, log, read_settings, session_settings
from locusmill.operators.select import first_per_key, require_columns
from locusmill.streaming.shards import arriving_shards

DEFAULTS = {"trait": "molecular_trait_id", "variant": "variant", "score": "pip", "chromosome": "chromosome", "files_per_batch": 1000, "max_chromosomes": 1000, "snapshot_every": 50}

ROWS = "trait string, variant string, score double, chromosome string, batch long"
PARTS = "trait string, n_results long, best_variant string, best_score double, chromosome string, batch long"
SNAPSHOTS = "trait string, n_results long, best_variant string, best_score double, chromosome string, at long"
TRAITS = "trait string, n_results long, best_variant string, best_score double, chromosome string"
REJECTED = "trait string, variant string, score double, chromosome string, reason string, batch long"


def run(spark: SparkSession, input: str, output: str, checkpoint: str, settings: dict | None = None) -> dict[str, int]:
    """Takes the shards of the folder (or file, or pattern) `input` that are new to `checkpoint`; numbers of rows read, stored and rejected."""
    settings = DEFAULTS | (settings or {})
    schema = spark.read.parquet(input).schema
    shards = arriving_shards(spark, _stream_path(spark, input), schema, settings["files_per_batch"])
    require_columns(shards, [settings[k] for k in ("trait", "variant", "score", "chromosome")], "the result table")
    done = {"read": 0, "stored": 0, "rejected": 0, "batches": 0}

    def take(batch: DataFrame, number: int) -> None:
        found = take_batch(batch, number, output, settings)
        log.info("batch %d of %s: %d rows read, %d stored, %d rejected", number, input, found["read"], found["stored"], found["rejected"])
        for k, n in (found | {"batches": 1}).items():
            done[k] += n

    with session_settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        stream = shards.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        stream.awaitTermination()
    log.info("%s: %d batches, %d rows read, %d stored in %s, %d rejected", input, done["batches"], done["read"], done["stored"], output, done["rejected"])
    return done


def _stream_path(spark: SparkSession, path: str) -> str:
    """A file stream takes folders and patterns: one file becomes the pattern that only it matches."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not any(c in path for c in "*?[{") and fs.exists(at) and fs.getFileStatus(at).isFile():
        folder, _, name = path.rpartition("/")
        return f"{folder}/{{{name}}}" if folder else f"{{{name}}}"
    return path


def take_batch(batch: DataFrame, number: int, output: str, settings: dict) -> dict[str, int]:
    """Stores one batch; the same batch again leaves the same files."""
    spark = batch.sparkSession
    c = {k: F.col(f"`{settings[k]}`") for k in ("trait", "variant", "score", "chromosome")}
    rows = batch.select(
        c["trait"].cast("string").alias("trait"), c["variant"].cast("string").alias("variant"),
        c["score"].try_cast("double").alias("score"), c["chromosome"].cast("string").alias("chromosome"),
    ).persist()
    try:
        checked = rows.withColumn("reason", _reason())
        totals = checked.agg(F.count(F.lit(1)), F.count("reason")).first()
        if totals[1]:
            checked.where("reason is not null").withColumn("batch", F.lit(number)).write.mode("overwrite").partitionBy("batch").parquet(f"{output}/rejected")
        good = checked.where("reason is null").drop("reason").distinct()
        touched = good.select("chromosome").distinct().limit(settings["max_chromosomes"] + 1).collect()
        if len(touched) > settings["max_chromosomes"]:
            raise ValueError(f"batch {number} has more than {settings['max_chromosomes']} chromosomes")
        if not touched:
            return {"read": totals[0], "stored": 0, "rejected": totals[1]}
        own = F.col("chromosome").isin([r[0] for r in touched])

        stored = _table(spark, f"{output}/rows", ROWS)
        if stored is not None:
            # Of the chromosomes at hand, and never the rows of this batch from a run that failed.
            good = good.join(stored.where(own & (F.col("batch") != number)).drop("batch"), ["trait", "variant", "score", "chromosome"], "left_anti")
        good.withColumn("batch", F.lit(number)).repartition("chromosome", F.hash("trait")).write.mode("overwrite").partitionBy("chromosome", "batch").parquet(f"{output}/rows")

        new = _table(spark, f"{output}/rows", ROWS).where(own & (F.col("batch") == number))
        _best(new, F.lit(1), "variant", "score").withColumn("batch", F.lit(number)).write.mode("overwrite").partitionBy("chromosome", "batch").parquet(f"{output}/parts")
        snapshots, last = _table(spark, f"{output}/snapshots", SNAPSHOTS), None
        if snapshots is not None:
            last = snapshots.select("at").distinct().where(F.col("at") < number).agg(F.max("at")).first()[0]
        sums = _table(spark, f"{output}/parts", PARTS).where(own & (F.col("batch") <= number) & (F.col("batch") > (-1 if last is None else last))).drop("batch")
        if last is not None:
            sums = sums.unionByName(snapshots.where(own & (F.col("at") == last)).drop("at"))
        _best(sums, F.col("n_results"), "best_variant", "best_score").write.mode("overwrite").partitionBy("chromosome").parquet(f"{output}/traits")
        if (number + 1) % settings["snapshot_every"] == 0:
            whole = _table(spark, f"{output}/traits", TRAITS)
            whole.withColumn("at", F.lit(number)).write.mode("overwrite").partitionBy("at", "chromosome").parquet(f"{output}/snapshots")
        return {"read": totals[0], "stored": new.count(), "rejected": totals[1]}
    finally:
        rows.unpersist()


def _reason():
    missing = [F.when(F.col(k).isNull() | (F.col(k) == ""), F.lit(f"no {k}")) for k in ("trait", "variant", "chromosome")]
    return F.coalesce(*missing, F.when(F.col("score").isNull() | F.isnan("score"), F.lit("no score")))


def _best(rows: DataFrame, n, variant: str, score: str) -> DataFrame:
    """Per chromosome and trait: results, the best variant and its score. Both aggregates combine on the map side."""
    rows = rows.select("chromosome", "trait", n.cast("long").alias("n_results"), F.col(variant).alias("best_variant"), F.col(score).alias("best_score"))
    keys = ["chromosome", "trait"]
    best = first_per_key(rows.drop("n_results"), keys, [-F.col("best_score"), "best_variant"])
    sums = rows.groupBy(*keys).agg(F.sum("n_results").alias("n_results"))
    return sums.join(best, keys).select("trait", "n_results", "best_variant", "best_score", "chromosome")


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table at `path`, with text for its partitions; None where none has been written yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.schema(schema).parquet(path)


def read_output(spark: SparkSession, output: str) -> DataFrame:
    """All that the job keeps, one row per stored result, trait and rejected row, told apart by `part`."""
    frames = [
        (f"{output}/rows", ROWS, "row", {"n": F.lit(1)}),
        (f"{output}/traits", TRAITS, "trait", {"variant": F.col("best_variant"), "score": F.col("best_score"), "n": F.col("n_results")}),
        (f"{output}/rejected", REJECTED, "rejected", {"n": F.lit(1)}),
    ]
    out = None
    for path, schema, part, columns in frames:
        df = _table(spark, path, schema)
        if df is None:
            df = spark.createDataFrame([], schema)
        df = df.withColumns(columns).withColumn("part", F.lit(part))
        df = df.withColumn("reason", F.col("reason") if "reason" in df.columns else F.lit(None).cast("string"))
        df = df.select("part", "chromosome", "trait", "variant", "score", F.col("n").cast("long").alias("n"), "reason")
        out = df if out is None else out.unionByName(df)
    return out


if __name__ == "__main__":
    command(
        "result feed: merge association results as their shards arrive",
        {"config": "settings, a JSON file", "input": "folder of Parquet shards", "output": "folder of the merged tables", "checkpoint": "folder of the stream's state"},
        lambda spark, given: run(spark, given.input, given.output, given.checkpoint, read_settings(spark, given.config, DEFAULTS)),
    )
