"""Release check: participants' ids are masked in text tables, and counts of people are reported with small cells suppressed.

Results of biobank data may leave the workbench only without ids of participants and without counts
of fewer than `least` people. Notes, documents and transcripts that go along with the results hold such
ids in free text. This job reads each text table and the list of participants, finds every run of digits
that is exactly a participant's id, and writes under `output`:

* `masked`: all rows, each id replaced by `mark`, with the numbers of ids and of people found;
  partitioned by table and by the first of its cell columns;
* `report`: per cell the texts, the texts with an id and the people in them; numbers from 1 to
  `least` - 1 are null and `suppressed` is true; partitioned by table.

A run of digits is compared as text, so 007 is not participant 7, and a part of a longer number is no id.
Null texts are empty, null cells are `none`.

Rerun: both tables are replaced, partition by partition for the text tables of the run (dynamic
partition overwrite), so a run over one table leaves the others' results.

Plan: texts and participants meet on the id, after each distinct text has been reduced to its distinct
numbers. An id that many texts hold is a hot key of that join; its other side is unique, so Spark splits
it (adaptive skew join), and no id is gathered: what comes back to a text is at most its own numbers. It
comes back by two hashes of the text. Texts that share both would only share numbers known to be ids,
which changes nothing.

    spark-submit jobs/release_check.py --config jobs/release_check.json --tables data/ --participants ancestry.parquet --output release/
"""

from __future__ import annotations

import os
import sys

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs.common import command, log, read_settings, session_settings
from locusmill.operators.select import keep_matching, require_columns, require_rows, summary_counts

DEFAULTS = {"tables": {"documents": {"id": ["doc_id"], "text": "text", "cell": ["lang", "source"]}}, "participants": {"id": "research_id"}, "mark": "[participant]", "least": 20}
DIGITS = "[0-9]+"

MASKED = "id string, cell_2 string, text string, n_ids long, n_people long, table string, cell_1 string"
REPORT = "cell_1 string, cell_2 string, n_texts long, n_texts_with_ids long, n_people long, suppressed boolean, table string"


def run(spark: SparkSession, tables: str, participants: str, output: str, settings: dict | None = None) -> dict[str, int]:
    """Checks the text tables `tables`/<name>.parquet of the settings; numbers of texts read and of ids masked, by table."""
    settings = DEFAULTS | (settings or {})
    people = spark.read.parquet(participants)
    name = settings["participants"]["id"]
    require_columns(people, [name], "the participants' table")
    people = require_rows(people.select(F.col(f"`{name}`").cast("string").alias("number")).where("number is not null").distinct(), "participants")
    done = {}
    with session_settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        for table, own in settings["tables"].items():
            texts = spark.read.parquet(f"{tables}/{table}.parquet")
            require_columns(texts, [*own["id"], own["text"], *own["cell"]], f"the table {table}")
            done |= {f"{table}.{k}": n for k, n in check_table(texts, people, table, own, output, settings).items()}
    return done


def check_table(texts: DataFrame, people: DataFrame, table: str, own: dict, output: str, settings: dict) -> dict[str, int]:
    """Masks and reports one table."""
    spark = texts.sparkSession
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("none")) for c in own["cell"][:2]] + [F.lit("all")] * (2 - len(own["cell"]))
    row_id = F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("none")) for c in own["id"]])
    rows = texts.select(row_id.alias("id"), cells[0].alias("cell_1"), cells[1].alias("cell_2"), F.coalesce(F.col(f"`{own['text']}`"), F.lit("")).alias("text"))
    found = ids_of_texts(rows, people)
    seen = Observation()
    # Texts without a digit need no partner, so they are not shuffled.
    nothing, digits = F.array().cast("array<string>"), F.col("text").rlike(DIGITS)
    masked = rows.where(digits).withColumns(_key()).join(found, ["__a", "__b"], "left").drop("__a", "__b").withColumn("known", F.coalesce("known", nothing))
    masked = masked.unionByName(rows.where(~digits).withColumn("known", nothing))
    hits = F.filter(F.regexp_extract_all("text", F.lit(DIGITS), F.lit(0)), lambda x: F.array_contains("known", x))
    masked = masked.withColumns({"n_ids": F.size(hits).cast("long"), "n_people": F.size("known").cast("long"), "text": mask(F.col("text"), F.col("known"), settings["mark"])})
    out = masked.drop("known").withColumn("table", F.lit(table)).select("id", "cell_2", "text", "n_ids", "n_people", "table", "cell_1")
    out = out.observe(seen, F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum("n_ids"), F.lit(0)).alias("masked"))
    out.write.mode("overwrite").partitionBy("table", "cell_1").parquet(f"{output}/masked")

    report(rows, found, settings["least"]).withColumn("table", F.lit(table)).write.mode("overwrite").partitionBy("table").parquet(f"{output}/report")
    cells_written = spark.read.schema(REPORT).parquet(f"{output}/report").where(F.col("table") == table).agg(F.count(F.lit(1)), F.count_if("suppressed")).first()
    log.info("%s: %d texts read, %d ids masked, %d cells reported, %d with suppressed counts, in %s", table, seen.get["texts"], seen.get["masked"], *cells_written, output)
    return {"texts": seen.get["texts"], "masked": seen.get["masked"], "cells": cells_written[0], "suppressed": cells_written[1]}


def _key() -> dict[str, Column]:
    return {"__a": F.xxhash64("text"), "__b": F.xxhash64(F.lit(1), "text")}


def ids_of_texts(rows: DataFrame, people: DataFrame) -> DataFrame:
    """(__a, __b, known): for each text with a participant's id, by its hashes, the distinct ids in it."""
    numbers = F.array_distinct(F.regexp_extract_all("text", F.lit(DIGITS), F.lit(0)))
    numbers = rows.where(F.col("text").rlike(DIGITS)).select(*[c.alias(k) for k, c in _key().items()], F.explode(numbers).alias("number"))
    return keep_matching(numbers, people, "number").groupBy("__a", "__b").agg(F.collect_set("number").alias("known"))


def mask(text: Column, known: Column, mark: str) -> Column:
    """The text with each run of digits that is in `known` replaced: pieces between numbers and numbers, put together again."""
    between, numbers = F.split(text, DIGITS, -1), F.regexp_extract_all(text, F.lit(DIGITS), F.lit(0))
    joined = F.zip_with(between, numbers, lambda a, b: F.concat(a, F.when(b.isNull(), "").when(F.array_contains(known, b), mark).otherwise(b)))
    return F.when(F.size(known) == 0, text).otherwise(F.array_join(joined, ""))


def report(rows: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """Per cell: texts, texts with ids, people, small numbers suppressed."""
    cells = ["cell_1", "cell_2"]
    marked = rows.select(*cells, *[c.alias(k) for k, c in _key().items()]).join(found, ["__a", "__b"], "left")
    texts = marked.groupBy(*cells).agg(F.count(F.lit(1)).alias("n_texts"), F.count("known").alias("n_texts_with_ids"))
    # Copies of a text name the same people: one row per cell and text before its ids are laid out.
    people = marked.where("known is not null").dropDuplicates([*cells, "__a", "__b"]).select(*cells, F.explode("known").alias("people"))
    out = texts.join(summary_counts(people, cells, ["people"]).drop("n"), cells, "left").fillna(0, ["n_people"])
    small = {c: F.col(c).between(1, least - 1) for c in ("n_texts_with_ids", "n_people")}
    out = out.withColumn("suppressed", small["n_texts_with_ids"] | small["n_people"])
    return out.withColumns({c: F.when(~small[c], F.col(c)) for c in small})


def read_output(spark: SparkSession, output: str) -> DataFrame:
    """Masked texts and the report's cells as one table, told apart by `part`."""
    texts = spark.read.schema(MASKED).parquet(f"{output}/masked")
    cells = spark.read.schema(REPORT).parquet(f"{output}/report")
    nothing = lambda kind: F.lit(None).cast(kind)
    texts = texts.select(F.lit("text").alias("part"), "table", "cell_1", "cell_2", "id", "text", "n_ids", "n_people", nothing("long").alias("n_texts"), nothing("long").alias("n_texts_with_ids"), nothing("boolean").alias("suppressed"))
    cells = cells.select(F.lit("cell").alias("part"), "table", "cell_1", "cell_2", nothing("string").alias("id"), nothing("string").alias("text"), nothing("long").alias("n_ids"), "n_people", "n_texts", "n_texts_with_ids", "suppressed")
    return texts.unionByName(cells)


if __name__ == "__main__":
    command(
        "release check: mask participants' ids in text tables and report counts with small cells suppressed",
        {"config": "settings, a JSON file", "tables": "folder of the text tables", "participants": "Parquet table of participants", "output": "folder of the results"},
        lambda spark, given: run(spark, given.tables, given.participants, given.output, read_settings(spark, given.config, DEFAULTS)),
    )
