"""What the jobs share: settings from a small file, log lines, settings of a session that are put back."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger("locusmill.jobs")


def read_settings(spark: SparkSession, path: str | None, defaults: dict) -> dict:
    """The defaults with those of the JSON file at `path` (any store that Spark reads) in their place; unknown names are an error."""
    given = json.loads("".join(r[0] for r in spark.read.text(path, wholetext=True).collect())) if path else {}
    unknown = sorted(set(given) - set(defaults))
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return defaults | given


@contextmanager
def session_settings(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Session settings (dots as double underscores) for the time of the block."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def command(description: str, arguments: dict[str, str], run) -> None:
    """Parses the command line, makes a session, calls run(spark, arguments) and stops the session."""
    parser = argparse.ArgumentParser(description=description)
    for name, text in arguments.items():
        parser.add_argument(f"--{name}", required=name != "config", help=text)
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(description.split(":")[0]).getOrCreate()
    try:
        run(spark, given)
    finally:
        spark.stop()
