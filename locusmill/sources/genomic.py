"""GTF genes and BigWig scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bigwig import read_bigwig

GTF = "seqid string, source string, type string, start int, end int, score string, strand string, phase string, attributes string"


def gtf(spark: SparkSession, path: str, feature: str | None = "gene") -> DataFrame:
    """Features of a GTF file with gene_id, gene_type and gene_name."""
    df = spark.read.schema(GTF).options(sep="\t", comment="#", quote="").csv(path)
    df = df if feature is None else df.where(F.col("type") == feature)
    attribute = lambda k: F.nullif(F.regexp_extract("attributes", rf'(?:^|;\s*){k} "([^"]*)"', 1), F.lit(""))
    return df.select("seqid", "type", "start", "end", "strand", *[attribute(k).alias(k) for k in ("gene_id", "gene_type", "gene_name")])


def bigwig(spark: SparkSession, path: str, regions: list[tuple[str, int, int]] | None = None) -> DataFrame:
    """(chromosome, start, end, score, ordinal), 1-based closed intervals of a BigWig file (see `bigwig.read_bigwig`).

    With `regions` (chromosome, start, end) only blocks that the file's index places in one of
    them are read; all their intervals come out, so a join on positions gives the same result.
    """
    return read_bigwig(spark, path, regions)
