"""Readers of delimited inputs with explicit schemas or names."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import normalize_chr, prefixed_chr, variant_id
from ..operators.reshape import to_long, transpose
from ..operators.select import require_columns
from . import blockgzip
from .anytext import read_any_text

#: Text that means a missing value.
MISSING = ("NA", "", "NaN", "nan")


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", header: bool = True, schema: str | None = None, names: list[str] | None = None, comment: str | None = None) -> DataFrame:
    """A delimited file. With a schema numbers that do not parse become null; without, all columns are text.

    Compression is found by the file's first bytes, not its suffix.
    """
    options = {"sep": sep, "header": header, "nullValue": "NA"} | ({"comment": comment} if comment else {})
    reader = spark.read.options(**options)
    if schema:
        reader = reader.schema(schema)
    if is_gzip(spark, path):
        df = _from_lines(spark, path, reader)
    else:
        df = reader.csv(path)
    return df.toDF(*names) if names else df


def is_gzip(spark: SparkSession, path: str) -> bool:
    """Whether any file at `path` (a file, a folder or a pattern) without a name that ends in .gz starts with gzip's two bytes. Two bytes a file are read, in the JVM, from any store."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for top in fs.globStatus(at) or [] for s in (fs.listStatus(top.getPath()) if top.isDirectory() else [top])]
    for status in found:
        name = status.getPath().getName()
        if status.isDirectory() or name.startswith(("_", ".")) or name.endswith(".gz"):
            continue
        stream = fs.open(status.getPath())
        try:
            if stream.read() == 0x1F and stream.read() == 0x8B:
                return True
        finally:
            stream.close()
    return False


def is_block_gzip(spark: SparkSession, path: str) -> bool:
    """Whether `path` is one file that starts as block-gzip does."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at) or not fs.getFileStatus(at).isFile():
        return False
    stream = fs.open(at)
    try:
        head = bytes(max(0, stream.read()) for _ in range(18))
    finally:
        stream.close()
    return blockgzip.member_size(head) is not None


def _from_lines(spark: SparkSession, path: str, reader) -> DataFrame:
    """Files whose names do not tell what they are: lines by tasks from open streams, parsed by the JVM's reader."""
    lines = read_any_text(spark, path)
    encoder = spark._jvm.org.apache.spark.sql.Encoders.STRING()
    return DataFrame(reader._jreader.csv(getattr(lines._jdf, "as")(encoder)), spark)


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Tab or comma, whichever the first line has more of."""
    first = spark.read.text(path).first()
    line = first["value"] if first else ""
    return "\t" if line.count("\t") >= line.count(",") else ","


def phenotype_matrix(spark: SparkSession, path: str, samples: list[str] | None = None) -> DataFrame:
    """BED matrix: chromosome, position, phenotype_id, then samples; in long form with value."""
    df = read_delimited(spark, path)
    chrom, start, _, name, *rest = df.columns
    keep = [c for c in rest if samples is None or c in samples]
    base = df.select(F.col(f"`{chrom}`").alias("chromosome"), F.col(f"`{start}`").cast("int").alias("position"), F.col(f"`{name}`").alias("phenotype_id"), *[F.col(f"`{c}`").try_cast("double").alias(c) for c in keep])
    return to_long(base, ["chromosome", "position", "phenotype_id"], keep)


def covariates(spark: SparkSession, path: str) -> DataFrame:
    """Covariates in rows, turned to one row per sample."""
    df = read_delimited(spark, path)
    require_columns(df, ["ID"], "the covariate table")
    numbers = [F.col(f"`{c}`").try_cast("double").alias(c) for c in df.columns if c != "ID"]
    return transpose(df.select("ID", *numbers), "ID")


def permutations(spark: SparkSession, path: str) -> DataFrame:
    df = read_delimited(spark, path)
    require_columns(df, ["phenotype_id", "qval"], "the permutation table")
    return df.withColumns({"p_fdr": F.col("qval").try_cast("double"), "group_id": F.col("phenotype_id")})


def variant_list(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path).toDF("variant_id")


def ancestry(spark: SparkSession, path: str) -> DataFrame:
    df = read_delimited(spark, path)
    require_columns(df, ["research_id", "ancestry_pred_other"], "the ancestry table")
    return df.select(F.col("research_id").cast("string").alias("sample_id"), F.col("ancestry_pred_other").alias("ancestry"))


def additional_genotypes(spark: SparkSession, path: str, phenotypes: DataFrame | None = None) -> DataFrame:
    """variant_id, phenotype_id, feature_type, then samples; in long form with dosage."""
    df = read_delimited(spark, path)
    df = df.toDF("variant_id", "phenotype_id", "feature_type", *df.columns[3:])
    samples = df.columns[3:]
    df = df.select(*df.columns[:3], *[F.col(f"`{c}`").try_cast("double").alias(c) for c in samples])
    df = df if phenotypes is None else df.join(phenotypes.select("phenotype_id"), "phenotype_id", "left_semi")
    return to_long(df, ["variant_id", "phenotype_id", "feature_type"], samples, value="dosage")


def dosages(spark: SparkSession, path: str) -> DataFrame:
    """CHROM, POS, REF, ALT, then samples; one row per variant with the array `dosage` in file order.

    A block-gzip file is read by ranges of its blocks (see `blockgzip`), any other as text.
    """
    if is_block_gzip(spark, path):
        return blockgzip.read_dosages(spark, path)
    df = read_delimited(spark, path)
    chrom, pos, ref, alt, *samples = df.columns
    c = lambda n: F.col(f"`{n}`")
    bare = prefixed_chr(normalize_chr(c(chrom)))
    position = c(pos).cast("int")
    return df.select(variant_id(bare, position, c(ref), c(alt)).alias("variant_id"), bare.alias("chromosome"), position.alias("position"), c(ref).alias("ref"), c(alt).alias("alt"), F.array(*[c(s).try_cast("double") for s in samples]).alias("dosage"))


def indexed_dosages(spark: SparkSession, path: str, chromosome: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Dosages from the partitioned folder of sinks.write_dosages; chromosome prunes folders, positions prune row groups."""
    df = spark.read.parquet(path)
    df = df if chromosome is None else df.where(F.col("chromosome") == chromosome)
    return df if start is None else df.where(F.col("position").between(start, end))


def constraint(spark: SparkSession, path: str) -> DataFrame:
    df = read_delimited(spark, path)
    require_columns(df, ["gene_id", "canonical", "lof.pLI"], "the constraint table")
    return df.select("gene_id", F.col("canonical").try_cast("boolean").alias("canonical"), F.col("`lof.pLI`").try_cast("double").alias("pli"))


def regulatory_elements(spark: SparkSession, path: str) -> DataFrame:
    """Headerless: chromosome, start, end, two names, comma-joined types."""
    df = read_delimited(spark, path, header=False)
    a, b, c, _, _, kind, *_ = df.columns
    return df.select(F.col(a).alias("chromosome"), F.col(b).cast("int").alias("start"), F.col(c).cast("int").alias("end"), F.col(kind).alias("type"))


def intervals(spark: SparkSession, path: str) -> DataFrame:
    """Headerless: chromosome, start, end."""
    df = read_delimited(spark, path, header=False)
    a, b, c, *_ = df.columns
    return df.select(F.col(a).alias("chromosome"), F.col(b).cast("int").alias("start"), F.col(c).cast("int").alias("end"))


def frequencies(spark: SparkSession, path: str) -> DataFrame:
    """Variant annotation table; all columns, with the variant as chrom_pos_ref_alt."""
    df = read_delimited(spark, path, sep=sniff_separator(spark, path))
    require_columns(df, ["chrom", "pos", "ref", "alt"], "the frequency table")
    return df.withColumn("variant", variant_id(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")))


def fold_changes(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path).withColumn("ordinal", F.monotonically_increasing_id())


def allele_frequencies(spark: SparkSession, path: str) -> DataFrame:
    df = read_delimited(spark, path)
    require_columns(df, ["ID", "ALT_FREQS"], "the allele-frequency table")
    return df.select(F.regexp_replace("ID", ":", "_").alias("variant"), F.col("ALT_FREQS").try_cast("double").alias("alt_freq"))


def consequences(spark: SparkSession, path: str) -> DataFrame:
    """Headerless: chromosome, position, ref, alt, &-joined terms."""
    df = read_delimited(spark, path, header=False)
    a, b, c, d, e, *_ = df.columns
    return df.select(F.col(a).alias("chromosome"), F.col(b).cast("int").alias("position"), F.col(c).alias("ref"), F.col(d).alias("alt"), F.col(e).alias("terms"))


def genotype_arrays(spark: SparkSession, path: str, samples: list[str]) -> DataFrame:
    """Additional genotypes (variant_id, phenotype_id, feature_type, then samples) as phenotype_id, variant_id, dosage in the order of `samples`."""
    df = read_delimited(spark, path)
    a, b, _, *_ = df.columns
    return df.select(F.col(f"`{b}`").alias("phenotype_id"), F.col(f"`{a}`").alias("variant_id"), F.array(*[F.col(f"`{s}`").try_cast("double") for s in samples]).alias("dosage"))


def sample_list(spark: SparkSession, path: str) -> list[str]:
    """One column with a header; samples are text."""
    return [r[0] for r in read_delimited(spark, path).toDF("sample_id").where("sample_id is not null").toLocalIterator()]
