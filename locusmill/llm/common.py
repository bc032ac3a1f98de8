"""What the corpus operators share: table access, the shared folder, native word expressions."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words as every contract here has them: ASCII space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: `spark.checkpoint.dir` of the session.

    A folder of its own is made only where none is set, which is right on one machine alone.
    """
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        there = f"file://{tempfile.mkdtemp(prefix='locusmill-')}"
        spark.sparkContext.setCheckpointDir(there)
    return there.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, so that a lost executor costs a re-read and not a re-computation. The
    table is removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may be gone already
        pass


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def n_words(text: Column) -> Column:
    """How many words a text has, as a long."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def content_key(text: Column) -> list[Column]:
    """Two 64-bit hashes of a text; with the id they tell rows apart, and rows that agree in all three are equal rows."""
    return [F.xxhash64(text), F.xxhash64(F.lit(29), text)]


def same(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """All named columns are equal, null to null."""
    out = F.lit(True)
    for a, b in pairs.items():
        out = out & left[a].eqNullSafe(right[b])
    return out


def one_of_equal(rows: DataFrame, repeats: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with one row for each key of `repeats` (distinct), and all rows of any other key.

    Equal rows are dropped on the map side first, so a key that holds much of the input leaves one row a task.
    """
    if repeats.isEmpty():
        return rows
    marked = repeats.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)], F.lit(True).alias("__again"))
    both = rows.join(marked, same(rows, marked, {k: f"__r{i}" for i, k in enumerate(keys)}), "left").select(*rows.columns, "__again")
    some = both.where("__again").dropDuplicates(keys)
    return both.where("__again is null").unionByName(some).drop("__again")


def crc_bucket(column: str, mod: int) -> Column:
    """crc32 of an id written as text, modulo `mod`; null ids fall in bucket -1."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(mod)), F.lit(-1))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, keep: Column, bound: int, id_col: str = "doc_id") -> DataFrame:
    """Rows of `docs` with their label (0 or 1), of the ids that `keep` accepts.

    The labelled ids go to the documents by broadcast, so they are bounded: beyond `bound` ids, a
    sample of about that many by a hash of the id is used. Ids that repeat take the larger label,
    null labels and null ids are left out.
    """
    own = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & keep)
    own = own.groupBy(F.col(id_col).alias("__id")).agg((F.max(label) > 0).cast("int").alias("label"))
    n = own.count()
    if n > bound:
        own = own.where(F.pmod(F.xxhash64("__id", F.lit(11)), F.lit(1_000_000)) < int(1_000_000 * bound / n))
    return docs.join(F.broadcast(own), docs[id_col] == F.col("__id")).drop("__id")


def hot_join(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int, hot_keys: int = 2000, least: int = 1000) -> DataFrame:
    """Inner join on `key` (unique in table, never null); keys with `weight` above `least` and total / hot_keys go by broadcast.

    With weights that add up to `total` there are at most `hot_keys` of these.
    """
    hot = F.col(weight) > max(least, total // hot_keys)
    columns = [*rows.columns, *[c for c in table.columns if c != key]]
    first = rows.join(F.broadcast(table.where(hot).withColumn("__hot", F.lit(True))), key, "left")
    cold = first.where("__hot is null").select(*rows.columns).join(table.where(~hot), key)
    return first.where("__hot").select(*columns).unionByName(cold.select(*columns))
