"""Registered queries of sources and sinks: tables are written to the shared folder by a sink and read back by a reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..operators import annotate, crossval
from ..schemas import SKEW
from ..sources import bigwig, blockgzip, copying, genomic, shards, sinks, tables
from . import queries as Q
from .queries import big, query, r6, scratch_folder, table


def _text(df: DataFrame, header: bool = True, gz: bool = False, suffix: str = "tsv", folder: str | None = None) -> str:
    """Writes tab-separated text to a new folder of the shared folder, or one below `folder`; its path."""
    path = f"{folder}/{suffix}" if folder else f"{scratch_folder(df.sparkSession)}.{suffix}"
    writer = df.write.options(sep="\t", header=header, nullValue="NA", quote="")
    (writer.option("compression", "gzip") if gz else writer).csv(path)
    return path


@query("SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders")
def scan_typed(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("o_orderpriority"))
    path = scratch_folder(spark)
    sinks.write_text(o, path)
    return tables.read_delimited(spark, path, schema="o_orderkey long, o_totalprice double, o_orderpriority string")


@query("SELECT s_suppkey::VARCHAR AS a, s_name AS b FROM supplier")
def scan_headerless(spark, d):
    path = _text(table(spark, d, "supplier").select("s_suppkey", "s_name"), header=False)
    return tables.read_delimited(spark, path, header=False, names=["a", "b"])


@query("SELECT p_partkey::VARCHAR AS k, p_name AS name FROM part")
def scan_gzip(spark, d):
    """Compressed text, found by its first bytes in files without a suffix for it."""
    path = _text(table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name")), gz=True)
    _rename(spark, path, ".csv.gz", ".bgz")
    return tables.read_delimited(spark, f"{path}/*.bgz")


def _rename(spark: SparkSession, path: str, old: str, new: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(at):
        if f.getPath().getName().endswith(old):
            fs.rename(f.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f.getPath().getName().removesuffix(old) + new))


@query("SELECT '\t' AS sep")
def separator(spark, d):
    path = _text(table(spark, d, "nation"))
    return spark.createDataFrame([(tables.sniff_separator(spark, path),)], "sep string")


@query("""SELECT 'chr' || n_regionkey AS chromosome, n_nationkey * 10 AS position, n_name AS phenotype_id, s AS sample_id, v AS value FROM (SELECT *, unnest(['s1', 's2']) AS s, unnest([n_nationkey / 4.0::DOUBLE, NULL]) AS v FROM nation)""")
def bed_matrix(spark, d):
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    wide = n.select(F.concat(F.lit("chr"), "n_regionkey").alias("#chr"), (k * 10).alias("start"), (k * 10 + 1).alias("end"), F.col("n_name").alias("id"), (k / 4).alias("s1"), F.lit(None).cast("double").alias("s2"))
    return tables.phenotype_matrix(spark, _text(wide))


@query("SELECT x AS sample_id, max(n_nationkey + i) FILTER (n_nationkey = 5)::DOUBLE AS c5, max(n_nationkey * i) FILTER (n_nationkey = 7)::DOUBLE AS c7 FROM nation, (SELECT unnest(['s1', 's2']) AS x, unnest([1, 2]) AS i) GROUP BY 1")
def covariate_table(spark, d):
    k = F.col("n_nationkey")
    value = lambda i: F.when(k == 5, k + i).otherwise(k * i).alias(f"s{i}")
    # Each covariate is a column of the result; these are two of the nations.
    return tables.covariates(spark, _text(table(spark, d, "nation").select(F.concat(F.lit("c"), k).alias("ID"), value(1), value(2)))).select("sample_id", "c5", "c7")


@query(f"SELECT phenotype_id, round(qval, 6) AS p_fdr, phenotype_id AS group_id FROM ({Q.PHENOTYPES})")
def permutation_table(spark, d):
    path = _text(Q._phenotypes(spark, d).select("phenotype_id", "qval"))
    return tables.permutations(spark, path).select("phenotype_id", r6(F.col("p_fdr")).alias("p_fdr"), "group_id")


@query("SELECT DISTINCT 'v' || p_size AS variant_id FROM part")
def variant_allowlist(spark, d):
    return tables.variant_list(spark, _text(table(spark, d, "part").select(F.concat(F.lit("v"), "p_size").alias("x")).distinct()))


@query("SELECT c_custkey::VARCHAR AS sample_id, c_mktsegment AS ancestry FROM customer")
def ancestry_table(spark, d):
    return tables.ancestry(spark, _text(table(spark, d, "customer").select(F.col("c_custkey").alias("research_id"), F.col("c_mktsegment").alias("ancestry_pred_other"))))


@query("""SELECT 'sv' || p_partkey AS variant_id, 'p' || p_size AS phenotype_id, 'sv' AS feature_type, s AS sample_id, v AS dosage FROM (SELECT *, unnest(['a', 'b']) AS s, unnest([p_partkey % 3, p_size % 2])::DOUBLE AS v FROM part) WHERE p_size % 2 = 0""")
def additional_genotypes(spark, d):
    p = table(spark, d, "part")
    wide = p.select(F.concat(F.lit("sv"), "p_partkey").alias("id"), F.concat(F.lit("p"), "p_size").alias("gene"), F.lit("sv").alias("kind"), (F.col("p_partkey") % 3).alias("a"), (F.col("p_size") % 2).alias("b"))
    wanted = p.where("p_size % 2 = 0").select(F.concat(F.lit("p"), "p_size").alias("phenotype_id")).distinct()
    return tables.additional_genotypes(spark, _text(wide), wanted)


@query("SELECT c_custkey::VARCHAR AS sample_id, (c_custkey % 5 + 1)::INT AS fold, CASE WHEN c_custkey % 2 = 0 THEN 'train' ELSE 'test' END AS split, round(c_acctbal, 2) AS pc FROM customer")
def cv_metadata(spark, d):
    c = table(spark, d, "customer")
    key = F.col("c_custkey").cast("string").alias("sample_id")
    fold = (F.col("c_custkey") % 5 + 1).cast("int").alias("fold")
    split = F.when(F.col("c_custkey") % 2 == 0, "train").otherwise("test").alias("split")
    path = scratch_folder(spark)
    crossval.write_cv(c.select(fold, split, key, F.array(F.round("c_acctbal", 2)).alias("pcs")), c.select(key, fold), path)
    folds, components = crossval.read_cv(spark, path)
    return folds.join(components, ["sample_id", "fold"]).select("sample_id", "fold", "split", F.get("pcs", F.lit(0)).alias("pc"))


@query("SELECT variant_id, dosage[1] AS first, len(dosage) AS n FROM (SELECT 'chr' || (p_partkey % 3) || '_' || p_partkey || '_A_G' AS variant_id, p_partkey AS position, p_partkey % 3 AS c, [(p_partkey % 4 - 1)::DOUBLE, 2.0::DOUBLE] AS dosage FROM part) WHERE c = 1 AND position BETWEEN 100 AND 1500")
def dosage_region(spark, d):
    """Dosage text to the folders by chromosome, of which one region is read."""
    k = F.col("p_partkey")
    wide = table(spark, d, "part").select(F.concat(F.lit("chr"), k % 3).alias("CHROM"), k.alias("POS"), F.lit("A").alias("REF"), F.lit("G").alias("ALT"), (k % 4 - 1).alias("s1"), F.lit(2).alias("s2"))
    path = scratch_folder(spark)
    sinks.write_dosages(tables.dosages(spark, _text(wide)), path)
    found = tables.indexed_dosages(spark, path, "chr1", 100, 1500)
    return found.select("variant_id", F.get("dosage", F.lit(0)).alias("first"), big(F.size("dosage")).alias("n"))


@query("SELECT p_partkey::VARCHAR AS k, p_name AS name, (p_partkey % 3)::INT AS kind FROM part")
def scan_mixed_files(spark, d):
    """One folder of plain and gzip files whose names do not tell which is which."""
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(k.alias("k"), F.col("p_name").alias("name"), (k % 3).cast("int").alias("kind"))
    folder = scratch_folder(spark)
    for i in range(3):
        _text(rows.where(F.col("kind") == i), gz=i > 0, suffix=f"{i}", folder=f"{folder}-parts")
    copies = shards.files_under(spark, f"{folder}-parts").select(F.col("path").alias("source"), F.format_string(f"{folder}/%04d", F.row_number().over(W.Window.orderBy("path"))).alias("target"))
    copying.copy_files(copies, 4).write.format("noop").mode("overwrite").save()
    return tables.read_delimited(spark, folder, schema="k string, name string, kind int")


REGIONS = [("chr0", 60, 400), ("chr1", 100, 900), ("chr1", 850, 1500), ("chr7", 1, 10)]


@query("""SELECT 'chr' || (p_partkey % 3) || '_' || p_partkey || '_A_G' AS variant_id, p_partkey AS position, CASE WHEN p_partkey % 4 <> 3 THEN (p_partkey % 4)::DOUBLE END AS first, 2::BIGINT AS n
    FROM part WHERE (p_partkey % 3 = 0 AND p_partkey BETWEEN 60 AND 400) OR (p_partkey % 3 = 1 AND p_partkey BETWEEN 100 AND 1500)""")
def dosage_index_regions(spark, d):
    """Dosage text in block-gzip files with indexes, of which the blocks of some regions are read."""
    k = F.col("p_partkey")
    dosage = F.array(F.when(k % 4 != 3, (k % 4).cast("double")), F.lit(2.0))
    rows = table(spark, d, "part").select(F.concat(F.lit("chr"), k % 3).alias("chromosome"), k.alias("position"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), dosage.alias("dosage"))
    path = scratch_folder(spark)
    blockgzip.write_dosages(rows, path, ["s1", "s2"]).write.format("noop").mode("overwrite").save()
    found = blockgzip.read_dosages(spark, path, REGIONS)
    return found.select("variant_id", big(F.col("position")).alias("position"), F.get("dosage", F.lit(0)).alias("first"), big(F.size("dosage")).alias("n"))


@query("""WITH t AS (SELECT 'chr' || (o_custkey % 3) AS chromosome, o_orderkey * 40 + 1 AS a, o_orderkey * 40 + 25 AS b, (o_orderkey % 256) / 4.0 AS score FROM orders)
    SELECT chromosome, a AS "start", b AS "end", score::DOUBLE AS score FROM t WHERE (chromosome = 'chr0' AND a <= 90000 AND b >= 20000) OR (chromosome = 'chr2' AND a <= 5000)""")
def score_track_regions(spark, d):
    """Scores to files of blocks with a tree over them, of which the blocks of two regions are read."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.concat(F.lit("chr"), F.col("o_custkey") % 3).alias("chromosome"), (k * 40 + 1).alias("start"), (k * 40 + 25).alias("end"), (k % 256 / 4).alias("score"))
    path = scratch_folder(spark)
    bigwig.write_bigwig(rows, path, 100).write.format("noop").mode("overwrite").save()
    found = bigwig.read_bigwig(spark, path, [("chr0", 20000, 90000), ("chr2", 1, 5000)])
    inside = ((F.col("chromosome") == "chr0") & (F.col("start") <= 90000) & (F.col("end") >= 20000)) | ((F.col("chromosome") == "chr2") & (F.col("start") <= 5000))
    return found.where(inside).select("chromosome", big(F.col("start")).alias("start"), big(F.col("end")).alias("end"), "score")


@query("SELECT 'ENSG' || p_partkey || '.2' AS gene_id, p_brand AS gene_name, p_size AS \"start\", p_size + 100 AS \"end\" FROM part WHERE p_partkey % 2 = 0")
def gtf_genes(spark, d):
    k = F.col("p_partkey")
    note = F.concat(F.lit('gene_id "ENSG'), k, F.lit('.2"; gene_type "x"; gene_name "'), F.col("p_brand"), F.lit('"'))
    rows = table(spark, d, "part").select(F.lit("chr1"), F.lit("havana"), F.when(k % 2 == 0, "gene").otherwise("exon"), "p_size", F.col("p_size") + 100, F.lit("."), F.lit("+"), F.lit("."), note)
    return genomic.gtf(spark, _text(rows, header=False)).select("gene_id", "gene_name", "start", "end")


@query("SELECT p_partkey::VARCHAR AS gene_id, p_size % 2 = 0 AS canonical, p_size / 50.0::DOUBLE AS pli FROM part")
def constraint_table(spark, d):
    return tables.constraint(spark, _text(table(spark, d, "part").select(F.col("p_partkey").alias("gene_id"), (F.col("p_size") % 2 == 0).alias("canonical"), (F.col("p_size") / 50.0).alias("lof.pLI"))))


@query("SELECT p_brand AS chromosome, p_size AS \"start\", p_size + 9 AS \"end\", p_type AS type FROM part")
def regulatory_table(spark, d):
    rows = table(spark, d, "part").select("p_brand", "p_size", F.col("p_size") + 9, "p_partkey", "p_name", "p_type")
    return tables.regulatory_elements(spark, _text(rows, header=False))


@query("SELECT p_brand AS chromosome, p_size AS \"start\", p_size + 9 AS \"end\" FROM part")
def interval_table(spark, d):
    return tables.intervals(spark, _text(table(spark, d, "part").select("p_brand", "p_size", F.col("p_size") + 9, "p_name"), header=False))


@query("SELECT 'chr' || (p_size % 3) || '_' || p_partkey || '_A_T' AS variant, (p_size / 50.0::DOUBLE)::VARCHAR AS af FROM part")
def frequency_table(spark, d):
    rows = table(spark, d, "part").select(F.concat(F.lit("chr"), F.col("p_size") % 3).alias("chrom"), F.col("p_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("T").alias("alt"), (F.col("p_size") / 50.0).alias("af"))
    return tables.frequencies(spark, _text(rows)).select("variant", "af")


@query("SELECT 'chr1_' || p_partkey AS variant, p_size / 64.0::DOUBLE AS alt_freq FROM part")
def allele_frequency_table(spark, d):
    return tables.allele_frequencies(spark, _text(table(spark, d, "part").select(F.concat(F.lit("chr1:"), "p_partkey").alias("ID"), (F.col("p_size") / 64.0).alias("ALT_FREQS"))))


@query("SELECT p_partkey, p_size % 2 = 0 AS missense, p_size % 2 = 1 AS stop_gained FROM part")
def consequence_join(spark, d):
    """Consequence text, widened and joined to the variants."""
    p = table(spark, d, "part")
    place = [F.lit("chr1").alias("chromosome"), F.col("p_partkey").cast("int").alias("position"), F.lit("A").alias("ref"), F.lit("G").alias("alt")]
    path = _text(p.select(F.lit("1"), "p_partkey", F.lit("A"), F.lit("G"), F.when(F.col("p_size") % 2 == 0, "missense&intron").otherwise("stop_gained")), header=False)
    return annotate.add_consequences(p.select("p_partkey", *place), tables.consequences(spark, path)).select("p_partkey", "missense", "stop_gained")


@query("SELECT DISTINCT 'f' || o_orderstatus AS path FROM orders")
def shard_manifest(spark, d):
    path = scratch_folder(spark)
    table(spark, d, "orders").select(F.concat(F.lit(" f"), "o_orderstatus", F.lit("  x")).alias("value")).write.text(path)
    return spark.createDataFrame([(p,) for p in shards.manifest(spark, path)], "path string")


@query("SELECT p_partkey::VARCHAR AS k, row_number() OVER (ORDER BY p_partkey) AS row FROM part")
def shard_gather(spark, d):
    """Row shards with their manifest, then one table in the order of the shards and their lines."""
    path = scratch_folder(spark)
    sinks.write_sharded(table(spark, d, "part").select(F.col("p_partkey").alias("k")).orderBy("k").coalesce(1), path, 300)
    whole = shards.concatenate(spark, shards.manifest_list(spark, f"{path}.manifest"))
    rows = whole.withColumn("__place", F.monotonically_increasing_id())
    from ..operators.chunks import numbered

    return numbered(rows, ["__place"]).select("k", big(F.col("row")).alias("row"))


@query("SELECT DISTINCT s_nationkey::VARCHAR AS id FROM supplier")
def id_list(spark, d):
    path = scratch_folder(spark)
    sinks.write_ids(table(spark, d, "supplier"), "s_nationkey", path)
    return spark.read.text(path).select(F.col("value").alias("id"))


@query(f"SELECT unnest({SKEW.fieldNames()}) AS name, unnest({[f.dataType.simpleString() for f in SKEW]}) AS kind")
def empty_schema(spark, d):
    """An empty result keeps its schema."""
    path = scratch_folder(spark)
    sinks.write_empty(spark, path, SKEW)
    return spark.createDataFrame(spark.read.parquet(path).dtypes, "name string, kind string")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_partkey || chr(9) || p_name || chr(9) || p_brand, '^[0-9]+5\t.*Brand#1')")
def phenotype_match_line(spark, d):
    from ..operators import select

    return select.match_phenotypes(table(spark, d, "part").select("p_partkey", "p_name", "p_brand"), "p_name", "^[0-9]+5\t.*Brand#1", "line").select("p_partkey", "p_name")
