"""Registered queries: each applies one operator to the driver's tables, with DuckDB SQL beside it.

Stand-ins: phenotypes are orders or parts, clusters and genes are customers and brands, a p-value
is a scaled number, a chromosome is a key modulo 22, samples are suppliers and dosages are small
integers made of quantities (-1 where missing).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions import keys as K
from ..functions import numeric as N
from ..operators import annotate, blockfit, chunks, components, crossval, finemap, genotypes, graph, intervals, reshape, select, skew, sweep
from ..sources import shards, sinks
from ..sources.shared import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column) -> Column:
    return F.round(c, 6)


def big(c: Column) -> Column:
    return c.cast("long")


# ---------------------------------------------------------------- choosing rows
@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#13'")
def phenotype_match_exact(spark, d):
    return select.match_phenotypes(table(spark, d, "part"), "p_brand", "Brand#13").select("p_partkey", "p_name", "p_brand")


@query("SELECT p_partkey, p_type FROM part WHERE contains(p_type, 'AL')")
def phenotype_match_contains(spark, d):
    return select.match_phenotypes(table(spark, d, "part"), "p_type", "AL", "contains").select("p_partkey", "p_type")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^small.*g')")
def phenotype_match_regex(spark, d):
    return select.match_phenotypes(table(spark, d, "part"), "p_name", "^small.*g", "regex").select("p_partkey", "p_name")


def _phenotypes(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    q = F.when(F.col("o_orderkey") % 17 != 0, ((F.col("o_orderkey") * 7919) % 10007) / 10007.0)
    return o.select(F.concat(F.lit("clu_"), F.col("o_custkey"), F.lit(":"), F.col("o_orderkey")).alias("phenotype_id"), q.alias("qval"), "o_custkey", "o_orderkey")


PHENOTYPES = "SELECT 'clu_' || o_custkey || ':' || o_orderkey AS phenotype_id, CASE WHEN o_orderkey % 17 <> 0 THEN ((o_orderkey * 7919) % 10007) / 10007.0::DOUBLE END AS qval, o_custkey, o_orderkey FROM orders"


@query(f"""WITH p AS ({PHENOTYPES}), t AS (SELECT 'clu_' || o_custkey AS cluster_id, phenotype_id, qval,
    row_number() OVER (PARTITION BY o_custkey ORDER BY qval NULLS LAST, phenotype_id) AS rn FROM p WHERE qval < 0.5)
    SELECT cluster_id, phenotype_id, round(qval, 6) AS qval FROM t WHERE rn = 1""")
def top_phenotype_per_cluster(spark, d):
    rows = select.significant(_phenotypes(spark, d), 0.5, "qval")
    return select.top_per_cluster(rows).select("cluster_id", "phenotype_id", r6(F.col("qval")).alias("qval"))


@query(f"""WITH p AS ({PHENOTYPES}), t AS (SELECT 'clu_' || o_custkey AS cluster_id, phenotype_id, qval,
    row_number() OVER (PARTITION BY o_custkey ORDER BY qval NULLS LAST, phenotype_id) AS rn FROM p)
    SELECT cluster_id, phenotype_id, round(qval, 6) AS qval FROM t WHERE rn = 1""")
def top_phenotype_missing_last(spark, d):
    return select.top_per_cluster(_phenotypes(spark, d)).select("cluster_id", "phenotype_id", r6(F.col("qval")).alias("qval"))


@query(f"WITH p AS ({PHENOTYPES}) SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM p WHERE qval < 0.05)")
def fdr_semi_join(spark, d):
    hits = select.significant(_phenotypes(spark, d), 0.05, "qval").select(F.col("o_custkey").alias("c_custkey"))
    return select.keep_matching(table(spark, d, "customer"), hits, "c_custkey").select("c_custkey", "c_name")


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedup_rows(spark, d):
    return select.distinct_rows(table(spark, d, "events"), ["user_id", "event_type"])


@query("""SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def first_per_key(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return select.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark, d):
    return select.repeated_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- identifiers
VARIANT = "'chr' || (p_partkey % 22 + 1) || '_' || (p_partkey * 10) || '_A_' || substr(p_brand, 1, 1)"


def _variant() -> Column:
    return F.concat(F.lit("chr"), F.col("p_partkey") % 22 + 1, F.lit("_"), F.col("p_partkey") * 10, F.lit("_A_"), F.substring("p_brand", 1, 1))


@query(f"""WITH v AS (SELECT p_partkey, {VARIANT} AS v FROM part) SELECT p_partkey, split_part(v, '_', 1) AS chromosome, split_part(v, '_', 2)::BIGINT AS position,
    split_part(v, '_', 3) AS ref, split_part(v, '_', 4) AS alt FROM v""")
def variant_id_parse(spark, d):
    v = table(spark, d, "part").select("p_partkey", _variant().alias("v"))
    return v.select("p_partkey", K.variant_part(F.col("v"), 0).alias("chromosome"), big(K.variant_position(F.col("v"))).alias("position"), K.variant_part(F.col("v"), 2).alias("ref"), K.variant_part(F.col("v"), 3).alias("alt"))


@query("""WITH c AS (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'chr' WHEN 2 THEN 'CHR' ELSE 'chrchr' END || n_nationkey AS c FROM nation)
    SELECT n_nationkey, regexp_replace(c, '^(chr)+', '', 'i') AS bare, regexp_replace(c, '^chrchr', 'chr') AS single, 'chr' || replace(c, 'chr', '') AS prefixed FROM c""")
def chr_normalize(spark, d):
    k = F.col("n_nationkey")
    c = F.concat(F.when(k % 4 == 0, "").when(k % 4 == 1, "chr").when(k % 4 == 2, "CHR").otherwise("chrchr"), k)
    n = table(spark, d, "nation").select("n_nationkey", c.alias("c"))
    return n.select("n_nationkey", K.normalize_chr(F.col("c")).alias("bare"), K.single_chr(F.col("c")).alias("single"), K.prefixed_chr(F.col("c")).alias("prefixed"))


@query("SELECT p_partkey, 'ENSG' || p_partkey AS gene_id FROM part")
def gene_id_strip(spark, d):
    trait = F.concat(F.lit("1:2:clu_"), F.col("p_size"), F.lit("_ENSG"), F.col("p_partkey"), F.lit("."), F.col("p_size"))
    return table(spark, d, "part").select("p_partkey", K.unversioned(K.gene_of_phenotype(trait)).alias("gene_id"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey = 23 THEN 23 WHEN n_nationkey = 24 THEN 24 WHEN n_nationkey = 0 THEN 25 ELSE n_nationkey END::BIGINT AS place FROM nation""")
def natural_chr_sort(spark, d):
    k = F.col("n_nationkey")
    c = F.concat(F.lit("chr"), F.when(k == 23, "X").when(k == 24, "Y").when(k == 0, "M").otherwise(k.cast("string")))
    return table(spark, d, "nation").select("n_nationkey", big(K.chr_rank(c)).alias("place")).orderBy("place")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'clu_' || o_custkey ELSE 'gene' || o_orderkey END AS cluster_id, 'gene' || o_orderkey || '_' || CASE WHEN o_orderkey % 2 = 0 THEN 'L1' ELSE 'NA' END AS cs_id,
    'chr1_' || o_orderkey || '_A_T' AS afc_variant FROM orders""")
def phenotype_keys(spark, d):
    k = F.col("o_orderkey")
    gene = F.concat(F.lit("gene"), k)
    name = F.when(k % 3 == 0, F.concat(F.lit("x:clu_"), F.col("o_custkey"), F.lit(":"), k)).otherwise(gene)
    return table(spark, d, "orders").select("o_orderkey", K.cluster_id(name).alias("cluster_id"), K.set_id(gene, F.when(k % 2 == 0, "L1")).alias("cs_id"), K.fold_change_variant(F.concat(F.lit("chr1:"), k, F.lit("_A_T"))).alias("afc_variant"))


# ---------------------------------------------------------------- intervals
@query("SELECT o_orderkey, greatest(1, o_custkey * 100 - 50000)::BIGINT AS window_start, (o_custkey * 100 + 50000)::BIGINT AS window_end FROM orders")
def cis_window(spark, d):
    o = table(spark, d, "orders").withColumn("position", F.col("o_custkey") * 100)
    return intervals.cis_window(o, 50_000, "position").select("o_orderkey", big(F.col("window_start")).alias("window_start"), big(F.col("window_end")).alias("window_end"))


@query("SELECT o_orderkey, 'chr' || (o_custkey % 22 + 1) || ':' || (o_custkey * 100 - 50000) || '-' || (o_custkey * 100 + 50000) AS region FROM orders")
def region_string(spark, d):
    chrom = F.concat(F.lit("chr"), F.col("o_custkey") % 22 + 1)
    return table(spark, d, "orders").select("o_orderkey", intervals.region_text(chrom, F.col("o_custkey") * 100, 50_000).alias("region"))


@query("""WITH w AS (SELECT user_id, floor(epoch(ts))::BIGINT - 3600 AS s, floor(epoch(ts))::BIGINT + 3600 AS e FROM events),
    m AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM w),
    i AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
    SELECT user_id, min(s)::BIGINT AS win_start, max(e)::BIGINT AS win_end, count(*)::BIGINT AS n_windows FROM i GROUP BY user_id, k""")
def merge_windows(spark, d):
    t = F.unix_timestamp("ts")
    w = table(spark, d, "events").select("user_id", (t - 3600).alias("win_start"), (t + 3600).alias("win_end"))
    return intervals.merge_windows(w, "user_id", "win_start", "win_end")


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, coalesce(sum(l_quantity::BIGINT) OVER w, 0)::BIGINT AS load, max(l_quantity::BIGINT) OVER w AS highest
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem) WINDOW w AS (ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def running_load(spark, d):
    """One group over the whole table: a window would bring it all to one task."""
    rows = table(spark, d, "lineitem").select("l_orderkey", big(F.col("l_linenumber")).alias("l_linenumber"), "l_partkey", big(F.col("l_quantity")).alias("q")).distinct()
    order = ["l_orderkey", "l_linenumber", "l_partkey", "q"]
    out = sweep.running(rows, [], order, "q", "sum", "load").drop(sweep.PART)
    return sweep.running(out, [], order, "q", "max", "highest").drop(sweep.PART, "q")


POINTS = "SELECT event_id, 'chr' || (user_id % 5) AS chromosome, (event_id * 37) % 100003 AS position FROM events"
ELEMENTS = "SELECT 'chr' || (p_partkey % 5) AS chromosome, (p_partkey * 53) % 100003 AS e_start, (p_partkey * 53) % 100003 + p_size * 5 AS e_end, p_partkey, p_size FROM part"


def _points(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.concat(F.lit("chr"), F.col("user_id") % 5).alias("chromosome"), ((F.col("event_id") * 37) % 100003).alias("position"))


def _elements(spark, d) -> DataFrame:
    start = (F.col("p_partkey") * 53) % 100003
    return table(spark, d, "part").select(F.concat(F.lit("chr"), F.col("p_partkey") % 5).alias("chromosome"), start.alias("e_start"), (start + F.col("p_size") * 5).alias("e_end"), "p_partkey", "p_size")


@query(f"SELECT event_id, p.chromosome, position FROM ({POINTS}) p WHERE EXISTS (SELECT 1 FROM ({ELEMENTS}) e WHERE e.chromosome = p.chromosome AND position BETWEEN e_start AND e_end)")
def region_scan_join(spark, d):
    return intervals.region_rows(_points(spark, d), _elements(spark, d), start="e_start", end="e_end", width=1000).select("event_id", "chromosome", "position")


@query(f"SELECT event_id, coalesce(p_partkey, -1)::BIGINT AS part, coalesce(p_partkey IS NOT NULL, false) AS flag FROM ({POINTS}) p LEFT JOIN ({ELEMENTS}) e ON e.chromosome = p.chromosome AND position BETWEEN e_start AND e_end")
def overlap_left_join(spark, d):
    e = _elements(spark, d).select("chromosome", "e_start", "e_end", "p_partkey", F.lit(True).alias("flag"))
    out = intervals.flag_overlaps(_points(spark, d), e, ["flag"], start="e_start", end="e_end", width=500)
    return out.select("event_id", F.coalesce("p_partkey", F.lit(-1)).alias("part"), "flag")


@query(f"""SELECT event_id, s::BIGINT AS score FROM ({POINTS}) p LEFT JOIN (SELECT event_id AS k, arg_max(p_size, p_partkey) AS s FROM ({POINTS}) q JOIN ({ELEMENTS}) e
    ON e.chromosome = q.chromosome AND position BETWEEN e_start AND e_end GROUP BY event_id) ON k = event_id""")
def point_score(spark, d):
    e = _elements(spark, d).select("chromosome", "e_start", "e_end", F.col("p_size").alias("score"), F.col("p_partkey").alias("ordinal"))
    return intervals.point_score(_points(spark, d), e, start="e_start", end="e_end").select("event_id", big(F.col("score")).alias("score"))


@query(f"SELECT event_id FROM ({POINTS}) WHERE chromosome = 'chr2' AND position BETWEEN 1000 AND 20000")
def range_predicate(spark, d):
    return _points(spark, d).where(intervals.in_region(F.col("chromosome"), F.col("position"), F.lit("chr2"), F.lit(1000), F.lit(20000))).select("event_id")


# ---------------------------------------------------------------- genotypes
DOSAGES = """SELECT l_partkey AS variant_id, l_suppkey AS sample_id, CASE WHEN l_orderkey % 17 = 0 THEN -1 ELSE l_quantity::INT % 3 END::DOUBLE AS dosage,
    CASE l_suppkey % 4 WHEN 0 THEN 'afr' WHEN 1 THEN 'eur' WHEN 2 THEN 'oth' END AS ancestry FROM lineitem"""


def _dosages(spark, d) -> DataFrame:
    s = F.col("l_suppkey") % 4
    value = F.when(F.col("l_orderkey") % 17 == 0, -1).otherwise(F.col("l_quantity").cast("int") % 3).cast("double")
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("variant_id"), F.col("l_suppkey").alias("sample_id"), value.alias("dosage"), F.when(s == 0, "afr").when(s == 1, "eur").when(s == 2, "oth").alias("ancestry"))


MAF = f"""WITH g AS ({DOSAGES}), f AS (SELECT ancestry, variant_id, count(nullif(dosage, -1)) AS n, sum(nullif(dosage, -1)) / (2 * nullif(count(nullif(dosage, -1)), 0)) AS af
    FROM g WHERE ancestry IS NOT NULL AND ancestry <> 'oth' GROUP BY ALL)"""


@query(f"{MAF} SELECT ancestry, variant_id, n::BIGINT AS n, round(af, 6) AS af, round(least(af, 1 - af), 6) AS maf FROM f")
def maf_per_ancestry(spark, d):
    return genotypes.allele_frequencies(_dosages(spark, d)).select("ancestry", "variant_id", "n", r6(F.col("af")).alias("af"), r6(F.col("maf")).alias("maf"))


@query(f"{MAF} SELECT variant_id, count(*)::BIGINT AS n FROM g WHERE variant_id IN (SELECT variant_id FROM f WHERE least(af, 1 - af) > 0.45) GROUP BY 1")
def maf_filter(spark, d):
    return genotypes.filter_variants(_dosages(spark, d), maf=0.45).groupBy("variant_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH g AS ({DOSAGES}) SELECT 'chr' || variant_id AS variant_id, count(*)::BIGINT AS n FROM g WHERE variant_id IN (SELECT p_partkey FROM part WHERE p_size < 10) GROUP BY 1")
def allowlist_filter(spark, d):
    g = _dosages(spark, d).withColumn("variant_id", F.concat(F.lit("chrchr"), F.col("variant_id")))
    allowed = table(spark, d, "part").where("p_size < 10").select(F.concat(F.lit("chr"), F.col("p_partkey")).alias("v"))
    return genotypes.filter_variants(g, allowed=allowed).groupBy("variant_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH g AS ({DOSAGES}), m AS (SELECT variant_id, coalesce(avg(nullif(dosage, -1)), 0) AS mean FROM g GROUP BY 1)
    SELECT variant_id, round(any_value(mean), 6) AS mean, round(sum(coalesce(nullif(dosage, -1), mean)), 4) AS imputed, round(sum(abs(coalesce(nullif(dosage, -1), mean) - mean)), 4) AS spread
    FROM g JOIN m USING (variant_id) GROUP BY 1""")
def impute_center(spark, d):
    g = genotypes.impute_centre(_dosages(spark, d))
    return g.groupBy("variant_id").agg(r6(F.first("mean")).alias("mean"), F.round(F.sum("imputed"), 4).alias("imputed"), F.round(F.sum(F.abs("centred")), 4).alias("spread"))


@query(f"WITH g AS ({DOSAGES}) SELECT variant_id, count(*)::BIGINT AS n FROM g GROUP BY 1 HAVING sum(CASE WHEN variant_id % 3 = 0 THEN round_even(dosage, 0) ELSE 0 END) <> 0")
def drop_monomorphic(spark, d):
    g = _dosages(spark, d).withColumn("dosage", F.when(F.col("variant_id") % 3 == 0, F.col("dosage")).otherwise(0.0))
    return genotypes.drop_monomorphic(g).groupBy("variant_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_brand AS covariate, count(*)::BIGINT AS n FROM part GROUP BY 1 HAVING stddev_samp(CASE WHEN p_brand LIKE '%3' THEN 1 ELSE p_size END) <> 0""")
def drop_zero_sd(spark, d):
    c = table(spark, d, "part").select(F.col("p_brand").alias("covariate"), F.when(F.col("p_brand").like("%3"), 1).otherwise(F.col("p_size")).alias("value"))
    return genotypes.drop_constant_covariates(c).groupBy("covariate").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH g AS ({DOSAGES}), a AS (SELECT variant_id, sample_id, dosage FROM g WHERE variant_id % 2 = 0), b AS (SELECT variant_id, sample_id + 7 AS sample_id, dosage, 'sv' AS feature_type FROM g WHERE variant_id % 2 = 1),
    u AS (SELECT variant_id, sample_id, NULL AS feature_type FROM a UNION ALL SELECT variant_id, sample_id, feature_type FROM b)
    SELECT sample_id, count(*)::BIGINT AS n, count(feature_type)::BIGINT AS n_extra FROM u WHERE sample_id IN (SELECT sample_id FROM a INTERSECT SELECT sample_id FROM b) GROUP BY 1""")
def merge_additional_genotypes(spark, d):
    g = _dosages(spark, d).drop("ancestry")
    # Even variants are the one table; the odd ones are the other, whose samples are others in part.
    a, b = g.where("variant_id % 2 = 0"), g.where("variant_id % 2 = 1").withColumns({"sample_id": F.col("sample_id") + 7, "feature_type": F.lit("sv")})
    return genotypes.merge_genotypes(a, b).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.count("feature_type").alias("n_extra"))


@query("""WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CASE WHEN v < -0.15 THEN NULL ELSE v::DOUBLE END) AS a FROM embeddings),
    m AS (SELECT vec_id, a, coalesce(list_avg(a), 0) AS mean FROM x)
    SELECT vec_id, round(mean, 5) AS mean, round(list_sum(list_transform(a, lambda v: abs(coalesce(v, mean) - mean))), 4) AS spread FROM m""")
def array_impute_center(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: F.when(v >= -0.15, v.cast("double"))).alias("a"))
    e = e.withColumn("mean", genotypes.array_mean(F.col("a")))
    centred = genotypes.array_centred(genotypes.array_imputed(F.col("a"), F.col("mean")), F.col("mean"))
    e = e.withColumn("spread", F.aggregate(centred, F.lit(0.0), lambda s, x: s + F.abs(x)))
    return e.select("vec_id", F.round("mean", 5).alias("mean"), F.round("spread", 4).alias("spread"))


# ---------------------------------------------------------------- ranks and regressions
RANKS = "SELECT c_custkey, c_nationkey, round(c_acctbal / 500) AS v, rank() OVER w + (count(*) OVER (PARTITION BY c_nationkey, round(c_acctbal / 500)) - 1) / 2.0::DOUBLE AS rank, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY round(c_acctbal / 500))"


def _ranks(spark, d) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.round(F.col("c_acctbal") / 500).alias("v"))
    n = c.groupBy("c_nationkey").agg(F.count("v").alias("n"))
    return select.average_rank(c, "v", ["c_nationkey"]).join(n, "c_nationkey")


@query(f"SELECT c_custkey, rank FROM ({RANKS})")
def rank_average(spark, d):
    return _ranks(spark, d).select("c_custkey", "rank")


def _sql_poly(x: str, c: tuple[float, ...]) -> str:
    out = f"{c[-1]!r}::DOUBLE"
    for k in reversed(c[:-1]):
        out = f"({out} * {x} + {k!r}::DOUBLE)"
    return out


def _sql_qnorm(p: str) -> str:
    q, inner, r = f"({p} - 0.5::DOUBLE)", f"(0.180625::DOUBLE - ({p} - 0.5::DOUBLE) * ({p} - 0.5::DOUBLE))", f"sqrt(-ln(least({p}, 1 - {p})))"
    centre = f"{q} * {_sql_poly(inner, N.CENTRE_NUM)} / {_sql_poly(inner, N.CENTRE_DEN)}"
    outer = f"CASE WHEN {r} <= 5 THEN {_sql_poly(f'({r} - 1.6::DOUBLE)', N.MIDDLE_NUM)} / {_sql_poly(f'({r} - 1.6::DOUBLE)', N.MIDDLE_DEN)} ELSE {_sql_poly(f'({r} - 5)', N.TAIL_NUM)} / {_sql_poly(f'({r} - 5)', N.TAIL_DEN)} END"
    return f"CASE WHEN abs({q}) <= 0.425 THEN {centre} WHEN {q} < 0 THEN -({outer}) ELSE {outer} END"


@query(f"SELECT c_custkey, round({_sql_qnorm('p')}, 6) AS score FROM (SELECT c_custkey, (rank - 0.5::DOUBLE) / n AS p FROM ({RANKS}))")
def inverse_normal(spark, d):
    return _ranks(spark, d).select("c_custkey", r6(N.normal_score(F.col("rank"), F.col("n"))).alias("score"))


@query(f"SELECT c_custkey, round({_sql_qnorm('p')}, 6) AS score FROM (SELECT c_custkey, (rank - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM ({RANKS}))")
def blom_rank(spark, d):
    return _ranks(spark, d).select("c_custkey", r6(N.blom_score(F.col("rank"), F.col("n"))).alias("score"))


@query("SELECT c_nationkey::VARCHAR AS phenotype_id, c_custkey::VARCHAR AS sample_id, round(c_acctbal - (b * c_custkey + a), 4) AS value FROM customer JOIN (SELECT c_nationkey AS k, regr_slope(c_acctbal, c_custkey) AS b, regr_intercept(c_acctbal, c_custkey) AS a FROM customer WHERE c_custkey % 5 <> 0 GROUP BY 1) ON k = c_nationkey")
def residualize_ols(spark, d):
    c = table(spark, d, "customer")
    key = F.col("c_custkey").cast("string")
    values = c.select(F.col("c_nationkey").cast("string").alias("phenotype_id"), key.alias("sample_id"), F.col("c_acctbal").alias("value"))
    covariates = c.select(key.alias("sample_id"), F.array(F.lit(1.0), F.col("c_custkey").cast("double")).alias("c"))
    train = c.where("c_custkey % 5 <> 0").select(key.alias("sample_id"))
    return crossval.residualise(values, covariates, train).select("phenotype_id", "sample_id", F.round("value", 4).alias("value"))


@query("SELECT c_nationkey, round(regr_slope(c_acctbal, c_custkey), 6) AS slope, round(regr_intercept(c_acctbal, c_custkey), 4) AS intercept FROM customer GROUP BY 1")
def beta_hat(spark, d):
    c = table(spark, d, "customer")
    key = F.col("c_custkey").cast("string")
    values = c.select(F.col("c_nationkey").cast("string").alias("phenotype_id"), key.alias("sample_id"), F.col("c_acctbal").alias("value"))
    found = crossval.coefficients(values, c.select(key.alias("sample_id"), F.array(F.lit(1.0), F.col("c_custkey").cast("double")).alias("c")))
    return found.select(F.col("phenotype_id").cast("int").alias("c_nationkey"), r6(F.get("beta", F.lit(1))).alias("slope"), F.round(F.get("beta", F.lit(0)), 4).alias("intercept"))


# ---------------------------------------------------------------- credible sets
@query("SELECT vec_id, 'L' || (label % 10 + 1) AS cs_index, round(abs(embedding[label % 10 + 1])::DOUBLE, 6) AS pip FROM embeddings")
def pip_from_component(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding", F.concat(F.lit("L"), F.col("label") % 10 + 1).alias("cs_index"))
    alphas = [F.abs(F.get("embedding", F.lit(i))).cast("double") for i in range(10)]
    return e.select("vec_id", "cs_index", r6(reshape.component_value(alphas, F.col("cs_index"))).alias("pip"))


@query("""WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), a AS (SELECT vec_id, i, round(abs(v) / sum(abs(v)) OVER (PARTITION BY vec_id), 9) AS alpha FROM x),
    c AS (SELECT *, sum(alpha) OVER (PARTITION BY vec_id ORDER BY alpha DESC, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM a)
    SELECT vec_id, count(*)::BIGINT AS cs_size FROM c WHERE coalesce(before, 0) < 0.95 GROUP BY 1""")
def credible_set(spark, d):
    """The cover that credible sets are made of, for the absolute parts of each vector as probabilities."""
    size = F.pandas_udf(lambda alphas: alphas.map(lambda a: len(kernels.cover(np.asarray(a, float)))), "long")
    parts = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    alpha = F.transform(parts, lambda x: F.round(x / F.aggregate(parts, F.lit(0.0), lambda a, y: a + y), 9))
    return table(spark, d, "embeddings").select("vec_id", size(alpha).alias("cs_size"))


@query("SELECT vec_id, label::BIGINT AS label FROM embeddings WHERE label IS NOT NULL AND NOT (embedding[1] < 0)")
def in_cs_filter(spark, d):
    e = table(spark, d, "embeddings").withColumn("low_purity", F.get("embedding", F.lit(0)) < 0)
    return finemap.pure_members(e.withColumnRenamed("label", "cs_index")).select("vec_id", big(F.col("cs_index")).alias("label"))


@query("""WITH m AS (SELECT o_orderkey, o_custkey::VARCHAR AS p, o_custkey % 7 <> 0 AS known, 'G' || (o_custkey % 50) AS gene FROM orders), j AS (SELECT o_orderkey, p, CASE WHEN known THEN gene END AS gene_id FROM m),
    n AS (SELECT gene_id, count(DISTINCT p) AS k FROM j GROUP BY 1) SELECT o_orderkey, j.gene_id, k::BIGINT AS n_phenotypes FROM j JOIN n ON j.gene_id IS NOT DISTINCT FROM n.gene_id""")
def uniq_per_gene(spark, d):
    o = table(spark, d, "orders")
    # One customer in seven is a phenotype that the table of phenotypes lacks.
    meta = o.where("o_custkey % 7 <> 0").select(F.col("o_custkey").cast("string").alias("phenotype_id")).distinct()
    meta = meta.select("phenotype_id", F.concat(F.lit("G"), F.col("phenotype_id").cast("long") % 50).alias("gene_id"), F.col("phenotype_id").alias("group_id"))
    found = finemap.phenotypes_per_gene(o.select("o_orderkey", F.col("o_custkey").cast("string").alias("molecular_trait_id")), meta)
    return found.select("o_orderkey", "gene_id", F.col("uniq_phenotypes_count").alias("n_phenotypes"))


@query("SELECT o_orderkey, round(lbf / ln(10), 6) AS log10bf FROM (SELECT o_orderkey, o_totalprice / 100 AS lbf FROM orders)")
def log10_bayes_factor(spark, d):
    return table(spark, d, "orders").select("o_orderkey", r6(N.log10_bf(F.col("o_totalprice") / 100)).alias("log10bf"))


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders")
def shard_union(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    folder, paths = scratch_folder(spark), []
    for part in (o.where("o_orderstatus <> 'F'"), o.where("o_orderstatus = 'F'").drop("o_orderpriority")):
        paths.append(f"{folder}/{len(paths)}.parquet")
        sinks.write_table(part, paths[-1])
    return shards.read_shards(spark, paths, o.schema)


# ---------------------------------------------------------------- annotation
@query("""SELECT o_orderkey, (o_orderkey - CASE WHEN p_size % 2 = 0 THEN p_size ELSE p_size + 1000 END)::BIGINT AS dist_tss FROM orders LEFT JOIN part ON p_partkey = o_custkey""")
def tss_distance(spark, d):
    p = table(spark, d, "part").select(F.concat(F.lit("ENSG"), "p_partkey", F.lit(".1")).alias("gene_id"), F.col("p_name").alias("gene_name"), F.col("p_type").alias("gene_type"), F.col("p_size").alias("start"), (F.col("p_size") + 1000).alias("end"), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"))
    fm = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("position"), F.concat(F.lit("x_ENSG"), "o_custkey", F.lit(".1")).alias("molecular_trait_id"))
    return annotate.add_genes(fm, p).select("o_orderkey", big(F.col("dist_tss")).alias("dist_tss"))


@query("""WITH x AS (SELECT o_orderkey, (o_orderkey % 1001) / 1000.0::DOUBLE AS pip FROM orders), r AS (SELECT min(pip) AS a, max(pip) AS b FROM x)
    SELECT o_orderkey, CASE WHEN pip <= a + (b - a) / 5 THEN 1 WHEN pip <= a + (b - a) / 5 * 2 THEN 2 WHEN pip <= a + (b - a) / 5 * 3 THEN 3 WHEN pip <= a + (b - a) / 5 * 4 THEN 4 ELSE 5 END::BIGINT AS bin FROM x, r""")
def pip_bins(spark, d):
    x = table(spark, d, "orders").select("o_orderkey", ((F.col("o_orderkey") % 1001) / 1000.0).alias("pip"))
    out = annotate.add_bins(x)
    low = [F.when(F.col("PIP_bin").startswith(p), i + 1) for i, p in enumerate(("(-", "(0.2,", "(0.4,", "(0.6,", "(0.8,"))]
    return out.select("o_orderkey", big(F.coalesce(*low)).alias("bin"))


@query("""SELECT o_orderkey, CASE WHEN pip < 0 OR pip > 1 THEN NULL WHEN pip <= 1 * 0.1::DOUBLE THEN '[0,0.1]' ELSE (SELECT '(' || (i / 10.0)::DOUBLE || ',' || CASE WHEN i = 9 THEN '1' ELSE ((i + 1) / 10.0)::DOUBLE::VARCHAR END || ']' FROM range(1, 10) t(i) WHERE pip > i * 0.1::DOUBLE AND pip <= (i + 1) * 0.1::DOUBLE) END AS decile
    FROM (SELECT o_orderkey, ((o_orderkey % 1101) / 1000.0)::DOUBLE AS pip FROM orders)""")
def pip_deciles(spark, d):
    x = table(spark, d, "orders").select("o_orderkey", ((F.col("o_orderkey") % 1101) / 1000.0).alias("pip"))
    return x.select("o_orderkey", N.decile(F.col("pip")).alias("decile"))


@query("SELECT p_partkey, contains(p_type, 'STEEL') AS has_steel, p_brand = 'Brand#13' AS has_brand13 FROM part")
def multilabel_widen(spark, d):
    last = F.element_at(F.split("p_type", " "), -1)
    p = table(spark, d, "part").select("p_partkey", F.concat_ws(", ", F.when(F.contains("p_type", F.lit("STEEL")), "STEEL").otherwise(F.concat(F.lit("x"), last)), "p_brand").alias("type"))
    return reshape.widen_labels(p, "type", ["STEEL", "Brand#13"]).withColumnsRenamed({"STEEL": "has_steel", "Brand#13": "has_brand13"})


@query("SELECT p_partkey, p_size % 2 = 0 AND p_size % 3 <> 0 AND p_size % 5 <> 0 AS synonymous FROM part")
def vep_suppress(spark, d):
    p = table(spark, d, "part").select("p_partkey", *[(F.col("p_size") % k == 0).alias(n) for k, n in ((2, "synonymous"), (3, "missense"), (5, "stop"))])
    return reshape.suppress_flag(p, "synonymous", ["missense", "stop"]).select("p_partkey", "synonymous")


@query("SELECT p_partkey, CASE WHEN p_size / 50.0 > 0.9 THEN 'Constrained' ELSE 'Unconstrained' END AS constraint_label, CASE WHEN p_size % 2 = 0 OR p_size % 3 = 0 THEN 'Enhancer' WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN 'Promoter' END AS annotation FROM part")
def constraint_and_annotation_label(spark, d):
    flag = lambda k: F.col("p_size") % k == 0
    return table(spark, d, "part").select("p_partkey", N.constraint_label(F.col("p_size") / 50.0).alias("constraint_label"), N.regulatory_label([flag(2), flag(3)], [flag(5), flag(7)]).alias("annotation"))


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*)::BIGINT AS n, round(sum(least(af, 1 - af)), 4) AS maf FROM lineitem LEFT JOIN (SELECT p_partkey, p_size / 60.0::DOUBLE AS af FROM part WHERE p_size > 20) ON p_partkey = l_partkey GROUP BY 1, 2""")
def vat_join(spark, d):
    fm = table(spark, d, "lineitem").select("l_orderkey", big(F.col("l_linenumber")).alias("l_linenumber"), F.concat_ws("_", F.lit("chr1"), F.col("l_partkey").cast("string"), F.lit("A"), F.lit("T")).alias("variant"))
    af = F.col("p_size") / 60.0
    vat = table(spark, d, "part").where("p_size > 20").select(F.lit("chr1").alias("chrom"), F.col("p_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("T").alias("alt"), *[x.alias(f"gvs_{s}_{k}") for s in ("afr", "eur") for k, x in (("af", af), ("ac", F.col("p_size")), ("an", F.lit(60)))])
    out = annotate.add_frequencies(fm, vat)
    return out.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("gvs_max_af"), 4).alias("maf"))


@query("""WITH a AS (SELECT 'G' || (o_custkey % 50) AS gene_id, 'chr' || (o_custkey % 3) || '_' || o_custkey AS variant, o_totalprice / 1000 AS fc, o_orderkey FROM orders WHERE o_orderkey % 13 <> 0),
    f AS (SELECT gene_id, variant, arg_min(fc, o_orderkey) AS fc FROM a GROUP BY 1, 2) SELECT c_custkey, round(fc, 6) AS log2_afc FROM customer LEFT JOIN f ON gene_id = 'G' || (c_custkey % 50) AND variant = 'chr' || (c_custkey % 3) || '_' || c_custkey""")
def afc_join(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_custkey")
    # Rows of column types, in either column, are no fold changes.
    typed = F.col("o_orderkey") % 13 == 0
    pid = F.when(typed & (F.col("o_orderkey") % 2 == 0), "<chr>").otherwise(F.concat(F.lit("G"), k % 50, F.lit(".7")))
    sid = F.when(typed & (F.col("o_orderkey") % 2 == 1), "<chr>").otherwise(F.concat(F.lit("chr"), k % 3, F.lit(":"), k))
    value = F.format_string("%.17g", F.col("o_totalprice") / 1000)
    afc = o.select(pid.alias("pid"), sid.alias("sid"), *[value.alias(c) for c in annotate.FOLD_CHANGE[2:]], F.col("o_orderkey").alias("ordinal"))
    c = F.col("c_custkey")
    fm = table(spark, d, "customer").select(c, F.concat(F.lit("G"), c % 50).alias("gene_id"), F.concat(F.lit("chr"), c % 3, F.lit("_"), c).alias("variant"))
    return annotate.add_fold_changes(fm, afc).select("c_custkey", r6(F.col("log2_aFC")).alias("log2_afc"))


# ---------------------------------------------------------------- ancestry skew
COUNTS = """SELECT l_partkey AS k, count(*) FILTER (l_returnflag = 'A')::DOUBLE AS a_ac, 2.0::DOUBLE * count(*) FILTER (l_linestatus = 'F') AS a_an, count(*) FILTER (l_returnflag = 'N')::DOUBLE AS n_ac, 2.0::DOUBLE * count(*) AS n_an,
    count(*) FILTER (l_returnflag = 'R')::DOUBLE AS r_ac, 2.0::DOUBLE * count(*) FILTER (l_linestatus = 'F') AS r_an FROM lineitem GROUP BY 1"""


def _counts(spark, d) -> DataFrame:
    n = lambda c: F.sum(F.when(c, 1.0).otherwise(0.0))
    flag, fin = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    g = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(n(flag == "A").alias("gvs_afr_ac"), (2 * n(fin)).alias("gvs_afr_an"), n(flag == "N").alias("gvs_eur_ac"), (2 * n(F.lit(True))).alias("gvs_eur_an"), n(flag == "R").alias("gvs_oth_ac"), (2 * n(fin)).alias("gvs_oth_an"))
    for s in ("afr", "eur", "oth"):
        g = g.withColumn(f"gvs_{s}_af", F.try_divide(f"gvs_{s}_ac", f"gvs_{s}_an"))
    total = lambda x: F.col(f"gvs_afr_{x}") + F.col(f"gvs_eur_{x}") + F.col(f"gvs_oth_{x}")
    return g.withColumns({"gvs_all_ac": total("ac"), "gvs_all_an": total("an"), "variant": F.concat(F.lit("v"), "k"), "pip": (F.col("k") % 100) / 100.0})


LARGEST = f"""WITH c AS ({COUNTS}), f AS (SELECT *, a_ac / nullif(a_an, 0) AS a0, n_ac / nullif(n_an, 0) AS n0, r_ac / nullif(r_an, 0) AS r0 FROM c),
    m AS (SELECT *, CASE WHEN a0 IS NOT NULL THEN least(a0, 1 - a0) END AS a, CASE WHEN n0 IS NOT NULL THEN least(n0, 1 - n0) END AS n, CASE WHEN r0 IS NOT NULL THEN least(r0, 1 - r0) END AS r FROM f),
    g AS (SELECT *, greatest(a, n, r) AS top, CASE WHEN a = greatest(a, n, r) THEN 'afr' WHEN n = greatest(a, n, r) THEN 'eur' WHEN r = greatest(a, n, r) THEN 'oth' END AS who FROM m),
    w AS (SELECT *, CASE who WHEN 'afr' THEN a_ac WHEN 'eur' THEN n_ac WHEN 'oth' THEN r_ac END AS mac, CASE who WHEN 'afr' THEN a_an WHEN 'eur' THEN n_an WHEN 'oth' THEN r_an END AS man, a_ac + n_ac + r_ac AS tac, a_an + n_an + r_an AS tan FROM g)"""


@query(f"{LARGEST} SELECT k, who AS gvs_max_subpop, round(top, 6) AS gvs_max_af, mac AS gvs_max_ac, man AS gvs_max_an, tac - mac AS gvs_rest_ac, tan - man AS gvs_rest_an FROM w")
def max_subpop(spark, d):
    out = skew.background(skew.add_largest(_counts(spark, d), ["afr", "eur", "oth"]))
    return out.select("k", "gvs_max_subpop", r6(F.col("gvs_max_af")).alias("gvs_max_af"), "gvs_max_ac", "gvs_max_an", "gvs_rest_ac", "gvs_rest_an")


def _fisher(source: str) -> str:
    """Common table expressions from t (k, who, a, b, c, e) to p with the two-sided p-value by k."""
    return f"""t AS (SELECT k, who, (mac + 1)::BIGINT AS a, (man + 1)::BIGINT AS b, (tac - mac + 1)::BIGINT AS c, (tan - man + 1)::BIGINT AS e FROM {source} WHERE (k % 100) / 100.0 >= 0.9 AND tac >= mac AND tan >= man),
    s AS (SELECT k, who, a, unnest(range(greatest(0, a + b - (b + e)), least(a + b, a + c) + 1)) AS x, a + c AS m, b + e AS n, a + b AS q FROM t),
    p AS (SELECT k, who, x = a AS own, exp(lgamma(m + 1) - lgamma(x + 1) - lgamma(m - x + 1) + lgamma(n + 1) - lgamma(q - x + 1) - lgamma(n - q + x + 1) - lgamma(m + n + 1) + lgamma(q + 1) + lgamma(m + n - q + 1)) AS pmf FROM s),
    o AS (SELECT k, any_value(pmf) FILTER (own) AS mine FROM p GROUP BY 1), v AS (SELECT k, any_value(who) AS who, round(least(1, sum(pmf) FILTER (pmf <= mine * (1 + 1e-7))), 6) AS p_value FROM p JOIN o USING (k) GROUP BY k)"""


@query(f"{LARGEST}, {_fisher('w')} SELECT k, who AS gvs_max_subpop, p_value AS gvs_p_value FROM v")
def fisher_p(spark, d):
    out = skew.ancestry_skew(_counts(spark, d).select("*"), 0.9, "oth", keep_columns=True)
    return out.select("k", "gvs_max_subpop", r6(F.col("gvs_p_value")).alias("gvs_p_value"))


# The whole cohort has 9 alleles, 5 of them counted, that are of no subpopulation.
UNMIXED = """u AS (SELECT k, CASE WHEN a >= n OR n IS NULL THEN 'afr' WHEN n IS NOT NULL THEN 'eur' END AS who0, a, n, a_ac, a_an, n_ac, n_an, tac + 5 - r_ac AS tac, tan + 9 - r_an AS tan FROM w),
    x AS (SELECT k, CASE WHEN a IS NULL AND n IS NULL THEN NULL ELSE who0 END AS who, CASE WHEN who0 = 'afr' THEN a_ac ELSE n_ac END AS mac, CASE WHEN who0 = 'afr' THEN a_an ELSE n_an END AS man, tac, tan FROM u)"""


@query(f"{LARGEST}, {UNMIXED}, {_fisher('x')} SELECT 'v' || x.k AS variant, p_value AS gvs_no_admixed_p_value FROM x LEFT JOIN v ON v.k = x.k WHERE (x.k % 100) / 100.0 >= 0.9")
def skew_no_admixed(spark, d):
    whole = _counts(spark, d).withColumns({"gvs_all_ac": F.col("gvs_all_ac") + 5, "gvs_all_an": F.col("gvs_all_an") + 9})
    return skew.ancestry_skew(whole).select("variant", r6(F.col("gvs_no_admixed_p_value")).alias("gvs_no_admixed_p_value"))


# ---------------------------------------------------------------- cross-validation
@query("SELECT c_custkey::VARCHAR AS sample_id, ((row_number() OVER (PARTITION BY c_mktsegment ORDER BY (c_custkey * 7919) % 10007, c_custkey::VARCHAR) - 1) % 5 + 1)::BIGINT AS fold FROM customer")
def cv_folds(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("sample_id"), F.col("c_mktsegment").alias("ancestry"), "c_custkey")
    return crossval.assign_folds(c, order=(F.col("c_custkey") * 7919) % 10007).select("sample_id", big(F.col("fold")).alias("fold"))


PREDICTED = f"WITH g AS ({DOSAGES}) SELECT variant_id % 7 AS phenotype_id, sample_id, sum(dosage * (p_size / 50.0)) AS y FROM g JOIN part ON p_partkey = variant_id WHERE dosage >= 0 GROUP BY 1, 2"


def _predicted(spark, d) -> DataFrame:
    g = _dosages(spark, d).where("dosage >= 0").drop("ancestry")
    effects = table(spark, d, "part").select(F.col("p_partkey").alias("variant_id"), (F.col("p_partkey") % 7).alias("phenotype_id"), (F.col("p_size") / 50.0).alias("beta"))
    return crossval.predict(g, effects)


@query(f"SELECT phenotype_id, sample_id, round(y, 4) AS predicted FROM ({PREDICTED})")
def cv_predict(spark, d):
    return _predicted(spark, d).select("phenotype_id", "sample_id", F.round("Predicted", 4).alias("predicted"))


@query(f"SELECT phenotype_id, round(pow(corr(y, s_acctbal), 2), 6) AS r2, count(*)::BIGINT AS n FROM ({PREDICTED}) JOIN supplier ON s_suppkey = sample_id GROUP BY 1")
def cv_r2(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("sample_id"), F.col("s_acctbal").alias("Observed"))
    return crossval.r_squared(_predicted(spark, d).join(s, "sample_id"), ["phenotype_id"]).select("phenotype_id", r6(F.col("r2")).alias("r2"), "n")


# ---------------------------------------------------------------- numbering and graphs
@query("""WITH x AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS r, count(*) OVER () AS n FROM supplier), z AS (SELECT *, greatest(1, n // 7) AS size FROM x)
    SELECT s_suppkey, r::BIGINT AS row, ((r - 1) // 8 + 1)::BIGINT AS batch, CASE WHEN (r - 1) // size + 1 > 7 THEN r - 1 - 7 * size + 1 ELSE (r - 1) // size + 1 END::BIGINT AS chunk FROM z""")
def chunk_assign(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey")
    n = s.count()
    rows = chunks.numbered(s, ["s_suppkey"])
    return rows.select("s_suppkey", big(F.col("row")).alias("row"), big(chunks.batch_of(F.col("row"), 8)).alias("batch"), big(chunks.chunk_of(F.col("row") - 1, 7, n)).alias("chunk"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT n_nationkey::BIGINT AS u, (100 + n_regionkey * 2 + n_nationkey % 2)::BIGINT AS v FROM nation), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
    r(node, reach) AS (SELECT u, u FROM b UNION SELECT r.node, b.v FROM r JOIN b ON r.reach = b.u) SELECT node, min(reach)::BIGINT AS component FROM r GROUP BY 1""")
def connected_components(spark, d):
    e = table(spark, d, "nation").select(big(F.col("n_nationkey")).alias("u"), big(100 + F.col("n_regionkey") * 2 + F.col("n_nationkey") % 2).alias("v"))
    return graph.connected_components(e)


@query("""WITH RECURSIVE s AS (SELECT 't' || o_custkey || '_L' || (o_orderkey % 3) AS cs_id, o_custkey::VARCHAR AS molecular_trait_id, 'g' AS "group", 'v' || (o_orderkey % 499) AS variant, 'chr' || (o_orderkey % 5) AS chromosome, o_orderkey % 499 AS position,
    (o_orderkey % 11 - 5)::DOUBLE AS z, (o_orderkey % 100) / 100.0::DOUBLE AS pip, (o_orderkey % 20)::INT AS cs_size FROM orders),
    k AS (SELECT s.*, m AS max_abs_z FROM s JOIN (SELECT cs_id, max(abs(z)) AS m FROM s GROUP BY 1) USING (cs_id) WHERE m > 3 AND cs_size < 10),
    h AS (SELECT chromosome, position, min(cs_id) AS hub FROM k GROUP BY 1, 2), e AS (SELECT DISTINCT cs_id AS u, hub AS v FROM k JOIN h USING (chromosome, position)), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
    r(node, component) USING KEY (node) AS (SELECT u, least(u, min(v)) FROM b GROUP BY u UNION SELECT b.u, min(n.component) FROM r AS n JOIN b ON b.v = n.node JOIN recurring.r AS o ON o.node = b.u WHERE n.component < o.component GROUP BY b.u),
    f AS (SELECT k.*, component FROM k LEFT JOIN r ON node = cs_id), t AS (SELECT component, arg_max(variant, (pip, variant)) AS top_variant FROM f GROUP BY 1)
    SELECT f.*, top_variant FROM f LEFT JOIN t USING (component)""")
def set_components(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    sets = o.select(F.concat(F.lit("t"), F.col("o_custkey"), F.lit("_L"), k % 3).alias("cs_id"), F.col("o_custkey").cast("string").alias("molecular_trait_id"), F.lit("g").alias("group"), F.concat(F.lit("v"), k % 499).alias("variant"), F.concat(F.lit("chr"), k % 5).alias("chromosome"), (k % 499).alias("position"), (k % 11 - 5).cast("double").alias("z"), ((k % 100) / 100.0).alias("pip"), (k % 20).cast("int").alias("cs_size"))
    return graph.set_components(sets)


# ---------------------------------------------------------------- models, checked by invariants in the tests
def _matrix(spark, d) -> DataFrame:
    """Variants with dosages 0, 1, 2 from embeddings: one variant per dimension, a sample per vector."""
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "x"))
    level = F.when(F.col("x") < -0.05, 0.0).when(F.col("x") < 0.05, 1.0).otherwise(2.0)
    packed = e.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("vec_id", level.alias("g")))).alias("s"))
    pos = (F.col("i") + 1) * 1000
    return packed.select(F.concat_ws("_", F.lit("chr1"), pos.cast("string"), F.lit("A"), F.lit("G")).alias("variant_id"), F.lit("chr1").alias("chromosome"), pos.cast("int").alias("position"), F.col("s.g").alias("dosage"))


def planted_traits(spark, d):
    """Two traits made of one variant's dosages each, and all dosages."""
    g = _matrix(spark, d)
    name = F.when(F.col("position") == 5000, "t1_ENSG1.1").otherwise("t2_ENSG2.1")
    # A cohort's dosages are a row's array; as literals of the plan they would pass the driver one by one.
    y = F.transform("dosage", lambda a, i: a * 1.5 + (F.xxhash64(i) % 1000) / 1000.0)
    return g.where(F.col("position").isin(5000, 40000)).select(name.alias("phenotype_id"), "chromosome", "position", y.alias("values")), g


@query()
def finemap_planted(spark, d):
    return finemap.in_credible_sets(finemap.fit_phenotypes(*planted_traits(spark, d)))


@query()
def fold_pcs(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("sample_id"), F.posexplode("embedding").alias("i", "value"))
    x = e.select(F.col("i").cast("string").alias("phenotype_id"), "sample_id", F.col("value").cast("double").alias("value"))
    folds = e.select("sample_id").distinct().withColumn("fold", (F.col("sample_id").cast("int") % 3 + 1).cast("int"))
    return crossval.fold_components(x, folds)


@query()
def fold_pcs_blocks(spark, d):
    """The components of fold_pcs by blocks of samples."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("sample_id"), F.posexplode("embedding").alias("i", "value"))
    x = e.select(F.col("i").cast("string").alias("phenotype_id"), "sample_id", F.col("value").cast("double").alias("value"))
    folds = e.select("sample_id").distinct().withColumn("fold", (F.col("sample_id").cast("int") % 3 + 1).cast("int"))
    return components.fold_components_by_blocks(x, folds, cells=100_000, width=64)


@query("""WITH counts AS (SELECT l_partkey::VARCHAR AS phenotype_id, (l_suppkey % 8)::VARCHAR AS sample_id, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
    sizes AS (SELECT sample_id, sum(value) AS size, quantile_cont(value, 0.75) / sum(value) AS q75 FROM counts GROUP BY 1),
    ref AS (SELECT sample_id, size FROM sizes ORDER BY abs(q75 - (SELECT avg(q75) FROM sizes)), sample_id LIMIT 1),
    base AS (SELECT phenotype_id, value AS r, size AS nr FROM counts JOIN ref USING (sample_id)),
    pairs AS (SELECT sample_id, phenotype_id, round(log2((value / size) / (r / nr)), 12) AS m, round(log2((value / size) * (r / nr)) / 2, 12) AS a, (1 - value / size) / value + (1 - r / nr) / r AS v
        FROM counts JOIN sizes USING (sample_id) JOIN base USING (phenotype_id) WHERE value > 0 AND r > 0),
    ranked AS (SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY m) + (count(*) OVER (PARTITION BY sample_id, m) - 1) / 2.0 AS rank_m,
        rank() OVER (PARTITION BY sample_id ORDER BY a) + (count(*) OVER (PARTITION BY sample_id, a) - 1) / 2.0 AS rank_a, count(*) OVER (PARTITION BY sample_id) AS n, max(abs(m)) OVER (PARTITION BY sample_id) AS widest FROM pairs),
    kept AS (SELECT sample_id, pow(2, sum(m / v) / sum(1 / v)) AS raw FROM ranked WHERE widest >= 1e-6 AND rank_m BETWEEN floor(n * 0.3) + 1 AND n - floor(n * 0.3) AND rank_a BETWEEN floor(n * 0.05) + 1 AND n - floor(n * 0.05) GROUP BY 1),
    factors AS (SELECT sample_id, size, coalesce(raw, 1) / exp(avg(ln(coalesce(raw, 1))) OVER ()) AS factor FROM sizes LEFT JOIN kept USING (sample_id))
    SELECT phenotype_id, sample_id, round(log2(value / (size * factor) * 1e6 + 1), 6) AS value FROM counts JOIN factors USING (sample_id)""")
def tmm_cpm(spark, d):
    counts = table(spark, d, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("phenotype_id"), (F.col("l_suppkey") % 8).cast("string").alias("sample_id")).agg(F.sum("l_quantity").alias("value"))
    return crossval.normalised_counts(counts).withColumn("value", r6(F.col("value")))


@query("""WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), g AS (SELECT vec_id, i, CASE WHEN v < -0.05::DOUBLE THEN 0 WHEN v < 0.05::DOUBLE THEN 1 ELSE 2 END::DOUBLE AS g FROM x),
    z AS (SELECT vec_id, i, g - avg(g) OVER (PARTITION BY i) AS z FROM g)
    SELECT a.i::BIGINT AS row, b.i::BIGINT AS col, round(sum(a.z * b.z), 6) + 0.0 AS value FROM z AS a JOIN z AS b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY 1, 2""")
def sample_block_products(spark, d):
    """Products of centred variants, summed over blocks of samples; what fine-mapping by blocks works on."""
    g = _matrix(spark, d)
    trait = g.where("position = 5000").select(F.lit("t").alias("phenotype_id"), "chromosome", "position", F.col("dosage").alias("values"))
    tiles, _ = blockfit.products(trait, g, None, 1_000_000, 128, 24)
    found = blockfit.entries(tiles, 24)
    n = g.count()  # beyond the variants stand the one and the trait
    return found.where((F.col("row") < n) & (F.col("col") < n)).select("row", "col", (r6(F.col("value")) + 0.0).alias("value"))


@query()
def finemap_blocks(spark, d):
    """The planted effects of finemap_planted, fitted on products of sample blocks."""
    traits, g = planted_traits(spark, d)
    return finemap.in_credible_sets(blockfit.fit_by_blocks(traits, g, block=128, tile=24))


def cv_inputs(spark, d):
    """Phenotypes, dosages and folds of the query cross_validation: one phenotype per tenth variant, made of its dosages."""
    g = _matrix(spark, d)
    y = F.transform("dosage", lambda x, i: x + (F.xxhash64(i) % 100) / 100.0)
    traits = g.where("position % 10000 = 0").select(F.concat(F.lit("t"), "position").alias("phenotype_id"), "chromosome", "position", y.alias("values"))
    samples = table(spark, d, "embeddings").select("vec_id").orderBy("vec_id").toPandas()["vec_id"].astype(str)
    return traits, g, pd.DataFrame({"sample_id": samples, "fold": [i % 3 + 1 for i in range(len(samples))]})


@query()
def cross_validation(spark, d):
    from ..plans import pipeline

    traits, g, folds = cv_inputs(spark, d)
    allowed = g.where("position % 3000 <> 0").select("variant_id")
    return pipeline.cv_predict(traits, g, folds, fold_pcs(spark, d), allowed=allowed)


# ---------------------------------------------------------------- reshaping and small verbs
@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, sample_id, round(sum(value), 2) AS value, count(*)::BIGINT AS n FROM (SELECT l_orderkey, l_linenumber, 'l_quantity' AS sample_id, l_quantity AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', round(l_tax, 2) FROM lineitem) GROUP BY 1, 2, 3""")
def to_long(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", big(F.col("l_linenumber")).alias("l_linenumber"), "l_quantity", F.round("l_tax", 2).alias("l_tax"))
    long = reshape.to_long(x, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"])
    return long.groupBy("l_orderkey", "l_linenumber", "sample_id").agg(F.round(F.sum("value"), 2).alias("value"), F.count(F.lit(1)).alias("n"))


SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")


@query("SELECT 'n' || (c_custkey % 10) AS sample_id, " + ", ".join(f"max(c_acctbal) FILTER (lower(c_mktsegment) = '{x}') AS {x}" for x in SEGMENTS) + " FROM customer GROUP BY 1")
def transpose_matrix(spark, d):
    top = lambda i: F.max(F.when(F.col("c_custkey") % 10 == i, F.col("c_acctbal"))).alias(f"n{i}")
    wide = table(spark, d, "customer").groupBy(F.lower("c_mktsegment").alias("ID")).agg(*[top(i) for i in range(10)])
    return reshape.transpose(wide, "ID")


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_size WHEN 1 THEN p_size * 2 END::BIGINT AS value FROM part")
def pick_by_name(spark, d):
    p = table(spark, d, "part")
    name = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("none")), F.col("p_size") % 3 + 1)
    return p.select("p_partkey", reshape.pick_by_name({"a": big(F.col("p_size")), "b": big(F.col("p_size") * 2)}, name).alias("value"))


@query("SELECT s_suppkey::VARCHAR AS id FROM supplier UNION ALL SELECT 'skip'")
def skip_row(spark, d):
    from ..sources.sinks import with_skip_row

    return with_skip_row(table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id")), "id")


@query("SELECT p_partkey, list_sort(list_distinct(list(l_suppkey)))[1] AS first_sample, count(*)::BIGINT AS n FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1")
def align_samples(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    return select.pair_samples(rows, table(spark, d, "part").select("p_partkey"), "p_partkey").groupBy("p_partkey").agg(F.min("l_suppkey").alias("first_sample"), F.count(F.lit(1)).alias("n"))


@query("WITH v AS (SELECT l_partkey AS v, max(l_quantity) FILTER (l_suppkey % 4 = 0) AS a, max(l_quantity) FILTER (l_suppkey % 4 = 1) AS b, max(l_quantity) FILTER (l_suppkey % 4 = 2) AS c FROM lineitem GROUP BY 1) SELECT v, a AS s0, b AS s1, c AS s2 FROM v WHERE a IS NOT NULL OR b IS NOT NULL OR c IS NOT NULL")
def dosage_arrays(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("v"), (F.col("l_suppkey") % 4).cast("string").alias("s")).agg(F.max("l_quantity").alias("q"))
    out = genotypes.to_arrays(rows, ["0", "1", "2"], "v", "s", "q")
    return out.select("v", *[F.get("dosage", F.lit(i)).alias(f"s{i}") for i in range(3)])


@query("""WITH x AS (SELECT o_custkey, o_orderkey, o_totalprice, count(DISTINCT o_orderpriority) OVER (PARTITION BY o_custkey) AS n FROM orders) SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS top, any_value(n)::BIGINT AS n_priorities FROM x GROUP BY 1""")
def top_of_component(spark, d):
    o = table(spark, d, "orders")
    top = graph.top_of_component(o, "o_custkey", "o_orderkey", "o_totalprice")
    return top.join(select.summary_counts(o, ["o_custkey"], ["o_orderpriority"]), "o_custkey").select("o_custkey", "top", F.col("n_o_orderpriority").alias("n_priorities"))


@query("SELECT event_type, count(DISTINCT user_id)::BIGINT AS n_user_id, count(*)::BIGINT AS n FROM events GROUP BY 1")
def summary_counts(spark, d):
    return select.summary_counts(table(spark, d, "events"), ["event_type"], ["user_id"])
