import gzip
import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from locusmill import schemas
from locusmill.functions import kernels
from locusmill.functions import keys as K
from locusmill.functions import numeric as N
from locusmill.operators import annotate, chunks, crossval, finemap, genotypes, graph, intervals, reshape, select, skew
from locusmill.plans import pipeline
from locusmill.sources import genomic, shards, sinks, tables


def one(spark, **columns):
    """One row evaluated: name to expression."""
    return spark.range(1).select(*[v.alias(k) for k, v in columns.items()]).first()


def test_chromosome_text(spark):
    for text in ("1", "chr1", "CHR1", "chrchr1"):
        assert one(spark, x=K.normalize_chr(F.lit(text))).x == "1"
    assert one(spark, x=K.single_chr(F.lit("chrchr1_2"))).x == "chr1_2"


def test_keys(spark):
    r = one(spark, a=K.cluster_id(F.lit("1:2:clu_7:+")), b=K.cluster_id(F.lit("gene")), c=K.unversioned(K.gene_of_phenotype(F.lit("a_b_ENSG1.5"))), d=K.set_id(F.lit("p"), F.lit(None).cast("string")), e=K.variant_position(F.lit("chr1_x_A_T")))
    assert tuple(r) == ("clu_7", "gene", "ENSG1", "p_NA", None)


def test_qnorm_against_library(spark):
    from statistics import NormalDist

    p = [1e-12, 1e-5, 0.01, 0.3, 0.5, 0.77, 0.999]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "p double").select(N.qnorm(F.col("p"))).collect()]
    assert np.allclose(got, [NormalDist().inv_cdf(x) for x in p], rtol=1e-9)
    assert one(spark, x=N.qnorm(F.lit(0.0)), y=N.qnorm(F.lit(1.0)))[:] == (None, None)


def test_bins(spark):
    rows = spark.createDataFrame([(0.0,), (0.1,), (0.3,), (1.0,), (1.5,), (None,)], "pip double")
    assert [r[0] for r in rows.select(N.decile(F.col("pip"))).collect()] == ["[0,0.1]", "[0,0.1]", "(0.2,0.3]", "(0.9,1]", None, None]
    out = {r.pip: r.PIP_bin for r in annotate.add_bins(rows.where("pip <= 1")).collect()}
    assert out[0.0] == "(-0.001,0.2]" and out[0.3] == "(0.2,0.4]" and out[1.0] == "(0.8,1]" or out[1.0] == "(0.8,1.001]" or out[1.0].startswith("(0.8,1")
    same = annotate.add_bins(spark.createDataFrame([(0.5,), (0.5,)], "pip double")).collect()
    assert all(r.PIP_bin for r in same)


def test_top_per_cluster_edges(spark):
    rows = spark.createDataFrame([("b:clu_1:x", "0.01"), ("a:clu_1:y", "0.01"), ("c:clu_2", "NA"), ("d:clu_2", "0.9"), ("solo", "NA"), ("e:clu_3", "nan")], "phenotype_id string, qval string")
    got = {r.cluster_id: r.phenotype_id for r in select.top_per_cluster(rows).collect()}
    assert got == {"clu_1": "a:clu_1:y", "clu_2": "d:clu_2", "solo": "solo", "clu_3": "e:clu_3"}
    assert select.ranking_column(["x", "pval_perm"]) == "pval_perm"
    with pytest.raises(ValueError):
        select.ranking_column(["x"])


def test_significant_is_strict(spark):
    rows = spark.createDataFrame([(0.05,), (0.0499,), (None,)], "p_fdr double")
    assert select.significant(rows).count() == 1


def test_average_rank(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.0), (4, None)], "i int, v double")
    assert [r["rank"] for r in select.average_rank(rows, "v").orderBy("i").collect()] == [1.5, 1.5, 3.0, None]


def test_merge_windows_touching_nested_apart(spark):
    rows = spark.createDataFrame([("1", 1, 10), ("1", 10, 20), ("1", 12, 15), ("1", 22, 30), ("2", 1, 5)], "chromosome string, start int, end int")
    got = sorted((r.chromosome, r.start, r.end, r.n_windows) for r in intervals.merge_windows(rows).collect())
    assert got == [("1", 1, 20, 3), ("1", 22, 30, 1), ("2", 1, 5, 1)]


def test_overlap_bounds_and_fan_out(spark):
    points = spark.createDataFrame([("a", 10), ("a", 20), ("a", 21), ("b", 10), (None, 10)], "chromosome string, position int")
    spans = spark.createDataFrame([("a", 10, 20, True), ("a", 20, 40, True)], "chromosome string, start int, end int, hit boolean")
    got = sorted(((r.chromosome or ""), r.position, r.hit) for r in intervals.flag_overlaps(points, spans, ["hit"], width=7).collect())
    assert got == [("", 10, False), ("a", 10, True), ("a", 20, True), ("a", 20, True), ("a", 21, True), ("b", 10, False)]


def test_summaries_of_overlaps_equal_brute_force_without_pairs(spark):
    rng = np.random.default_rng(5)
    points = [(i, "ab"[i % 2], int(p)) for i, p in enumerate(rng.integers(-40, 300, 60))] + [(60, None, 5), (61, "a", None), (62, "b", 5000)]
    spans = [("ab"[i % 2], int(a), int(a + n), i % 3 == 0, float(i)) for i, (a, n) in enumerate(zip(rng.integers(-60, 280, 80), rng.integers(-2, 70, 80)))]
    spans += [("a", -7, 4000, True, 0.5), ("a", 3, 3, None, 99.0), ("b", None, 5, True, 100.0)]
    p = spark.createDataFrame(points, "i int, chromosome string, position int")
    s = spark.createDataFrame(spans, "chromosome string, start int, end int, hit boolean, ordinal double")
    holds = lambda c, x: [t for t in spans if None not in (c, x, t[1]) and t[0] == c and t[1] <= x <= t[2]]
    told = intervals.count_overlaps(p, s.drop("ordinal"), ["hit"], "n")
    assert told.columns == ["i", "chromosome", "position", "hit", "n"] and told.count() <= 3 * len(points)
    got = sorted((r.i, r.hit) for r in intervals.repeated(told, ["n"]).collect())
    assert got == sorted((i, bool(t[3])) for i, c, x in points for t in holds(c, x) or [(0, 0, 0, False)])
    assert got == sorted((r.i, r.hit) for r in intervals.flag_overlaps(p, s.drop("ordinal"), ["hit"]).collect())
    scored = intervals.point_score(p, s.withColumn("score", F.col("ordinal") * 2))
    assert {r.i: r.score for r in scored.collect()} == {i: max((2 * t[4] for t in holds(c, x)), default=None) for i, c, x in points}
    assert "__level" in scored._jdf.queryExecution().analyzed().toString() and scored.count() == len(points)
    none = s.where("false").withColumn("score", F.lit(1))
    assert {r.score for r in intervals.point_score(p, none).collect()} == {None}


def test_matches_of_a_place_leave_as_runs(spark):
    """Matches may grow with the square of the tables; those of a place and an interval are stored as runs only if they lie together."""
    points = [(i, "ab"[i % 2] if i % 11 else None, i * 37 % 20 if i % 13 else None, {"k": i}) for i in range(3000)]
    spans = [(f"s{k}", "ab"[k % 2], k % 17, k % 17 + k % 5) for k in range(60)]
    p = spark.createDataFrame(points, "i int, chromosome string, position int, m map<string, int>").repartition(3)
    s = spark.createDataFrame(spans, "name string, chromosome string, start int, end int").withColumn("hit", F.lit(True))
    out = intervals.flag_overlaps(p, s, ["hit"], width=7)
    assert out.columns == ["i", "chromosome", "position", "m", "name", "hit"]
    rows = out.collect()
    pairs = [(i, c, x, n) for i, c, x, _ in points for n in [n for n, d, a, b in spans if c == d and x is not None and a <= x <= b] or [None]]
    assert sorted(map(repr, pairs)) == sorted(repr((r.i, r.chromosome, r.position, r.name)) for r in rows)
    assert all(r.m == {"k": r.i} and r.hit == (r.name is not None) for r in rows)
    met = [(r.chromosome, r.position, r.name) for r in rows if r.hit]
    assert max(Counter((c, x) for _, c, x, _ in points).values()) > 100  # more than go as one row
    assert 1 + sum(a != b for a, b in zip(met, met[1:])) < len(met) / 20


def test_annotation_keeps_all_pairs_of_elements_and_promoters(spark):
    fm = spark.createDataFrame([("x_ENSG1.2", "chr1_15_A_G", "chr1", 15, "A", "G", 0.9)], "molecular_trait_id string, variant string, chromosome string, position int, ref string, alt string, pip double")
    span = lambda *rows, extra="": spark.createDataFrame(list(rows), "chromosome string, start int, end int" + extra)
    out = pipeline.annotate(
        fm, spark.createDataFrame([("ENSG1.2", "G", "p", 10, 20, "-")], "gene_id string, gene_name string, gene_type string, start int, end int, strand string"),
        span(*[("chr1", 10, 20 + i, "dELS") for i in range(3)], ("chr1", 1, 15, "PLS"), extra=", type string"), span(*[("chr1", 15, 15 + i) for i in range(5)]),
        spark.createDataFrame([("ENSG1", True, 0.95)], "gene_id string, canonical boolean, pli double"), span(("chr1", 15, 15, 1.0, 1), extra=", score double, ordinal long"),
        spark.createDataFrame([("chr1", 15, "A", "G", "0.7", "7", "10")], "chrom string, pos int, ref string, alt string, gvs_afr_af string, gvs_afr_ac string, gvs_afr_an string"),
    )
    assert sorted(r.Annotation for r in out.collect()) == ["Enhancer"] * 15 + ["Promoter"] * 5
    # Copies come about after the last join, so that none of them is shuffled.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert max(i for i, x in enumerate(plan.splitlines()) if "__promoters" in x and "explode" in x) < min(i for i, x in enumerate(plan.splitlines()) if "Join" in x)


def test_cis_window_clamps(spark):
    r = intervals.cis_window(spark.createDataFrame([(5,)], "start int"), 10).first()
    assert (r.window_start, r.window_end) == (1, 15)


def test_array_dosages(spark):
    rows = spark.createDataFrame([([1.0, -1.0, 0.0],), ([0.5, 1.5, 2.0],), ([-1.0, -1.0, -1.0],)], "d array<double>")
    got = rows.select(genotypes.array_polymorphic(F.col("d")).alias("p"), genotypes.array_mean(genotypes.array_present(F.col("d"))).alias("m")).collect()
    assert [(r.p, r.m) for r in got] == [(False, 0.5), (True, pytest.approx(4 / 3)), (True, 0.0)]


def test_maf_filter(spark):
    rows = spark.createDataFrame([("v1", 2.0, "eur"), ("v1", 1.0, "eur"), ("v2", 1.0, "oth"), ("v3", -1.0, "afr"), ("v4", 1.0, None)], "variant_id string, dosage double, ancestry string")
    f = {r.variant_id: (r.af, r.maf) for r in genotypes.allele_frequencies(rows).collect()}
    assert f == {"v1": (0.75, 0.25), "v3": (None, None)}
    assert genotypes.filter_variants(rows, maf=0.25).count() == 0 and genotypes.filter_variants(rows, maf=0.2).count() == 2
    with pytest.warns(UserWarning):
        assert genotypes.filter_variants(rows, ancestry=None, maf=0.2).count() == 5


def test_merge_genotypes_needs_shared_samples(spark):
    a, b = (spark.createDataFrame([(v, s)], "variant_id string, sample_id string") for v, s in (("x", "1"), ("y", "2")))
    with pytest.raises(ValueError):
        genotypes.merge_genotypes(a, b)


def test_to_arrays(spark):
    rows = spark.createDataFrame([("v", "s2", 2.0), ("v", "s1", 1.0), ("w", "s2", 0.0)], "variant_id string, sample_id string, dosage double")
    got = {r.variant_id: r.dosage for r in genotypes.to_arrays(rows, ["s1", "s2"]).collect()}
    assert got == {"v": [1.0, 2.0], "w": [None, 0.0]}


def skew_rows(spark):
    return spark.createDataFrame(
        [("v1", 0.95, 10.0, 100.0, 0.6, 6.0, 10.0, 0.4, 4.0, 10.0, 0.5, 5.0, 10.0), ("v2", 0.95, 10.0, 100.0, None, 1.0, 10.0, None, 1.0, 10.0, None, 1.0, 10.0), ("v3", 0.1, 1.0, 2.0, 0.1, 1.0, 2.0, 0.1, 1.0, 2.0, 0.1, 1.0, 2.0), ("v4", 0.9, 1.0, 50.0, 0.2, 2.0, 10.0, 0.1, 1.0, 10.0, 0.0, 0.0, 10.0)],
        "variant string, pip double, gvs_all_ac double, gvs_all_an double, gvs_afr_af double, gvs_afr_ac double, gvs_afr_an double, gvs_eur_af double, gvs_eur_ac double, gvs_eur_an double, gvs_oth_af double, gvs_oth_ac double, gvs_oth_an double",
    )


def test_skew(spark):
    got = {r.variant: r for r in skew.ancestry_skew(skew_rows(spark)).collect()}
    assert set(got) == {"v1", "v2", "v4"}
    assert got["v1"].gvs_max_subpop == "oth" and got["v1"].gvs_max_af == 0.5
    assert got["v2"].gvs_max_subpop is None and got["v2"].gvs_p_value is None
    assert got["v4"].gvs_p_value is None  # the rest would be negative
    assert got["v4"].gvs_no_admixed_p_value is None  # here too: one counted allele less none of the admixed, less two
    keep = skew.ancestry_skew(skew_rows(spark), keep_columns=True)
    assert keep.columns[:13] == skew_rows(spark).columns
    with pytest.raises(ValueError):
        skew.ancestry_skew(skew_rows(spark), admixed="zzz")
    with pytest.raises(ValueError):
        skew.ancestry_skew(skew_rows(spark), admixed="oth, afr ,EUR")
    with pytest.raises(ValueError):
        skew.ancestry_skew(spark.range(1))


def test_tie_takes_the_first_column(spark):
    assert one(spark, x=N.first_largest({"a": F.lit(0.4), "b": F.lit(0.4), "c": F.lit(None).cast("double")})).x == "a"


def test_reshape(spark):
    rows = spark.createDataFrame([(1, "dELS, CTCF-bound"), (2, "PLS")], "id int, type string")
    wide = reshape.widen_labels(rows, "type")
    assert wide.columns == ["id", "CTCF-bound", "PLS", "dELS"] and wide.orderBy("id").first()["dELS"] is True
    t = reshape.transpose(spark.createDataFrame([("c1", 1.0, 2.0), ("c2", 3.0, 4.0)], "ID string, s1 double, s2 double"), "ID")
    assert sorted(map(tuple, t.collect())) == [("s1", 1.0, 3.0), ("s2", 2.0, 4.0)]
    assert one(spark, x=reshape.component_value([F.lit(1.0), F.lit(2.0)], F.lit("L2"))).x == 2.0


def test_labels(spark):
    r = one(spark, a=N.regulatory_label([F.lit(True)], [F.lit(True)]), b=N.regulatory_label([F.lit(False)], [F.lit(True)]), c=N.regulatory_label([F.lit(None).cast("boolean")], [F.lit(False)]), d=N.constraint_label(F.lit(None).cast("double")))
    assert tuple(r) == ("Enhancer", "Promoter", None, "Unconstrained")


def test_chunks(spark):
    n, k = 11, 4
    got = [r.c for r in spark.range(n).select(chunks.chunk_of(F.col("id"), k, n).alias("c")).collect()]
    assert got == [1, 1, 2, 2, 3, 3, 4, 4, 1, 2, 3]


def array_inputs(spark, n=150, p=60, cause=30):
    rng = np.random.default_rng(5)
    g = rng.integers(0, 3, size=(p, n)).astype(float)
    dosages = spark.createDataFrame([(f"chr1_{1000 * (j + 1)}_A_G", "chr1", 1000 * (j + 1), g[j].tolist()) for j in range(p)], "variant_id string, chromosome string, position int, dosage array<double>")
    noise = rng.normal(size=(3, n))
    rows = [(f"x_ENSG{k}.1", "chr1", 1000 * c, (g[c - 1] * w + noise[k]).tolist()) for k, (c, w) in enumerate(((cause, 1.5), (cause + 5, 1.5), (cause, 0.0)))]
    return spark.createDataFrame(rows, "phenotype_id string, chromosome string, position int, values array<double>"), dosages, pd.DataFrame({"c": rng.normal(size=n)})


def test_fine_mapping_end_to_end(spark):
    phenotypes, dosages, covariates = array_inputs(spark)
    out = pipeline.fine_map(phenotypes, dosages, covariates, pipeline.FineMap(distance=20_000))
    rows = out["in_cs"].collect()
    assert {(r.molecular_trait_id, r.position) for r in rows} == {("x_ENSG0.1", 30_000), ("x_ENSG1.1", 35_000)}
    assert all(0.95 <= r.pip <= 1 and r.cs_size == 1 for r in rows)
    assert out["in_cs"].schema.fieldNames() == schemas.IN_CS.fieldNames()
    full = out["full"].where("molecular_trait_id = 'x_ENSG0.1'")
    assert full.columns == schemas.FULL.fieldNames() and full.count() == 41 and full.where("cs_index is null and cs_id = 'x_ENSG0.1_NA' and pip is null").count() == 40
    assert out["lbf"].columns == schemas.LBF.fieldNames() and out["sets"].count() == 2
    shared = pipeline.fine_map(phenotypes, dosages, covariates, pipeline.FineMap(distance=20_000, share_regions=True))["in_cs"].collect()
    key = lambda r: (r.molecular_trait_id, r.variant, round(r.pip, 6), round(r.z, 6))
    assert sorted(map(key, shared)) == sorted(map(key, rows))


def test_too_few_variants_give_nothing(spark):
    phenotypes, dosages, _ = array_inputs(spark)
    assert finemap.fit_phenotypes(phenotypes, dosages.limit(9)).isEmpty()


def test_shards(spark, tmp_path):
    good = spark.createDataFrame([("t", "chr1_1_A_G", 0.9)], "molecular_trait_id string, variant string, pip double")
    good.coalesce(1).write.parquet(f"{tmp_path}/a.parquet")
    sinks.write_empty(spark, f"{tmp_path}/b.parquet", schemas.IN_CS)
    (tmp_path / "c.parquet").write_bytes(b"garbage")
    paths = [f"{tmp_path}/{x}.parquet" for x in "abc"]
    rows = shards.read_shards(spark, paths, schemas.IN_CS).collect()
    assert len(rows) == 1 and rows[0].cs_id is None
    with pytest.raises(ValueError):
        shards.read_shards(spark, paths[1:], schemas.IN_CS)
    (tmp_path / "list").write_text("gs://b/x.parquet extra\n\n  gs://b/a.parquet\n")
    assert shards.manifest(spark, f"{tmp_path}/list") == ["gs://b/a.parquet", "gs://b/x.parquet"]


def test_readers(spark, tmp_path):
    text = "#chr\tstart\tend\tid\ts1\ts2\nchr1\t5\t6\tg1\t1.5\tNA\n"
    (tmp_path / "bed.tsv").write_text(text)
    (tmp_path / "bed.bgz").write_bytes(gzip.compress(text.encode()))
    for name in ("bed.tsv", "bed.bgz"):
        got = sorted((r.phenotype_id, r.sample_id, r.value) for r in tables.phenotype_matrix(spark, f"{tmp_path}/{name}").collect())
        assert got == [("g1", "s1", 1.5), ("g1", "s2", None)]
    (tmp_path / "cov.tsv").write_text("ID\ts1\ts2\nPC1\t1\t2\nGENETIC1\t3\t4\n")
    assert {r.sample_id: (r.PC1, r.GENETIC1) for r in tables.covariates(spark, f"{tmp_path}/cov.tsv").collect()} == {"s1": (1.0, 3.0), "s2": (2.0, 4.0)}
    (tmp_path / "d.tsv").write_text("CHROM\tPOS\tREF\tALT\ts1\n1\t10\tA\tG\t-1\n")
    assert tables.dosages(spark, f"{tmp_path}/d.tsv").first().variant_id == "chr1_10_A_G"
    (tmp_path / "g.gtf").write_text('#x\nchr1\thavana\tgene\t10\t20\t.\t-\t.\tgene_id "E1.2"; gene_type "p"; gene_name "N"\n')
    g = genomic.gtf(spark, f"{tmp_path}/g.gtf").first()
    assert (g.gene_id, g.gene_name, g.strand) == ("E1.2", "N", "-")


def test_bigwig(spark, tmp_path):
    block = zlib.compress(struct.pack("<IIIIIBBH", 0, 10, 20, 0, 0, 1, 0, 2) + struct.pack("<IIf", 10, 12, 0.5) + struct.pack("<IIf", 15, 20, -1.0))
    chroms = struct.pack("<IIIIQQ", 0x78CA8C91, 1, 4, 8, 1, 0) + struct.pack("<BBH", 1, 0, 1) + b"chr1" + struct.pack("<II", 0, 100)
    at = 64 + len(chroms)
    index = struct.pack("<IIQIIIIQII", 0x2468ACE0, 1, 1, 0, 10, 0, 20, 0, 1, 0) + struct.pack("<BBH", 1, 0, 1) + struct.pack("<IIIIQQ", 0, 10, 0, 20, at, len(block))
    head = struct.pack("<IHHQQQHHQQIQ", 0x888FFC26, 4, 0, 64, at, at + len(block), 0, 0, 0, 0, 32768, 0)
    (tmp_path / "x.bw").write_bytes(head + chroms + block + index)
    got = sorted((r.chromosome, r.start, r.end, r.score) for r in genomic.bigwig(spark, f"{tmp_path}/x.bw").collect())
    assert got == [("chr1", 11, 12, 0.5), ("chr1", 16, 20, -1.0)]


def test_text_sink_keeps_header_when_empty(spark, tmp_path):
    sinks.write_text(spark.createDataFrame([], schemas.SKEW), f"{tmp_path}/out", gz=True)
    assert spark.read.text(f"{tmp_path}/out").first()[0].split("\t") == schemas.SKEW.fieldNames()


def test_annotation(spark):
    fm = spark.createDataFrame([("x_ENSG1.2", "chr1_15_A_G", "chr1", 15, "A", "G", 0.9), ("x_ENSG9.1", "chr1_99_A_G", "chr1", 99, "A", "G", 0.1)], "molecular_trait_id string, variant string, chromosome string, position int, ref string, alt string, pip double")
    span = lambda *rows, extra="": spark.createDataFrame(list(rows), "chromosome string, start int, end int" + extra)
    tables_ = {
        "genes": spark.createDataFrame([("ENSG1.2", "G", "p", 10, 20, "-")], "gene_id string, gene_name string, gene_type string, start int, end int, strand string"),
        "elements": span(("chr1", 10, 20, "dELS,CTCF"), ("chr1", 15, 15, "PLS"), extra=", type string"),
        "promoters": span(("chr1", 90, 99)),
        "constraint": spark.createDataFrame([("ENSG1", True, 0.95), ("ENSG1", False, 0.1)], "gene_id string, canonical boolean, pli double"),
        "conservation": span(("chr1", 15, 15, 1.0, 1), ("chr1", 10, 30, 2.0, 2), extra=", score double, ordinal long"),
        "vat": spark.createDataFrame([("chr1", 15, "A", "G", "0.7", "7", "10")], "chrom string, pos int, ref string, alt string, gvs_afr_af string, gvs_afr_ac string, gvs_afr_an string"),
        "fold_changes": spark.createDataFrame([("ENSG1.7", "1:15_A_G", "0.5", "x", "1", 0), ("pid", "sid", "a", "b", "c", 1), ("ENSG1.7", "1:15_A_G", "9", "9", "9", 2)], "pid string, sid string, log2_aFC string, log2_aFC_lower string, log2_aFC_upper string, ordinal long"),
    }
    rows = pipeline.annotate(fm, **tables_).collect()
    first = [r for r in rows if r.position == 15]
    assert len(first) == 2 and {r.Annotation for r in first} == {"Enhancer", "Promoter"}
    r = first[0]
    assert (r.tss, r.dist_tss, r.gene_id, r.phylop, r.constraint) == (20, -5, "ENSG1", 2.0, "Constrained")
    assert r.gvs_max_af == pytest.approx(0.3) and r.log2_aFC == 0.5 and r.log2_aFC_lower is None
    assert [x.Annotation for x in rows if x.position == 99] == ["Promoter"]


def test_streaming_shards(spark, tmp_path):
    from locusmill.streaming.shards import arriving_shards, merge_arriving

    row = spark.createDataFrame([("t",)], "molecular_trait_id string")
    sinks.write_table(row.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.IN_CS if f.name != "molecular_trait_id"]), f"{tmp_path}/in", schemas.IN_CS)
    for _ in range(2):
        merge_arriving(arriving_shards(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_skew_background_is_the_cohort_less_the_admixed(spark):
    columns = "variant string, pip double, gvs_all_ac double, gvs_all_an double, gvs_afr_af double, gvs_afr_ac double, gvs_afr_an double, gvs_eur_af double, gvs_eur_ac double, gvs_eur_an double, gvs_oth_af double, gvs_oth_ac double, gvs_oth_an double"
    rows = [("v", 0.95, 100.0, 1000.0, 0.1, 10.0, 100.0, 0.05, 5.0, 100.0, 0.06, 6.0, 100.0), ("w", 0.95, 100.0, 1000.0, 0.1, 10.0, 100.0, 0.05, 5.0, 100.0, None, None, None)]
    got = {r.variant: r for r in skew.ancestry_skew(spark.createDataFrame(rows, columns)).collect()}
    # 10 of 100 against 100 - 6 - 10 of 1000 - 100 - 100, one added to each cell.
    want = kernels.fisher(11, 101, 85, 801)
    assert (got["v"].gvs_no_admixed_odds_ratio, got["v"].gvs_no_admixed_p_value) == pytest.approx(want)
    assert got["w"].gvs_no_admixed_p_value is None and got["w"].gvs_p_value is not None


def test_fold_changes_drop_column_types(spark):
    rows = [("<chr>", "chr1:5_A_G", "1", "1", "1", 0), ("G1.2", "<chr>", "1", "1", "1", 1), ("pid", "sid", "log2_aFC", "x", "x", 2), ("G1.2", "chr1:5_A_G", "0.5", "NA", "1", 3)]
    afc = spark.createDataFrame(rows, "pid string, sid string, log2_aFC string, log2_aFC_lower string, log2_aFC_upper string, ordinal int")
    assert [tuple(r) for r in annotate.clean_fold_changes(afc).collect()] == [("G1", "chr1_5_A_G", 0.5, None, 1.0)]


def test_counts_are_computed_once(spark):
    """Their plan may be an aggregate of the largest table; sizes, quartiles, ratios and the result read what it gave."""
    from locusmill.operators import crossval

    seen = spark.sparkContext.accumulator(0)

    def tell(frames):
        for pdf in frames:
            seen.add(len(pdf))
            yield pdf

    rows = [(f"p{i}", f"s{j}", float(1 + (i * 7 + j * 3) % 11)) for i in range(20) for j in range(3)]
    counts = spark.createDataFrame(rows, "phenotype_id string, sample_id string, value double").mapInPandas(tell, "phenotype_id string, sample_id string, value double")
    assert crossval.normalised_counts(counts).count() == 60 and seen.value == 60


def test_tables_of_nodes_are_not_sent_through_the_driver(spark):
    """Their files are small, as equal components compress well; in memory they are not."""
    from locusmill.sources.shared import stored

    step = stored(spark.range(1000).select(F.col("id").alias("u"), F.lit(0).cast("long").alias("up"), F.lit(1).cast("long").alias("degree")))
    edges = stored(spark.range(1000).select(F.col("id").alias("u"), F.col("id").alias("v")))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(graph._salted(step, step.select(F.col("u").alias("up"), F.col("up").alias("top")), "up", "u"))
    assert "SortMergeJoin" in plan(graph._relabelled(edges, step, "u", 1000))  # nodes of many edges alone go by broadcast
    columns = "cs_id string, molecular_trait_id string, group string, variant string, chromosome string, position int, z double, pip double, cs_size int"
    sets = stored(spark.createDataFrame([("a", "t", "g", "v", "c", 1, 4.0, 0.5, 3), ("b", "t", "g", "v", "c", 1, 4.0, 0.5, 3)], columns))
    found = graph.set_components(sets)
    assert plan(found).count("SortMergeJoin") >= 2 and {r.component for r in found.collect()} == {"a"}


@pytest.mark.parametrize("seed, at_once", [(0, 0), (1, 0), (2, 200_000)])
def test_connected_components_equal_brute_force(spark, seed, at_once, monkeypatch):
    import random

    monkeypatch.setattr(graph, "ONE_TASK", at_once)
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(150)] + [(i, i + 1) for i in range(500, 540)] + [(700, i) for i in range(701, 760)] + [(900, 900)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_additional_genotypes_reach_their_phenotype_alone(spark):
    rng = np.random.default_rng(2)
    n = 120
    g = rng.integers(0, 3, size=(20, n)).astype(float)
    sv = rng.integers(0, 3, size=n).astype(float)
    y = sv * 2 + rng.normal(size=n) * 0.3
    rows = [(f"t{k}", "chr1", 1000, (y if k == 1 else y + rng.normal(size=n)).tolist()) for k in (1, 2)]
    traits = spark.createDataFrame(rows, "phenotype_id string, chromosome string, position int, values array<double>")
    dosages = spark.createDataFrame([(f"chr1_{1000 + i}_A_G", "chr1", 1000 + i, g[i].tolist()) for i in range(20)], "variant_id string, chromosome string, position int, dosage array<double>")
    extra = spark.createDataFrame([("t1", "DEL_1", sv.tolist()), ("t9", "DEL_9", sv.tolist())], "phenotype_id string, variant_id string, dosage array<double>")
    for share in (False, True):
        o = pipeline.FineMap(distance=5000, share_regions=share)
        found = pipeline.fine_map(traits, dosages, None, o, additional=extra)["in_cs"].select("molecular_trait_id", "variant").collect()
        assert [tuple(r) for r in found] == [("t1", "DEL_1")]


def test_cross_validation_equals_an_independent_run(spark):
    """Folds, covariates, scores, effects, predictions and residuals, written out by hand."""
    from statistics import NormalDist

    rng = np.random.default_rng(7)
    n, p = 90, 25
    g = rng.integers(0, 3, size=(p, n)).astype(float)
    g[0, 3] = -1
    pcs = rng.normal(size=(n, 2))
    y = g[4] * 1.5 + pcs[:, 0] + rng.normal(size=n) * 0.4
    y[10] = np.nan
    names = [f"s{i}" for i in range(n)]
    folds = pd.DataFrame({"sample_id": names, "fold": [i % 3 + 1 for i in range(n)]})
    traits = spark.createDataFrame([("gene", "chr1", 5000, [None if v != v else float(v) for v in y])], "phenotype_id string, chromosome string, position int, values array<double>")
    dosages = spark.createDataFrame([(f"chr1_{1000 + i}_A_G", "chr1", 1000 + i, g[i].tolist()) for i in range(p)], "variant_id string, chromosome string, position int, dosage array<double>")
    allowed = spark.createDataFrame([(f"chrchr1_{1000 + i}_A_G",) for i in range(p) if i != 4], "x string")
    scores = [(k, "test" if f == k else "train", s, [float(pcs[i, 0]) + k]) for k in (1, 2, 3) for i, (s, f) in enumerate(zip(names, folds["fold"]))]
    components = spark.createDataFrame(scores, "fold int, split string, sample_id string, pcs array<double>")
    genetic = pd.DataFrame({"GENETIC_PC1": pcs[:, 1], "other": 1.0}, index=names)
    got = pipeline.cv_predict(traits, dosages, folds, components, genetic, allowed).toPandas()

    def normal(v):
        rank = np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])
        return np.array([NormalDist().inv_cdf((r - 0.5) / len(v)) for r in rank])

    for label, rows in ((0.0, range(p)), (0.01, [i for i in range(p) if i != 4])):
        for k in (1, 2, 3):
            own = got[(got.AF_threshold == label) & (got.Fold == k)].set_index("sample_id")
            train = [i for i in range(n) if folds["fold"][i] != k and i != 10]
            test = [i for i in range(n) if folds["fold"][i] == k and i != 10]
            c = np.column_stack([pcs[:, 0] + k, pcs[:, 1]])
            zy = normal(y[train])
            beta = np.linalg.solve(c[train].T @ c[train], c[train].T @ zy)
            observed = normal(y[test]) - c[test] @ beta
            assert sorted(own.index) == sorted(names[i] for i in test) and set(own.Gene) == {"gene"}
            assert np.allclose([own.Observed[names[i]] for i in test], observed)
            x = np.array([[g[j, i] for i in train] for j in rows])
            x[x == -1] = np.nan
            x = np.where(np.isnan(x), np.nanmean(x, axis=1)[:, None], x)
            x = x - x.mean(axis=1)[:, None]
            both = np.column_stack([c[train], np.ones(len(train))])
            hat = np.eye(len(train)) - both @ np.linalg.pinv(both)
            fit = kernels.single_effects((hat @ x.T), hat @ zy)
            guess = g[np.ix_(list(rows), test)].T @ fit.posterior()[0]
            if label == 0.0:
                assert np.allclose([own.Predicted[names[i]] for i in test], guess, atol=1e-6) and np.corrcoef(guess, observed)[0, 1] > 0.5
            else:  # without the cause there is no credible set, so the prediction is 0
                assert (own.Predicted == 0).all() or np.allclose([own.Predicted[names[i]] for i in test], guess, atol=1e-6)


def test_cross_validation_by_blocks_equals_fits_of_samples(monkeypatch):
    """Products of blocks against copies of the samples: missing dosages in many variants, variants in any order, and little memory."""
    import tracemalloc

    rng = np.random.default_rng(11)
    p, n = 40, 12_000
    d = rng.integers(0, 3, size=(p, n)).astype(float)
    d[7] = 0.0
    for v, missing in ((1, -1), (12, -1), (5, np.nan), (30, -1)):
        d[v, rng.random(n) < 0.1] = missing
    c = rng.normal(size=(n, 2))
    y = np.nan_to_num(d[12]) - d[21] + c[:, 0] + rng.normal(size=n)
    fold = np.arange(n) % 3
    train, test = fold != 1, fold == 1
    order = rng.permutation(p)
    sets = [order, order[order % 2 == 0]]
    there = ~(np.isnan(d) | (d == -1))
    base = np.array([x[ok].mean() for x, ok in zip(d, there)])
    monkeypatch.setattr(crossval, "BLOCK_CELLS", 30_000)
    tracemalloc.start()
    guesses, seen, observed = crossval._predict_fold(y, d, sets, base, ~there.all(axis=1), train, test, c, finemap.Options())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < d.nbytes
    score = kernels.normal_scores(y[train])
    assert np.allclose(seen, kernels.normal_scores(y[test])) and np.allclose(observed, seen - c[test] @ kernels.ols(score, c[train]))
    basis = kernels.residual_basis(c[train])
    for guess, some in zip(guesses, sets):
        keep, x = kernels.clean_dosages(d[some][:, train])
        fit = kernels.single_effects(kernels.residuals(basis, x.T), kernels.residuals(basis, score))
        want = d[some][keep][:, test].T @ fit.posterior()[0]
        assert np.allclose(guess, want, atol=1e-6, equal_nan=True) and np.nanstd(guess) > 0.1


def test_cross_validation_by_blocks_of_rows_equals_one_task_a_phenotype(spark, monkeypatch):
    """Missing dosages and values, a sample without components, equal ids, a fold without enough samples; no row holds a window's dosages."""
    from functools import partial

    from locusmill.operators import crossblocks

    rng = np.random.default_rng(3)
    n, p = 120, 30
    g = rng.integers(0, 3, size=(p, n)).astype(float)
    g[2, :9], g[4, 50], g[5, 7], g[9] = -1, -1, np.nan, 0.0
    pcs = rng.normal(size=(n, 2))
    names = [f"s{i}" for i in range(n)]
    folds = pd.DataFrame({"sample_id": names, "fold": [i % 3 + 1 for i in range(n)]})
    value = lambda y: [None if v != v else float(v) for v in y]
    y = g[4] * 1.5 + g[20] + pcs[:, 0] + rng.normal(size=n) * 0.4
    y[10] = np.nan
    few = np.where(np.arange(n) < 3, np.arange(n) * 1.0, np.nan)
    traits = spark.createDataFrame([("a", "chr1", 5000, value(y)), ("b", "chr1", 900_000, value(g[25] - y)), ("few", "chr1", 5000, value(few)), ("far", "chr9", 1, value(y))], "phenotype_id string, chromosome string, position int, values array<double>")
    rows = [(f"chr1_{1000 + i}_A_G", "chr1", 1000 + (i if i < 12 else (i - 11) * 50_000), value(g[i])) for i in range(p)]
    rows.append((rows[4][0], "chr1", 1004, value(g[21])))
    dosages = spark.createDataFrame(rows, "variant_id string, chromosome string, position int, dosage array<double>").repartition(3)
    allowed = spark.createDataFrame([(r[0],) for r in rows if r[0] != "chr1_1004_A_G"], "x string")
    scores = [(k, "x", s, [float(pcs[i, 0]) + k] * k) for k in (1, 2, 3) for i, s in enumerate(names) if i != 33]
    components = spark.createDataFrame(scores, "fold int, split string, sample_id string, pcs array<double>")
    genetic = pd.DataFrame({"GENETIC_PC1": pcs[:, 1], "other": 1.0}, index=names)
    frames = []
    for most in (1000, 0):
        monkeypatch.setattr(crossval, "MOST_SAMPLES", most)
        monkeypatch.setattr(crossblocks, "cross_validate_by_blocks", partial(crossblocks.cross_validate_by_blocks, block=17, tile=11))
        for args in ((components, genetic, allowed), ()):
            got = pipeline.cv_predict(traits, dosages, folds, *args, distance=600_000)
            packed = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "collect_list" in x and "dosage" in x]
            assert bool(packed) == (most > 0)
            frames.append(got.toPandas().sort_values(["Gene", "AF_threshold", "Fold", "sample_id"]).reset_index(drop=True))
    for one, two in zip(frames[:2], frames[2:]):
        assert len(one) > 200 and set(one.Gene) >= {"a", "b"} and one.Predicted.std() > 0.1
        pd.testing.assert_frame_equal(one, two, check_dtype=False, rtol=1e-6, atol=1e-8)


def test_least_squares_of_products():
    c = np.random.default_rng(1).normal(size=(50, 3)) * [1, 1e-6, 1e3]
    y = c @ [1.0, 2e6, 3e-3] + 0.1
    for x in (c, np.column_stack([c[:, 0], c[:, 0], c[:, 2] / 1e3]), np.zeros((50, 2)), c[:, :0]):
        assert np.allclose(kernels.ols_of_products(x.T @ x, x.T @ y), kernels.ols(y, x))


def test_cross_validation_edges(spark):
    traits = spark.createDataFrame([("a", "chr1", 1, [1.0, None, None, 2.0])], "phenotype_id string, chromosome string, position int, values array<double>")
    dosages = spark.createDataFrame([("chr1_1_A_G", "chr1", 1, [0.0, 1.0, 2.0, 0.0])], "variant_id string, chromosome string, position int, dosage array<double>")
    folds = pd.DataFrame({"sample_id": list("wxyz"), "fold": [1, 2, 1, 2]})
    assert pipeline.cv_predict(traits, dosages, folds).count() == 0
    assert pipeline.cv_predict(traits.limit(0), dosages, folds).count() == 0


def test_bigwig_regions_prune_blocks(spark, tmp_path):
    for order in "<>":
        blocks = [zlib.compress(struct.pack(order + "IIIIIBBH", 0, s, s + 10, 0, 0, 1, 0, 1) + struct.pack(order + "IIf", s, s + 5, s / 2)) for s in (10, 1000)]
        chroms = struct.pack(order + "IIIIQQ", 0x78CA8C91, 1, 4, 8, 1, 0) + struct.pack(order + "BBH", 1, 0, 1) + b"chr1" + struct.pack(order + "II", 0, 5000)
        at = [64 + len(chroms), 64 + len(chroms) + len(blocks[0])]
        leaves = b"".join(struct.pack(order + "IIIIQQ", 0, s, 0, s + 10, a, len(b)) for s, a, b in zip((10, 1000), at, blocks))
        index = struct.pack(order + "IIQIIIIQII", 0x2468ACE0, 2, 2, 0, 10, 0, 1010, 0, 1, 0) + struct.pack(order + "BBH", 1, 0, 2) + leaves
        head = struct.pack(order + "IHHQQQHHQQIQ", 0x888FFC26, 4, 0, 64, at[0], at[1] + len(blocks[1]), 0, 0, 0, 0, 32768, 0)
        (tmp_path / "y.bw").write_bytes(head + chroms + b"".join(blocks) + index)
        rows = lambda **k: sorted((r.chromosome, r.start, r.end, r.score) for r in genomic.bigwig(spark, f"{tmp_path}/y.bw", **k).collect())  # noqa: E731, B023
        assert rows() == [("chr1", 11, 15, 5.0), ("chr1", 1001, 1005, 500.0)]
        assert rows(regions=[("chr1", 1, 3), ("chr1", 1005, 1005), ("chr2", 1, 9)]) == [("chr1", 1001, 1005, 500.0)]
        assert rows(regions=[]) == []


def test_shards_keep_order_and_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(i,) for i in range(25)], "k int").coalesce(1)
    names = sinks.write_sharded(rows, f"{tmp_path}/s", 10)
    assert len(names) == 3 and shards.manifest_list(spark, f"{tmp_path}/s.manifest") == names
    back = shards.concatenate(spark, names[::-1])
    assert [int(r.k) for r in back.collect()] == [*range(20, 25), *range(10, 20), *range(10)]


def test_shards_beyond_the_padded_numbers_keep_order(spark, tmp_path):
    rows = spark.range(1203).toDF("k").coalesce(1)
    names = sinks.write_sharded(rows, f"{tmp_path}/s", 1)
    assert len(names) == 1203 and shards.manifest_list(spark, f"{tmp_path}/s.manifest") == names
    assert [sinks.part_order(n)[1] for n in (x.rsplit("/", 1)[1] for x in names)] == list(range(1203))
    assert [int(r.k) for r in shards.concatenate(spark, names).collect()] == list(range(1203))
    assert [int(r.k) for r in shards.concatenate(spark, [f"{tmp_path}/s"]).collect()] == list(range(1203))


def test_sample_group_and_summary(spark):
    people = spark.createDataFrame([("a", "Test"), ("b", "Train")], "sample_id string, qtl_group string")
    assert [r.sample_id for r in select.sample_group(people, "Test").collect()] == ["a"]
    assert select.sample_group(people.drop("qtl_group")).count() == 2 and select.sample_group(people.drop("qtl_group"), "x").count() == 0
    assert select.summary_counts(people, distinct=["qtl_group"]).first()[:] == (2, 2)


def test_memory_report():
    from locusmill.functions import memory

    space = {"big": np.zeros(1000), "small": 1, "frame": pd.DataFrame({"x": [1.0] * 10})}
    assert memory.largest(space, 1) == [("big", "ndarray", 8000)] and [r[0] for r in memory.named(space, ["small", "gone", "frame"])] == ["small", "frame"]
