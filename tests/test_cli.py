import numpy as np

from locusmill import schemas
from locusmill.plans import cli


def write_inputs(folder, n=80, p=30):
    rng = np.random.default_rng(4)
    g = rng.integers(0, 3, size=(p, n))
    samples = [f"s{i}" for i in range(n)]
    lines = ["\t".join(["CHROM", "POS", "REF", "ALT", *samples])]
    lines += ["\t".join(["chr1", str(1000 * (j + 1)), "A", "G", *map(str, g[j])]) for j in range(p)]
    (folder / "dose.tsv").write_text("\n".join(lines) + "\n")
    y = g[9] * 2.0 + rng.normal(size=n) * 0.5
    rows = [["chr1", "10000", "10001", "x_ENSG1.1", *map(str, y)], ["chr1", "12000", "12001", "x_ENSG2.1", *map(str, rng.normal(size=n))]]
    (folder / "bed.tsv").write_text("\n".join("\t".join(r) for r in [["#chr", "start", "end", "id", *samples], *rows]) + "\n")
    (folder / "qtl.tsv").write_text("phenotype_id\tqval\nx_ENSG1.1\t0.001\nx_ENSG2.1\t0.9\n")
    (folder / "samples.tsv").write_text("sample_id\n" + "\n".join(reversed(samples)) + "\n")
    (folder / "cov.tsv").write_text("\t".join(["ID", *samples]) + "\n" + "\t".join(["PC1", *map(str, rng.normal(size=n))]) + "\n" + "\t".join(["ZERO", *["1"] * n]) + "\n")
    (folder / "anc.tsv").write_text("research_id\tancestry_pred_other\n" + "\n".join(f"{s}\t{'eur' if i % 2 else 'afr'}" for i, s in enumerate(samples)) + "\n")


def test_finemap_and_merge_commands(spark, tmp_path):
    write_inputs(tmp_path)
    f = lambda name: f"{tmp_path}/{name}"
    cli.run(spark, ["finemap", "--phenotypes", f("bed.tsv"), "--permutations", f("qtl.tsv"), "--dosages", f("dose.tsv"), "--sample_list", f("samples.tsv"), "--covariates", f("cov.tsv"), "--ancestry", f("anc.tsv"), "--MAF", "0.01", "--select_top_phenotype_per_cluster", "true", "--out_prefix", f("out")])
    rows = spark.read.parquet(f("out.parquet"))
    assert rows.columns == schemas.IN_CS.fieldNames() and [(r.molecular_trait_id, r.position) for r in rows.collect()] == [("x_ENSG1.1", 10_000)]
    assert spark.read.parquet(f("out.full.parquet")).count() == 30 == spark.read.parquet(f("out.lbf_variable.parquet")).count()
    (tmp_path / "list").write_text(f("out.parquet") + "\n")
    cli.run(spark, ["merge", "--file_paths", f("list"), "--out_prefix", f("merged")])
    assert spark.read.parquet(f("merged.parquet")).count() == 1
    assert spark.read.text(f("merged.tsv.gz")).first()[0].split("\t")[:2] == ["molecular_trait_id", "variant"]


def test_prepare_and_extract_commands(spark, tmp_path):
    write_inputs(tmp_path)
    f = lambda name: f"{tmp_path}/{name}"
    cli.run(spark, ["prepare", "--phenotypes", f("bed.tsv"), "--permutations", f("qtl.tsv"), "--dosages", f("dose.tsv"), "--phenotype_id", "x_ENSG1.1", "--window", "3000", "--out_prefix", f("p")])
    assert {r.position for r in spark.read.parquet(f("p.dosages")).select("position").collect()} == {1000 * i for i in range(7, 14)}
    cli.run(spark, ["extract", "--phenotypes", f("bed.tsv"), "--permutations", f("qtl.tsv"), "--phenotype_id", "ENSG", "--match", "contains", "--out_prefix", f("e")])
    assert [r[0] for r in spark.read.text(f("e.ids")).collect()] == ["x_ENSG1.1", "x_ENSG2.1"]


def test_skew_command(spark, tmp_path):
    head = "variant pip gvs_all_ac gvs_all_an gvs_afr_af gvs_afr_ac gvs_afr_an gvs_oth_af gvs_oth_ac gvs_oth_an".split()
    for pip, n in (("0.95", 2), ("0.1", 1)):
        (tmp_path / "in.tsv").write_text("\t".join(head) + "\n" + "\t".join(["v", pip, "10", "100", "0.4", "4", "10", "NA", "1", "10"]) + "\n")
        cli.run(spark, ["skew", "--input", f"{tmp_path}/in.tsv", "--out_prefix", f"{tmp_path}/o{n}"])
        assert spark.read.text(f"{tmp_path}/o{n}.skew.tsv.gz").count() == n


def test_cv_commands(spark, tmp_path):
    write_inputs(tmp_path)
    f = lambda name: f"{tmp_path}/{name}"
    rng = np.random.default_rng(1)
    samples = [f"s{i}" for i in range(80)]
    counts = ["\t".join(["Name", "Description", *samples])] + ["\t".join([f"g{j}", "x", *map(str, rng.integers(1, 500, 80))]) for j in range(40)]
    (tmp_path / "counts.tsv").write_text("\n".join(counts) + "\n")
    cli.run(spark, ["cv_prepare", "--counts", f("counts.tsv"), "--ancestry", f("anc.tsv"), "--n_folds", "3", "--out_prefix", f("m")])
    (tmp_path / "allowed.tsv").write_text("variant\n" + "\n".join(f"chr1_{1000 * (j + 1)}_A_G" for j in range(0, 30)) + "\n")
    cli.run(spark, ["cv_predict", "--phenotypes", f("bed.tsv"), "--permutations", f("qtl.tsv"), "--dosages", f("dose.tsv"), "--covariates", f("cov.tsv"), "--cv_meta", f("m.cv"), "--variant_list", f("allowed.tsv"), "--phenotype_id", "x_ENSG1.1", "--out_prefix", f("x")])
    rows = spark.read.options(sep="\t", header=True).csv(f("x_SusiePredictions.tsv")).collect()
    assert len(rows) == 160 and {r.Gene for r in rows} == {"x_ENSG1.1"} and {r.AF_threshold for r in rows} == {"0.0", "0.01"}
    assert {r.sample_id for r in rows} == set(samples)


def test_finemap_with_additional_genotypes(spark, tmp_path):
    write_inputs(tmp_path)
    f = lambda name: f"{tmp_path}/{name}"
    samples = [f"s{i}" for i in range(70)]  # ten samples are not in it
    (tmp_path / "sv.tsv").write_text("\t".join(["variant_id", "phenotype_id", "feature_type", *samples]) + "\n" + "\t".join(["DEL_1", "x_ENSG1.1", "sv", *[str(i % 3) for i in range(70)]]) + "\n")
    cli.run(spark, ["finemap", "--phenotypes", f("bed.tsv"), "--permutations", f("qtl.tsv"), "--dosages", f("dose.tsv"), "--sample_list", f("samples.tsv"), "--phenotype_id", "x_ENSG1.1", "--additional_genotypes", f("sv.tsv"), "--out_prefix", f("o")])
    assert {r.variant for r in spark.read.parquet(f("o.parquet")).collect()} == {"chr1_10000_A_G"}
    assert "DEL_1" in {r.variant for r in spark.read.parquet(f("o.full.parquet")).collect()}
