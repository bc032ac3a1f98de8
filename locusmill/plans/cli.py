"""Command line: `python -m locusmill.plans.cli <command> ...`; every command reads files and writes files."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import crossval, select
from ..operators.reshape import to_long
from ..schemas import FULL, IN_CS, LBF
from ..sources import genomic, shards, sinks, tables
from ..sources.bigwig import regions_of
from . import pipeline


def _flag(text: str) -> bool:
    return text.strip().lower() in {"true", "t", "1", "yes"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="locusmill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, **options):
        c = sub.add_parser(name)
        for option, (default, kind) in options.items():
            c.add_argument(f"--{option}", default=default, type=kind, required=default is ...)
        return c

    need = ...
    prep = dict(phenotypes=(need, str), permutations=(need, str), dosages=(need, str), phenotype_id=(None, str), match=("exact", str), fdr=(0.05, float), window=(1_000_000, int), select_top_phenotype_per_cluster=(False, _flag), top_phenotype_pvalue_column=("qval", str))
    fit = dict(covariates=(None, str), sample_list=(need, str), cisdistance=(1_000_000, int), MAF=(0.0, float), ancestry=(None, str), variant_list=(None, str), reuse_genotype_matrix=(False, _flag), write_full=(True, _flag), additional_genotypes=(None, str))
    command("prepare", **prep, out_prefix=(need, str))
    command("extract", phenotypes=(need, str), permutations=(need, str), phenotype_id=(need, str), match=("exact", str), add_skip_row=(False, _flag), out_prefix=(need, str))
    command("finemap", **prep, **fit, out_prefix=(need, str))
    command("cv_prepare", counts=(need, str), ancestry=(need, str), n_folds=(5, int), out_prefix=(need, str))
    command("cv_predict", phenotypes=(need, str), permutations=(need, str), dosages=(need, str), covariates=(None, str), cv_meta=(need, str), variant_list=(None, str), phenotype_id=(need, str), match=("exact", str), cisdistance=(1_000_000, int), threshold=(0.01, float), out_prefix=(need, str))
    command("merge", file_paths=(need, str), out_prefix=(need, str))
    annotate = dict(genes=(need, str), elements=(need, str), promoters=(need, str), constraint=(need, str), conservation=(need, str), frequencies=(need, str), fold_changes=(None, str), group=(None, str))
    command("annotate", input=(need, str), **annotate, out_prefix=(need, str))
    skew = dict(pip=(0.9, float), admixed=("oth", str), keep_columns=(False, _flag), rows_per_file=(0, int))
    command("skew", input=(need, str), **skew, out_prefix=(need, str))
    command("aggregate", file_paths=(need, str), **annotate, **skew, out_prefix=(need, str))
    return p


def _prepare(a) -> pipeline.Prepare:
    return pipeline.Prepare(a.phenotype_id, a.match, a.fdr, a.window, a.select_top_phenotype_per_cluster, a.top_phenotype_pvalue_column)


def _annotation(spark: SparkSession, a, variants) -> dict:
    """The side inputs of annotation; of the scores, only what lies near the variants is read."""
    found = {
        "genes": genomic.gtf(spark, a.genes), "elements": tables.regulatory_elements(spark, a.elements), "promoters": tables.intervals(spark, a.promoters), "constraint": tables.constraint(spark, a.constraint),
        "conservation": genomic.bigwig(spark, a.conservation, regions_of(variants)), "vat": tables.frequencies(spark, a.frequencies).drop("variant"), "fold_changes": tables.fold_changes(spark, a.fold_changes) if a.fold_changes else None,
    }
    for name, df in found.items():  # side inputs fail early
        if df is not None and name in ("genes", "elements", "constraint", "vat"):
            select.require_rows(df, name)
    return found | {"group": a.group}


def _phenotype_arrays(spark: SparkSession, a, samples: list[str]):
    """Phenotypes with values, dosages and covariates, all in the order of `samples`."""
    rows = tables.phenotype_matrix(spark, a.phenotypes, samples)
    packed = rows.groupBy("phenotype_id", "chromosome", "position").agg(F.map_from_entries(F.collect_list(F.struct("sample_id", "value"))).alias("m"))
    order = F.array(*[F.lit(s) for s in samples])
    bed = packed.select("phenotype_id", F.concat(F.lit("chr"), F.regexp_replace("chromosome", "^(?i:chr)+", "")).alias("chromosome"), "position", F.transform(order, lambda s: F.try_element_at("m", s)).alias("values"))
    raw = tables.read_delimited(spark, a.dosages)
    dosages = tables.dosages(spark, a.dosages)
    columns = raw.columns[4:]
    places = F.array(*[F.lit(columns.index(s)) for s in samples])
    dosages = dosages.withColumn("dosage", F.transform(places, lambda i: F.get("dosage", i)))
    covariates = None
    if a.covariates:
        covariates = tables.covariates(spark, a.covariates).toPandas().set_index("sample_id").loc[samples].astype(float)
        covariates = covariates.loc[:, covariates.std(ddof=1) != 0]
    return bed, dosages, covariates


def run(spark: SparkSession, argv: list[str]) -> None:
    a = parser().parse_args(argv)
    out = a.out_prefix
    if a.command in ("prepare", "extract"):
        bed = tables.phenotype_matrix(spark, a.phenotypes)
        qtl = tables.permutations(spark, a.permutations)
        if a.command == "extract":
            found = pipeline.extract_phenotypes(bed, qtl, pipeline.Prepare(a.phenotype_id, a.match), a.add_skip_row)
            sinks.write_ids(found["ids"], "phenotype_id", f"{out}.ids")
        else:
            found = pipeline.prepare(bed, qtl, tables.dosages(spark, a.dosages), _prepare(a))
            sinks.write_dosages(found["dosages"], f"{out}.dosages")
        sinks.write_table(found["bed"], f"{out}.bed")
        sinks.write_table(found["permutations"], f"{out}.permutations")
    elif a.command == "finemap":
        samples, additional = tables.sample_list(spark, a.sample_list), None
        if a.additional_genotypes:
            there = set(tables.read_delimited(spark, a.additional_genotypes).columns[3:])
            samples = [s for s in samples if s in there]
            if not samples:
                raise ValueError("the genotype tables share no sample")
            additional = tables.genotype_arrays(spark, a.additional_genotypes, samples)
        bed, dosages, covariates = _phenotype_arrays(spark, a, samples)
        found = pipeline.prepare(bed, tables.permutations(spark, a.permutations), dosages, _prepare(a))
        allowed = tables.variant_list(spark, a.variant_list) if a.variant_list else None
        common = None
        if a.ancestry and a.MAF > 0 and allowed is None:
            common = _common(spark, a, found["dosages"], samples)
        o = pipeline.FineMap(a.cisdistance, a.MAF, a.reuse_genotype_matrix)
        result = pipeline.fine_map(found["bed"], found["dosages"], covariates, o, allowed, common, additional)
        sinks.write_table(result["fits"], f"{out}.fits")
        fits = spark.read.parquet(f"{out}.fits")  # fitted once, flattened three times
        from ..operators import finemap

        sinks.write_table(finemap.in_credible_sets(fits), f"{out}.parquet", IN_CS)
        sinks.write_table(finemap.bayes_factors(fits), f"{out}.lbf_variable.parquet", LBF)
        if a.write_full:
            sinks.write_table(finemap.full_table(fits), f"{out}.full.parquet", FULL)
    elif a.command == "cv_prepare":
        counts = tables.read_delimited(spark, a.counts)
        name, _, *samples = counts.columns
        values = counts.select(F.col(f"`{name}`").alias("phenotype_id"), *[F.col(f"`{s}`").try_cast("double").alias(s) for s in samples])
        people = tables.ancestry(spark, a.ancestry).join(F.broadcast(spark.createDataFrame([(s,) for s in samples], "sample_id string")), "sample_id")
        found = pipeline.cv_prepare(to_long(values, ["phenotype_id"], samples), people, a.n_folds)
        crossval.write_cv(found["components"], found["folds"], f"{out}.cv")
        sinks.write_table(found["values"], f"{out}.cpm")
    elif a.command == "cv_predict":
        fold_table, components = crossval.read_cv(spark, a.cv_meta)
        folds = select.sample_group(fold_table).select("sample_id", "fold").toPandas().sort_values("sample_id").reset_index(drop=True)
        bed, dosages, covariates = _phenotype_arrays(spark, a, folds["sample_id"].tolist())
        qtl = tables.permutations(spark, a.permutations)
        found = pipeline.extract_phenotypes(bed, qtl, pipeline.Prepare(a.phenotype_id, a.match))
        allowed = tables.variant_list(spark, a.variant_list) if a.variant_list else None
        result = pipeline.cv_predict(found["bed"], dosages, folds, components, covariates, allowed, a.threshold, a.cisdistance)
        sinks.write_text(result, f"{out}_SusiePredictions.tsv")
    elif a.command == "merge":
        pipeline.merge_shards(spark, shards.manifest(spark, a.file_paths), out)
    elif a.command == "annotate":
        variants = spark.read.schema(IN_CS).parquet(a.input)
        sinks.write_text(pipeline.annotate(variants, **_annotation(spark, a, variants)), f"{out}.annotated.tsv")
    elif a.command == "skew":
        df = tables.read_delimited(spark, a.input, sep=tables.sniff_separator(spark, a.input))
        result = pipeline.ancestry_skew(df, pipeline.Skew(a.pip, a.admixed, a.keep_columns))
        if a.rows_per_file:
            sinks.write_sharded(result, f"{out}.skew.tsv", a.rows_per_file)
        else:
            sinks.write_text(result, f"{out}.skew.tsv.gz", gz=True)
    else:
        paths = shards.manifest(spark, a.file_paths)
        found = pipeline.aggregate_annotate_skew(spark, paths, _annotation(spark, a, shards.read_shards(spark, paths, IN_CS)), pipeline.Skew(a.pip, a.admixed, a.keep_columns))
        sinks.write_text(found["annotated"], f"{out}.annotated.tsv")
        sinks.write_text(found["skew"], f"{out}.skew.tsv.gz", gz=True)


def _common(spark: SparkSession, a, dosages, samples: list[str]):
    """Variants above the threshold in some ancestry, from the array form."""
    from ..operators import genotypes

    names = spark.createDataFrame(list(enumerate(samples)), "i int, sample_id string")
    groups = names.join(tables.ancestry(spark, a.ancestry), "sample_id").select("i", "ancestry")
    long = dosages.select("variant_id", F.posexplode("dosage").alias("i", "dosage")).join(F.broadcast(groups), "i")
    return genotypes.common_variants(genotypes.allele_frequencies(long), a.MAF)


if __name__ == "__main__":
    import sys

    run(SparkSession.builder.appName("locusmill").getOrCreate(), sys.argv[1:])
