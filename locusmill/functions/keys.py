"""Identifiers as Column expressions: chromosomes, variants, clusters, genes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_chr(c: Column) -> Column:
    """Any run of leading `chr`, in any case, taken off."""
    return F.regexp_replace(c, "^(?i:chr)+", "")


def single_chr(c: Column) -> Column:
    """A doubled leading `chr` made single."""
    return F.regexp_replace(c, "^chrchr", "chr")


def prefixed_chr(c: Column) -> Column:
    """Every `chr` taken out and one put in front."""
    return F.concat(F.lit("chr"), F.replace(c, F.lit("chr"), F.lit("")))


def chr_rank(c: Column) -> Column:
    """Natural order of chromosomes: numbers by value, then X, Y, M, then the rest."""
    bare = F.upper(normalize_chr(c))
    named = F.when(bare == "X", 23).when(bare == "Y", 24).when(bare.isin("M", "MT"), 25)
    return F.coalesce(bare.try_cast("int"), named, F.lit(1000)).cast("int")


def variant_part(v: Column, i: int) -> Column:
    """Part i (from 0) of chrom_pos_ref_alt; null where there are fewer."""
    return F.get(F.split(v, "_"), F.lit(i))


def variant_position(v: Column) -> Column:
    return variant_part(v, 1).try_cast("int")


def variant_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws("_", chrom, pos.cast("string"), ref, alt)


def cluster_id(phenotype: Column) -> Column:
    """The first `clu_...` up to a colon, else the phenotype itself."""
    found = F.regexp_extract(phenotype, "clu_[^:]+", 0)
    return F.when(found != "", found).otherwise(phenotype)


def gene_of_phenotype(phenotype: Column) -> Column:
    """What follows the last underscore."""
    return F.regexp_replace(phenotype, "^.*_", "")


def unversioned(gene: Column) -> Column:
    """What stands before the first dot."""
    return F.regexp_replace(gene, r"\..*$", "")


def fold_change_variant(sid: Column) -> Column:
    """chr:pos_ref_alt as chrN_pos_ref_alt."""
    return prefixed_chr(F.regexp_replace(sid, "^([^:]*):", "$1_"))


def set_id(phenotype: Column, index: Column) -> Column:
    """Phenotype and effect of a credible set; a missing effect is written NA."""
    return F.concat(phenotype, F.lit("_"), F.coalesce(index, F.lit("NA")))
