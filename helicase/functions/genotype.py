"""Genotype scalars as Columns.  A genotype is text a/b or a|b; what is not that has no alleles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def alleles(gt: Column) -> Column:
    """struct<a1 int, a2 int>; both null unless there are exactly two integer alleles (a bar wins over a slash)."""
    parts = F.when(gt.contains("|"), F.split(gt, "[|]")).otherwise(F.split(gt, "/"))
    one, two = (F.get(parts, i).try_cast("int") for i in (0, 1))
    known = (F.size(parts) == 2) & one.isNotNull() & two.isNotNull()
    return F.struct(F.when(known, one).alias("a1"), F.when(known, two).alias("a2"))


def _pair(gt: Column, *pairs: tuple[int, int]) -> Column:
    g = alleles(gt)
    hits = [(g["a1"] == a) & (g["a2"] == b) for a, b in pairs]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return F.coalesce(out, F.lit(False))


def is_het(gt: Column) -> Column:
    return _pair(gt, (0, 1), (1, 0))


def is_hom_alt(gt: Column) -> Column:
    return _pair(gt, (1, 1))


def is_ref(gt: Column) -> Column:
    return _pair(gt, (0, 0))


def is_variant(gt: Column) -> Column:
    return is_het(gt) | is_hom_alt(gt)


def is_missing(gt: Column) -> Column:
    g = alleles(gt)
    return g["a1"].isNull() | g["a2"].isNull()


def is_phased(gt: Column) -> Column:
    return F.coalesce(gt.contains("|"), F.lit(False))


def allele_count(gt: Column) -> Column:
    """Alternate alleles among 0/0, 0/1, 1/0, 1/1; anything else counts 0."""
    return F.when(is_hom_alt(gt), 2).when(is_het(gt), 1).otherwise(0)


def genotype_type(gt: Column) -> Column:
    return F.when(is_ref(gt), "ref").when(is_het(gt), "het").when(is_hom_alt(gt), "hom_alt").otherwise("missing")


def encoded(gt: Column) -> Column:
    """-1 for what is not 0/0, 0/1, 1/0 or 1/1."""
    return F.when(is_ref(gt), 0).when(is_het(gt), 1).when(is_hom_alt(gt), 2).otherwise(-1)


def association_dosage(gt: Column) -> Column:
    """Dosage for regression: any allele above 1 makes it 1; a missing allele makes it null."""
    g = alleles(gt)
    return F.when(g["a1"].isNull(), F.lit(None).cast("int")).when((g["a1"] > 1) | (g["a2"] > 1), 1).otherwise(g["a1"] + g["a2"])


def is_multi_allelic(gt: Column) -> Column:
    g = alleles(gt)
    return F.coalesce((g["a1"] > 1) | (g["a2"] > 1), F.lit(False))


def could_be_de_novo(child: Column, father: Column, mother: Column) -> Column:
    return is_variant(child) & is_ref(father) & is_ref(mother)


def is_mendelian_consistent(child: Column, father: Column, mother: Column) -> Column:
    """Whether one child allele can come from each parent; true where any of the three is missing."""
    c, f, m = alleles(child), alleles(father), alleles(mother)

    def has(p: Column, a: Column) -> Column:
        return (p["a1"] == a) | (p["a2"] == a)

    fits = (has(f, c["a1"]) & has(m, c["a2"])) | (has(f, c["a2"]) & has(m, c["a1"]))
    return F.coalesce(fits, F.lit(True))


def variant_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat(chrom.cast("string"), F.lit(":"), pos.cast("string"), F.lit(":"), ref, F.lit(">"), alt)
