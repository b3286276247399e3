"""Inheritance on long calls: patterns, compound heterozygotes, segregation, prioritisation.

Tables.  calls: variant_id, gene, sample_id, dosage (0/0 has no row, a missing genotype a row with null).  pedigree:
sample_id, father_id, mother_id, sex, affected (boolean), place (order of samples).  variants: variant_id, chrom.

Every rule looks at a child and its two parents, so calls are first turned into trios: one row per variant and child
of whom anyone carries or misses the variant.  What all other trios (all 0/0) add to a segregation count is a
constant of the pedigree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helicase.model import CHROM_MT, CHROM_X
from helicase.sources.store import materialised

# Rank of each pattern.
PRIORITY = {
    "de_novo": 100, "compound_heterozygous": 90, "autosomal_recessive": 80, "x_linked_recessive": 75, "x_linked_dominant": 70, "autosomal_dominant": 60,
    "mitochondrial": 55, "de_novo_candidate": 50, "compound_heterozygous_possible": 45, "compound_heterozygous_possible_no_pedigree": 44,
    "compound_heterozygous_possible_missing_parents": 43, "compound_heterozygous_possible_missing_parent_genotypes": 42, "autosomal_recessive_possible": 40,
    "x_linked_recessive_possible": 38, "x_linked_dominant_possible": 36, "autosomal_dominant_possible": 35, "homozygous": 25, "non_mendelian": 12,
    "unknown": 10, "reference": 5, "none": 0,
}
# What a pattern is called in reports.
DESCRIPTIONS = {
    "de_novo": "New mutation not inherited from parents",
    "compound_heterozygous": "Two different mutations in the same gene, one from each parent",
    "autosomal_recessive": "Two copies of the mutation needed, one from each parent",
    "autosomal_dominant": "One copy of the mutation is sufficient to cause disease",
    "x_linked_recessive": "Mutation on X chromosome, primarily affects males",
    "x_linked_dominant": "Mutation on X chromosome affects both sexes",
    "mitochondrial": "Inherited through maternal lineage only",
    "de_novo_candidate": "Possible new mutation (parental data incomplete)",
    "compound_heterozygous_possible": "Possible compound heterozygous (phase uncertain)",
    "compound_heterozygous_possible_no_pedigree": "Possible compound heterozygous (no family data)",
    "compound_heterozygous_possible_missing_parents": "Possible compound heterozygous (missing parent data)",
    "compound_heterozygous_possible_missing_parent_genotypes": "Possible compound heterozygous (missing genotypes)",
    "autosomal_recessive_possible": "Possible recessive inheritance (incomplete data)",
    "x_linked_recessive_possible": "Possible X-linked recessive (incomplete data)",
    "x_linked_dominant_possible": "Possible X-linked dominant (incomplete data)",
    "autosomal_dominant_possible": "Possible dominant inheritance (incomplete data)",
    "homozygous": "Homozygous variant (single sample)",
    "reference": "No variant present",
    "non_mendelian": "Does not follow Mendelian inheritance patterns",
    "unknown": "Inheritance pattern could not be determined",
    "none": "No inheritance pattern detected",
}


def family(pedigree: DataFrame, samples: DataFrame) -> DataFrame:
    """The pedigree of exactly the samples (sample_id, place): those without a row are affected founders.

    father_in and mother_in say whether a named parent is among the samples; father_hit and mother_hit whether an
    affected one is.
    """
    p = pedigree.select("sample_id", "father_id", "mother_id", "sex", "affected")
    rows = samples.select("sample_id", "place").join(p, "sample_id", "left")
    rows = rows.withColumns({"affected": F.coalesce("affected", F.lit(True)), "sex": F.coalesce("sex", F.lit("0")), "father_id": F.nullif("father_id", F.lit("0")), "mother_id": F.nullif("mother_id", F.lit("0"))})
    for parent in ("father", "mother"):
        of = rows.select(F.col("sample_id").alias(f"{parent}_id"), F.col("affected").alias(f"{parent}_hit"))
        rows = rows.join(of, f"{parent}_id", "left").withColumn(f"{parent}_in", F.col(f"{parent}_hit").isNotNull()).withColumn(f"{parent}_hit", F.coalesce(f"{parent}_hit", F.lit(False)))
    return rows


def trios(calls: DataFrame, fam: DataFrame) -> DataFrame:
    """variant_id, child_id and dosages c, f, m (-1 missing, 0 for hom-ref; f and m null without that parent)."""
    roles = fam.select(F.col("sample_id").alias("child_id"), F.inline(F.array(
        F.struct(F.col("sample_id").alias("sample_id"), F.lit("c").alias("role")),
        F.struct(F.when(F.col("father_in"), F.col("father_id")).alias("sample_id"), F.lit("f").alias("role")),
        F.struct(F.when(F.col("mother_in"), F.col("mother_id")).alias("sample_id"), F.lit("m").alias("role")),
    ))).where("sample_id IS NOT NULL")
    rows = calls.select("variant_id", "sample_id", F.coalesce("dosage", F.lit(-1)).alias("d")).join(roles, "sample_id")
    known = rows.groupBy("variant_id", "child_id").agg(*(F.max(F.when(F.col("role") == r, F.col("d"))).alias(r) for r in "cfm"))
    known = known.join(fam.withColumnRenamed("sample_id", "child_id"), "child_id")
    zero = {"c": F.coalesce("c", F.lit(0)), "f": F.when(F.col("father_in"), F.coalesce("f", F.lit(0))), "m": F.when(F.col("mother_in"), F.coalesce("m", F.lit(0)))}
    return known.withColumns(zero)


def _listed(*parts: tuple[Column, str]) -> Column:
    return F.filter(F.array(*(F.when(c, F.lit(name)) for c, name in parts)), lambda x: x.isNotNull())


def patterns(calls: DataFrame, variants: DataFrame, fam: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """variant_id, patterns: per carrier in sample order de novo, dominant, recessive, X, mitochondrial or the fallback,
    repeated ones once.  known: trios(), if they are there already."""
    rows = (trios(calls, fam) if known is None else known).where("c > 0").join(variants.select("variant_id", "chrom"), "variant_id")
    no = F.lit(False)
    f, m, aff, hom = F.col("f"), F.col("m"), F.col("affected"), F.col("c") == 2
    f_has, m_has = F.coalesce(f > 0, no), F.coalesce(m > 0, no)
    f_miss, m_miss = F.coalesce(f == -1, no), F.coalesce(m == -1, no)
    both = F.col("father_in") & F.col("mother_in")
    dominant = aff & ((f_has & F.col("father_hit")) | (m_has & F.col("mother_hit")))
    dominant_maybe = aff & ~dominant & (f_has | m_has | f_miss | m_miss)
    recessive = aff & hom & f_has & m_has
    recessive_maybe = aff & hom & ~recessive & (f_miss | m_miss) & (f_has | f_miss) & (m_has | m_miss)
    x, male, female = F.col("chrom").isin(*CHROM_X), F.col("sex") == "1", F.col("sex") == "2"
    xlr_male = x & male & aff & F.col("mother_in") & m_has & ~f_has
    xlr_male_maybe = x & male & aff & F.when(F.col("mother_in"), m_miss & ~f_has).otherwise(True)
    xlr_female = x & female & aff & hom & f_has & m_has
    unknown = (~F.col("father_in") | f_miss) | (~F.col("mother_in") | m_miss)
    xlr_female_maybe = x & female & aff & hom & ~xlr_female & unknown
    xld_f, xld_m = x & aff & female & f_has & F.col("father_hit"), x & aff & m_has & F.col("mother_hit")
    # a possible dominant X pattern is only told while no sample before, in order, showed a clear one
    so_far = Window.partitionBy("variant_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    clear = F.max(F.when(xld_f | xld_m, 1).otherwise(0)).over(so_far) == 1
    mt = F.col("chrom").isin(*CHROM_MT) & F.when(F.col("mother_in"), m_has).otherwise(True)
    found = _listed(
        (both & (f == 0) & (m == 0), "de_novo"), (both & aff & (f_miss | m_miss), "de_novo_candidate"),
        (dominant, "autosomal_dominant"), (dominant_maybe, "autosomal_dominant_possible"),
        (recessive, "autosomal_recessive"), (recessive_maybe, "autosomal_recessive_possible"),
        (xlr_male | xlr_female, "x_linked_recessive"), (xlr_male_maybe | xlr_female_maybe, "x_linked_recessive_possible"),
        (xld_f, "x_linked_dominant"), (xld_m, "x_linked_dominant"), (x & aff & ~clear, "x_linked_dominant_possible"),
        (mt, "mitochondrial"),
    )
    rows = rows.withColumn("found", found)
    told = F.when(F.size("found") > 0, F.col("found")).otherwise(F.array(F.when(aff, "unknown").otherwise("carrier")))
    rows = rows.groupBy("variant_id").agg(F.array_sort(F.collect_list(F.struct("place", told.alias("p")))).alias("all"))
    return rows.select("variant_id", F.array_distinct(F.flatten(F.col("all.p"))).alias("patterns"))


def single_sample_pattern(dosage: Column) -> Column:
    """Without parents only the dosage tells; a missing one is unknown."""
    return F.when(dosage == 0, "reference").when(dosage == 2, "homozygous").otherwise("unknown")


def compound_hets(calls: DataFrame, fam: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """gene, sample_id, variant_id, type, partners (sorted): heterozygous variants of a gene that may sit on the two
    copies, by what the parents carry.  known: trios(), if they are there already.

    A sample's variants of a gene are one list, in which each looks for its partners.
    """
    het = calls.where("dosage = 1").select("gene", "variant_id", "sample_id").distinct()
    t = (trios(calls, fam) if known is None else known).select(F.col("child_id").alias("sample_id"), "variant_id", "f", "m", "father_in", "mother_in", "affected")
    rows = het.join(t, ["sample_id", "variant_id"])
    no = F.lit(False)
    f, m = F.coalesce(F.col("f") > 0, no), F.coalesce(F.col("m") > 0, no)
    origin = F.when(F.col("father_in") & F.col("mother_in"), F.when(f & ~m, "father").when(~f & m, "mother").otherwise("unclear"))
    origin = origin.when(F.col("father_in"), F.when(f, "known").otherwise("other")).when(F.col("mother_in"), F.when(m, "known").otherwise("other"))
    kind = F.when(F.col("father_in") & F.col("mother_in"), "compound_heterozygous")
    kind = kind.when(F.col("father_in") | F.col("mother_in"), "compound_heterozygous_possible_missing_parents").otherwise("compound_heterozygous_possible_no_pedigree")
    rows = rows.select("gene", "sample_id", kind.alias("type"), "affected", F.struct("variant_id", origin.alias("origin")).alias("v"))
    groups = rows.groupBy("gene", "sample_id", "type", "affected").agg(F.array_sort(F.collect_list("v")).alias("vs")).where(F.size("vs") > 1)
    rows = groups.select("gene", "sample_id", "type", "affected", "vs", F.explode("vs").alias("v"))

    def fits(o: Column) -> Column:
        apart = F.col("v.origin") != o["origin"]
        return (o["variant_id"] != F.col("v.variant_id")) & (
            F.when(F.col("type") == "compound_heterozygous", (o["origin"] != "unclear") & apart).when(F.col("v.origin").isNotNull(), apart).otherwise(F.col("affected"))
        )

    partners = F.transform(F.filter("vs", fits), lambda o: o["variant_id"])
    return rows.select("gene", "sample_id", F.col("v.variant_id").alias("variant_id"), "type", partners.alias("partners")).where(F.size("partners") > 0)


def pair_type(father_1: Column, mother_1: Column, father_2: Column, mother_2: Column) -> Column:
    """struct<phase, type> of two heterozygous variants from the parents' dosages (-1 missing): trans if each parent gave
    one, cis if one parent gave both, ambiguous if a variant may come from either, else unknown."""
    dosages = (father_1, mother_1, father_2, mother_2)
    missing = sum((c == -1).cast("int") for c in dosages) > 0
    f1, m1, f2, m2 = (F.coalesce(c > 0, F.lit(False)) for c in dosages)
    only_father_1, only_mother_1, only_father_2, only_mother_2 = f1 & ~m1, m1 & ~f1, f2 & ~m2, m2 & ~f2
    phase = (
        F.when(missing, "unknown").when((only_father_1 & only_mother_2) | (only_mother_1 & only_father_2), "trans")
        .when((only_father_1 & only_father_2) | (only_mother_1 & only_mother_2), "cis").when((f1 & m1) | (f2 & m2), "ambiguous").otherwise("unknown")
    )
    kind = F.when(missing, "compound_heterozygous_possible_missing_parent_genotypes").when(phase == "trans", "compound_heterozygous").when(phase == "cis", "not_compound_heterozygous")
    return F.struct(phase.alias("phase"), kind.otherwise("compound_heterozygous_possible").alias("type"))


def parents_of(pedigree: DataFrame) -> DataFrame:
    """sample_id, father_id, mother_id; null where none is named."""
    return pedigree.select("sample_id", F.nullif("father_id", F.lit("0")).alias("father_id"), F.nullif("mother_id", F.lit("0")).alias("mother_id"))


def affected_of(pedigree: DataFrame) -> DataFrame:
    """Rows of affected samples."""
    return pedigree.where(F.col("affected") if "affected" in pedigree.columns else F.col("affected_status") == "2")


def members_of(pedigree: DataFrame) -> DataFrame:
    """family_id, members in order of their ids."""
    return pedigree.groupBy("family_id").agg(F.array_sort(F.collect_set("sample_id")).alias("members"))


def pattern_counts(rows: DataFrame, column: str = "pattern") -> DataFrame:
    """The patterns by how often they are told, most first."""
    return rows.groupBy(F.col(column).alias("pattern")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pattern")


SEGREGATING = ("de_novo", "autosomal_dominant", "autosomal_recessive", "compound_heterozygous", "x_linked_recessive", "x_linked_dominant", "mitochondrial")


def _counts() -> dict[str, Column]:
    """What a trio adds to each count, from c, f, m, sex, affected, father_in, mother_in."""
    c, f, m, aff = F.col("c"), F.col("f"), F.col("m"), F.col("affected")
    known, v = c >= 0, c > 0
    f_known, m_known = F.coalesce(f >= 0, F.lit(False)), F.coalesce(m >= 0, F.lit(False))
    f_has, m_has = F.coalesce(f > 0, F.lit(False)), F.coalesce(m > 0, F.lit(False))
    trio = known & f_known & m_known
    male, female = F.col("sex") == "1", F.col("sex") == "2"
    return {
        "dn_checks": trio, "dn_bad": trio & v & (f_has | m_has),
        "aff_with": known & aff & v, "aff_without": known & aff & ~v, "un_with": known & ~aff & v, "un_without": known & ~aff & ~v,
        "aff_hom": known & aff & (c == 2), "aff_het": known & aff & (c == 1), "ar_trio": trio & aff, "ar_trio_bad": trio & aff & ~(f_has & m_has),
        "x_checks": known, "xlr_bad": known & ((male & (aff != v)) | (female & aff & (c != 2))), "xld_bad": known & aff & ~v,
        "mt_m": known & m_known, "mt_m_bad": known & m_known & m_has & ~v, "mt_f": known & f_known, "mt_f_bad": known & f_known & f_has & v & ~m_has,
    }


def segregation(calls: DataFrame, variants: DataFrame, fam: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """variant_id and, for each pattern that can be checked, seg_<pattern> (boolean) and conf_<pattern>.  known: trios(), if
    they are there already."""
    counts = _counts()
    blank = fam.withColumns({"c": F.lit(0), "f": F.when(F.col("father_in"), 0), "m": F.when(F.col("mother_in"), 0)})
    zero = blank.agg(*(F.coalesce(F.sum(v.cast("int")), F.lit(0)).alias(k) for k, v in counts.items())).first().asDict()
    t = trios(calls, fam) if known is None else known
    told = t.select("variant_id", *(v.cast("int").alias(k) for k, v in counts.items()), "father_in", "mother_in", "sex", "affected")
    blanked = told.withColumns({"c": F.lit(0), "f": F.when(F.col("father_in"), 0), "m": F.when(F.col("mother_in"), 0)})
    more = blanked.groupBy("variant_id").agg(*(F.sum(F.col(k) - v.cast("int")).alias(k) for k, v in counts.items()))
    n = variants.select("variant_id").join(more, "variant_id", "left").select("variant_id", *((F.coalesce(F.col(k), F.lit(0)) + zero[k]).alias(k) for k in counts))

    def share(bad: Column, checks: Column, none: float) -> Column:
        return F.when(checks == 0, F.lit(none)).otherwise(1.0 - bad / F.nullif(checks, F.lit(0)))

    c = {k: F.col(k) for k in counts}
    aff, un = c["aff_with"] + c["aff_without"], c["un_with"] + c["un_without"]
    clean = (c["aff_without"] == 0) & (c["un_with"] == 0)
    aff_rate, un_rate = c["aff_with"] / F.nullif(aff, F.lit(0)), F.coalesce(c["un_without"] / F.nullif(un, F.lit(0)), F.lit(1.0))
    ar_checks, ar_bad = aff + c["ar_trio"], aff - c["aff_hom"] + c["ar_trio_bad"]
    mt_checks, mt_bad = c["mt_m"] + c["mt_f"], c["mt_m_bad"] + c["mt_f_bad"]
    out = {
        "de_novo": (c["dn_bad"] == 0, share(c["dn_bad"], c["dn_checks"], 0.5)),
        "autosomal_dominant": (
            F.when(aff == 0, False).when(clean, True).otherwise((aff_rate > 0.8) & (c["un_with"] / (un + 1) < 0.2)),
            F.when(aff == 0, 0.0).when(clean, 1.0).otherwise((aff_rate + un_rate) / 2),
        ),
        "autosomal_recessive": ((ar_checks > 0) & (ar_bad == 0), share(ar_bad, ar_checks, 0.0)),
        "compound_heterozygous": ((aff > 0) & (c["aff_het"] == aff), F.coalesce(c["aff_het"] / F.nullif(aff, F.lit(0)), F.lit(0.0))),
        "x_linked_recessive": ((c["x_checks"] == 0) | (c["xlr_bad"] < c["x_checks"] * 0.2), share(c["xlr_bad"], c["x_checks"], 0.5)),
        "x_linked_dominant": ((c["x_checks"] == 0) | (c["xld_bad"] < c["x_checks"] * 0.2), share(c["xld_bad"], c["x_checks"], 0.5)),
        "mitochondrial": (mt_bad == 0, share(mt_bad, mt_checks, 0.5)),
    }
    return n.select("variant_id", *(e for p, (s, k) in out.items() for e in (s.alias(f"seg_{p}"), k.cast("double").alias(f"conf_{p}"))))


def prioritised(found: DataFrame, seg: DataFrame | None = None) -> DataFrame:
    """variant_id, pattern, confidence from variant_id, patterns; seg: as segregation() gives it.

    Patterns that segregate with a confidence above one half win over all others; of what is left the one of highest
    priority is taken, the first of equals.
    """
    rows = found
    kept = F.col("patterns")
    if seg is not None:
        rows = rows.join(seg, "variant_id", "left")
        def segregates(x: Column) -> Column:
            out = F.when(F.lit(False), F.lit(False))
            for p in SEGREGATING:
                out = out.when(x == p, F.coalesce(F.col(f"seg_{p}") & (F.col(f"conf_{p}") > 0.5), F.lit(False)))
            return out.otherwise(F.lit(False))

        winners = F.filter("patterns", segregates)
        kept = F.when(F.size(winners) > 0, winners).otherwise(F.col("patterns"))
    table = F.create_map(*[F.lit(v) for kv in PRIORITY.items() for v in kv])
    ranked = F.array_sort(F.transform(kept, lambda x, i: F.struct((-F.coalesce(F.element_at(table, x), F.lit(0))).alias("rank"), i.alias("i"), x.alias("name"))))
    rows = rows.withColumn("ranked", ranked)
    best, second = -F.get("ranked", F.lit(0))["rank"], -F.get("ranked", F.lit(1))["rank"]
    sure = F.when(F.size("ranked") == 1, F.least(best / 100.0, F.lit(1.0))).otherwise(F.round(F.least(((best - second) / 50.0) * (best / 100.0), F.lit(1.0)), 2))
    none = F.size("ranked") <= 0
    return rows.select("variant_id", F.when(none, "unknown").otherwise(F.get("ranked", F.lit(0))["name"]).alias("pattern"), F.when(none, 0.0).otherwise(sure).alias("confidence"))


def analysed(calls: DataFrame, variants: DataFrame, fam: DataFrame, detailed: bool = False) -> DataFrame:
    """variant_id, pattern, confidence, all_patterns, description, samples: the three passes together, over trios that are
    made and written once.  detailed: with details() too."""
    known = materialised(trios(calls, fam), "trios")
    found = patterns(calls, variants, fam, known)
    pairs = compound_hets(calls, fam, known)
    kinds = pairs.groupBy("variant_id").agg(F.array_sort(F.collect_set("type")).alias("types"))
    found = found.join(kinds, "variant_id", "left").select("variant_id", F.array_distinct(F.concat("patterns", F.coalesce("types", F.array().cast("array<string>")))).alias("patterns"))
    seg = segregation(calls, variants, fam, known)
    best = prioritised(found, seg)
    carriers = calls.where("dosage > 0").groupBy("variant_id").agg(F.array_sort(F.collect_set("sample_id")).alias("samples"))
    text = F.create_map(*[F.lit(v) for kv in DESCRIPTIONS.items() for v in kv])
    rows = variants.select("variant_id").join(best, "variant_id", "left").join(found, "variant_id", "left").join(carriers, "variant_id", "left")
    pattern = F.coalesce("pattern", F.lit("unknown"))
    rows = rows.select("variant_id", pattern.alias("pattern"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.col("patterns").alias("all_patterns"), F.coalesce(F.element_at(text, pattern), F.lit("Unknown inheritance pattern")).alias("description"), "samples")
    return rows.join(details(rows, calls, fam, pairs, seg), "variant_id", "left") if detailed else rows


def single_samples(calls: DataFrame) -> DataFrame:
    """variant_id, sample_id, pattern of calls without a pedigree, by dosage alone."""
    return calls.select("variant_id", "sample_id", single_sample_pattern(F.col("dosage")).alias("pattern"))


def details(rows: DataFrame, calls: DataFrame, fam: DataFrame, pairs: DataFrame, seg: DataFrame) -> DataFrame:
    """variant_id, details: JSON with the pattern, all patterns, confidence, description, how well the pattern segregates,
    and for each carrier its genotype, whether it is affected and its compound-heterozygous partners.

    rows: as analysed() gives them; calls may have gt, else it follows from the dosage; pairs and seg: as compound_hets()
    and segregation() give them.
    """
    gt = F.col("gt") if "gt" in calls.columns else F.when(F.col("dosage") == 2, "1/1").otherwise("0/1")
    carried = calls.where("dosage > 0 OR dosage IS NULL").select("variant_id", "sample_id", gt.alias("genotype")).where("genotype <> './.'")
    carried = carried.join(fam.select("sample_id", "affected", "place"), "sample_id")
    carried = carried.join(pairs.select("variant_id", "sample_id", F.col("gene").alias("pair_gene"), F.col("type").alias("pair_type"), F.transform("partners", lambda p: p.cast("string")).alias("partners")), ["variant_id", "sample_id"], "left")
    one = F.struct(
        "sample_id", "genotype", "affected", F.col("partners").alias("compound_het_partners"), F.col("pair_gene").alias("compound_het_gene"), F.col("pair_type").alias("compound_het_configuration")
    )
    het = F.col("genotype").isin("0/1", "1/0", "0|1", "1|0")
    told = carried.groupBy("variant_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", one.alias("s")))), lambda x: x["s"]).alias("samples_with_pattern"),
        F.count_if("affected").alias("affected_count"), F.count_if(het & ~F.col("affected")).alias("carrier_count"),
    )
    value = F.lit(None).cast("double")
    for p in SEGREGATING:
        value = F.when(F.col("pattern") == p, F.col(f"conf_{p}")).otherwise(value)
    wide = rows.drop("samples").join(told, "variant_id", "left").join(seg, "variant_id", "left")
    whole = F.struct(
        F.col("pattern").alias("primary_pattern"), "all_patterns", "confidence", F.col("description").alias("pattern_description"), value.alias("segregation_p_value"),
        F.coalesce("samples_with_pattern", F.expr("cast(array() AS array<struct<sample_id:string,genotype:string,affected:boolean,compound_het_partners:array<string>,compound_het_gene:string,compound_het_configuration:string>>)")).alias("samples_with_pattern"),
        F.coalesce("affected_count", F.lit(0)).alias("affected_count"), F.coalesce("carrier_count", F.lit(0)).alias("carrier_count"),
    )
    return wide.select("variant_id", F.to_json(whole).alias("details"))


def as_columns(rows: DataFrame, mode: str = "full") -> DataFrame:
    """Inheritance_Pattern with Inheritance_Details as JSON (full), alone (simple), or as three text columns (columns)."""
    base = rows.select(*rows.columns).withColumn("Inheritance_Pattern", F.col("pattern"))
    if mode == "simple":
        return base.select("variant_id", "Inheritance_Pattern")
    if mode == "columns":
        return base.select("variant_id", "Inheritance_Pattern", F.format_string("%.2f", "confidence").alias("Inheritance_Confidence"), F.col("description").alias("Inheritance_Description"), F.array_join("samples", ",").alias("Inheritance_Samples"))
    told = F.to_json(F.struct(F.col("pattern").alias("primary_pattern"), "all_patterns", "confidence", F.col("description").alias("pattern_description"), F.col("samples").alias("samples_with_pattern")))
    return base.select("variant_id", "Inheritance_Pattern", (F.col("details") if "details" in rows.columns else told).alias("Inheritance_Details"))
