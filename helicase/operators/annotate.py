"""Annotation joins: regions, gene lists, gene attributes, protein-level evidence, genotype packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helicase.functions import text
from helicase.operators import intervals

# Genotypes that a packed cell leaves out.
NOT_PACKED = ("0/0", "0|0", "./.", ".|.", ".", "NA", "", "nan", "None")


def region_labels(variants: DataFrame, regions: DataFrame, key: str = "variant_id") -> DataFrame:
    """key, labels: Region=name of every region that holds the variant."""
    hits = intervals.at_positions(variants.select(key, "chrom", "pos"), regions)
    return hits.groupBy(key).agg(F.array_sort(F.collect_set(F.concat(F.lit("Region="), "name"))).alias("labels"))


def _genes(variants: DataFrame, key: str) -> DataFrame:
    return variants.select(key, F.explode(text.genes_of(F.col("gene"))).alias("gene"))


def gene_list_labels(variants: DataFrame, lists: DataFrame, key: str = "variant_id") -> DataFrame:
    """key, labels: InGeneList=name for every list (list_name, gene) with one of the cell's genes."""
    hits = _genes(variants, key).join(lists.select("list_name", F.upper("gene").alias("gene")).distinct(), "gene")
    return hits.groupBy(key).agg(F.array_sort(F.collect_set(F.concat(F.lit("InGeneList="), "list_name"))).alias("labels"))


def attribute_labels(variants: DataFrame, attributes: DataFrame, key: str = "variant_id") -> DataFrame:
    """key, labels: field=value of the attributes (gene, attributes map) of the cell's genes."""
    hits = _genes(variants, key).join(attributes, "gene").select(key, F.explode("attributes").alias("k", "v"))
    return hits.groupBy(key).agg(F.array_sort(F.collect_set(F.concat("k", F.lit("="), "v"))).alias("labels"))


def attribute_columns(variants: DataFrame, attributes: DataFrame, fields: list[str], key: str = "variant_id") -> DataFrame:
    """variants with a column per field; of several genes in a cell the first by name that has attributes counts."""
    hits = _genes(variants, key).join(attributes, "gene")
    first = hits.groupBy(key).agg(F.min_by("attributes", "gene").alias("_a"))
    return variants.join(first, key, "left").withColumns({f: F.element_at("_a", F.lit(f)) for f in fields}).drop("_a")


def merged_attributes(tables: list[DataFrame]) -> DataFrame:
    """gene, attributes of several tables as one: a gene's fields from all of them, of one that is told twice the greatest."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    told = rows.select("gene", F.explode("attributes").alias("k", "v")).groupBy("gene", "k").agg(F.max("v").alias("v"))
    return told.groupBy("gene").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("attributes"))


def custom_annotation(variants: DataFrame, parts: list[DataFrame], key: str = "variant_id") -> DataFrame:
    """variants with Custom_Annotation: all labels, distinct and sorted, joined by semicolons."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.select(key, F.explode("labels").alias("l")).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("l")), ";").alias("Custom_Annotation"))
    return variants.join(rows, key, "left").withColumn("Custom_Annotation", F.coalesce("Custom_Annotation", F.lit("")))


def annotation_summary(annotated: DataFrame) -> DataFrame:
    """kind, n: labels of Custom_Annotation by what stands before the equals sign."""
    rows = annotated.select(F.explode(F.split("Custom_Annotation", ";")).alias("l")).where("l <> ''")
    return rows.groupBy(F.substring_index("l", "=", 1).alias("kind")).agg(F.count("*").alias("n"))


def gene_list_flags(variants: DataFrame, lists: DataFrame, names: list[str], key: str = "variant_id") -> DataFrame:
    """variants with yes or no per list."""
    hits = _genes(variants, key).join(lists.select("list_name", F.upper("gene").alias("gene")), "gene").groupBy(key).agg(F.collect_set("list_name").alias("_in"))
    rows = variants.join(hits, key, "left")
    return rows.withColumns({text.list_name(n): F.when(F.array_contains("_in", n), "yes").otherwise("no") for n in names}).drop("_in")


def pm5_lookup(summary: DataFrame, assembly: str = "GRCh38", least_stars: int = 1, likely: bool = True) -> DataFrame:
    """gene, aa_pos, ref_aa, alt_aa, clnsig, review: pathogenic germline substitutions of a ClinVar summary table."""
    sig, change = F.col("ClinicalSignificance"), text.protein_change(F.col("Name"))
    rows = summary.where(
        (F.col("Type") == "single nucleotide variant") & (F.col("Assembly") == assembly) & F.lower(sig).contains("pathogenic") & ~F.lower(sig).contains("conflicting")
        & F.lower("Origin").contains("germline") & (text.review_stars(F.col("ReviewStatus")) >= least_stars)
    )
    rows = rows.select(F.col("GeneSymbol").alias("gene"), change.alias("c"), text.simple_significance(sig).alias("clnsig"), F.col("ReviewStatus").alias("review"))
    rows = rows.select("gene", "c.aa_pos", "c.ref_aa", "c.alt_aa", "clnsig", "review").where("aa_pos IS NOT NULL AND ref_aa <> alt_aa")
    return (rows if likely else rows.where("clnsig = 'P'")).distinct()


def pm5(variants: DataFrame, lookup: DataFrame, key: str = "variant_id") -> DataFrame:
    """variants (gene, aa_pos, ref_aa, alt_aa) with PM5, PM5_evidence_count, PM5_known_variants: other substitutions at
    the same residue that are known as pathogenic."""
    known = lookup.withColumnRenamed("alt_aa", "known_alt")
    hits = variants.select(key, "gene", "aa_pos", "ref_aa", "alt_aa").join(known, ["gene", "aa_pos", "ref_aa"]).where("alt_aa <> known_alt")
    p = F.count_if(F.col("clnsig") == "P")
    name = F.concat(F.lit("p."), "ref_aa", F.col("aa_pos").cast("string"), "known_alt", F.lit("("), "clnsig", F.lit(")"))
    found = hits.groupBy(key).agg(
        F.when(p >= 2, "PM5_Strong").when(p == 1, "PM5").otherwise("PM5_Supporting").alias("PM5"),
        F.count("*").alias("PM5_evidence_count"), F.array_join(F.array_sort(F.collect_list(name)), ";").alias("PM5_known_variants"),
    )
    return variants.join(found, key, "left").fillna({"PM5": "", "PM5_evidence_count": 0, "PM5_known_variants": ""})


def packed(calls: DataFrame, key: str = "variant_id", delimiter: str = ":") -> DataFrame:
    """key, GT: sample(genotype) of all calls that say something, by sample, joined by semicolons; after the genotype what
    the calls have as extra, each after the delimiter."""
    rows = calls.where(~F.col("gt").isin(*NOT_PACKED))
    told = F.array_join(F.concat(F.array("gt"), "extra"), delimiter) if "extra" in calls.columns else F.col("gt")
    cell = F.struct("sample_id", F.concat("sample_id", F.lit("("), told, F.lit(")")).alias("t"))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(cell)), lambda x: x["t"]), ";").alias("GT"))


def unpacked(variants: DataFrame, key: str = "variant_id", samples: list[str] | None = None) -> DataFrame:
    """key, sample_id, gt of packed cells; comma-separated genotypes without names take the samples' order."""
    pattern = r"^([^(]+)\(([^:)]+)"
    named = F.col("GT").contains("(")
    rows = variants.where(named).select(key, F.explode(F.split("GT", ";")).alias("cell")).where(F.col("cell").rlike(pattern))
    rows = rows.select(key, F.trim(F.regexp_extract("cell", pattern, 1)).alias("sample_id"), F.regexp_extract("cell", pattern, 2).alias("gt"))
    if samples:
        listed = variants.where(~named).select(key, F.posexplode(F.split("GT", ",")).alias("i", "gt"))
        rows = rows.union(listed.select(key, F.get(F.lit(samples), F.col("i")).alias("sample_id"), F.trim("gt").alias("gt")).where("sample_id IS NOT NULL"))
    return rows


def wide(calls: DataFrame, samples: list[str], key: str = "variant_id") -> DataFrame:
    """A column per sample, ./. where there is no call: for sinks only."""
    return calls.groupBy(key).pivot("sample_id", samples).agg(F.first("gt")).fillna("./.")


def genotype_filter(calls: DataFrame, modes: Column, key: str = "variant_id") -> DataFrame:
    """Calls (gene, sample_id, dosage) that meet one of the modes het, hom, comp_het (two het variants of the gene), with
    the modes that they meet.  modes: an array Column, the same for all or by gene."""
    from pyspark.sql import Window

    hets = F.count_if(F.col("dosage") == 1).over(Window.partitionBy("gene", "sample_id"))
    rows = calls.withColumns({"_modes": modes, "_hets": hets})
    met = F.filter(F.array(F.when(F.col("dosage") == 1, F.lit("het")), F.when(F.col("dosage") == 2, F.lit("hom")), F.when((F.col("dosage") == 1) & (F.col("_hets") >= 2), F.lit("comphet"))), lambda x: x.isNotNull())
    wanted = F.transform(F.col("_modes"), lambda m: F.replace(m, F.lit("_"), F.lit("")))
    rows = rows.withColumn("reasons", F.array_intersect(met, wanted)).where(F.size("reasons") > 0)
    return rows.drop("_modes", "_hets")


def modes_by_gene(calls: DataFrame, rules: DataFrame, default: list[str]) -> DataFrame:
    """genotype_filter() by rules (gene, modes): a gene's own modes count in place of the default ones, and a gene without
    either keeps all its calls."""
    own = rules.groupBy(F.upper("gene").alias("_rule")).agg(F.array_distinct(F.flatten(F.collect_list("modes"))).alias("_own"))
    rows = calls.join(own, F.upper("gene") == F.col("_rule"), "left").drop("_rule")
    every = F.lit([*default]) if default else F.array().cast("array<string>")
    rows = rows.withColumn("_asked", F.coalesce("_own", every)).drop("_own")
    free = rows.where(F.size("_asked") == 0).drop("_asked").withColumn("reasons", F.array().cast("array<string>"))
    return genotype_filter(rows.where(F.size("_asked") > 0), F.col("_asked")).drop("_asked").unionByName(free)


def phenotype_text(calls: DataFrame, phenotypes: DataFrame, key: str = "variant_id") -> DataFrame:
    """key, phenotypes: carriers with their sorted terms, sample(term,term), joined by semicolons."""
    rows = calls.where("dosage > 0").join(phenotypes, "sample_id", "left")
    cell = F.concat("sample_id", F.lit("("), F.array_join(F.array_sort(F.coalesce("terms", F.array().cast("array<string>"))), ","), F.lit(")"))
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(cell)), ";").alias("phenotypes"))


def of_transcripts(variants: DataFrame, ids: list[str], column: str = "FEATUREID") -> DataFrame:
    """Rows annotated for one of the transcripts, whatever their version."""
    return variants.where(F.substring_index(column, ".", 1).isin(*[i.split(".")[0] for i in ids]))


def two_commonest(calls: DataFrame, key: str = "variant_id") -> DataFrame:
    """key, gt: of several genotypes for a variant the two that occur most, by number and name, joined by commas."""
    from pyspark.sql import Window

    n = calls.groupBy(key, "gt").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "gt"))
    kept = n.withColumn("i", rank).where("i <= 2")
    return kept.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "gt"))), lambda x: x["gt"]), ",").alias("gt"))


def with_aliases(df: DataFrame) -> DataFrame:
    """df with the short names of extracted columns added where they are absent."""
    return df.withColumns({short: F.col(f"`{long}`") for long, short in text.ALIASES.items() if long in df.columns and short not in df.columns})


def without_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """df without those of the columns that it has."""
    return df.drop(*[n for n in names if n in df.columns])


def without_samples(df: DataFrame, samples: list[str], keep: list[str] | None = None) -> DataFrame:
    """df without the samples' columns (GEN_i__X, or named as a sample), but for those to keep."""
    import re

    kept = {*(keep or [])}
    return df.drop(*[c for c in df.columns if c not in kept and (c in samples or re.fullmatch(r"GEN_\d+__\w+", c))])


def as_numbers(df: DataFrame) -> DataFrame:
    """df with the columns that hold numbers by their names as doubles; what is no number is null."""
    return df.withColumns({c: F.col(f"`{c}`").cast("string").try_cast("double") for c in text.numeric_names(df.columns)})


def packed_phenotype_text(variants: DataFrame, phenotypes: DataFrame, key: str = "variant_id") -> DataFrame:
    """phenotype_text() from packed cells (column GT)."""
    rows = unpacked(variants, key).where(~F.col("gt").isin(*NOT_PACKED)).withColumn("dosage", F.lit(1))
    return phenotype_text(rows, phenotypes, key)


def phenotypes_of(samples: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """One row, phenotypes: the terms of each sample (in the order of place) joined by commas, samples by semicolons."""
    rows = samples.join(phenotypes, "sample_id", "left").select("place", F.array_join(F.array_sort(F.coalesce("terms", F.array().cast("array<string>"))), ",").alias("t"))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "t"))), lambda x: x["t"]), ";").alias("phenotypes"))


def phenotypes_like_genotypes(samples: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """One row, phenotypes: sample(term,term) of every sample in the order of place, joined by semicolons."""
    rows = samples.join(phenotypes, "sample_id", "left")
    cell = F.concat("sample_id", F.lit("("), F.array_join(F.array_sort(F.coalesce("terms", F.array().cast("array<string>"))), ","), F.lit(")"))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", cell.alias("t")))), lambda x: x["t"]), ";").alias("phenotypes"))


def aligned_phenotypes(rows: DataFrame, samples: list[str], column: str = "phenotypes", sep: str = ",") -> DataFrame:
    """sample_id, terms (distinct, sorted) from cells whose groups, split at semicolons, follow the samples' order; a cell
    with another number of groups is passed over."""
    groups = F.split(F.col(column), ";")
    cells = rows.where(F.size(groups) == len(samples)).select(F.posexplode(groups).alias("i", "cell"))
    bare = F.regexp_replace("cell", r"^[^(]*\(|\)$", "")
    terms = F.filter(F.transform(F.split(bare, sep), lambda t: F.trim(t)), lambda t: t != "")
    found = cells.select(F.get(F.lit(samples), F.col("i")).alias("sample_id"), terms.alias("terms"))
    return found.groupBy("sample_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))


def cardinality(df: DataFrame, columns: list[str], most: float = 0.5) -> DataFrame:
    """name, n_distinct, share (of rows) and repeated: whether so few values occur that a dictionary pays."""
    one = df.agg(F.count("*").alias("_n"), *(F.count_distinct(F.col(f"`{c}`")).alias(c) for c in columns))
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    rows = one.selectExpr("_n", f"stack({len(columns)}, {pairs}) AS (name, n_distinct)")
    return rows.select("name", "n_distinct", (F.col("n_distinct") / F.nullif("_n", F.lit(0))).alias("share")).withColumn("repeated", F.coalesce(F.col("share") < most, F.lit(False)))


def with_reports(variants: DataFrame, reports: DataFrame) -> DataFrame:
    """variants with links, the paths of their browser reports: reports has chrom, pos, ref, alt, sample_id and path."""
    keys = ["chrom", "pos", "ref", "alt"]
    told = reports.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sample_id", "path"))), lambda x: F.concat(x["sample_id"], F.lit(":"), x["path"])), ";").alias("links"))
    return variants.join(told, keys, "left").withColumn("links", F.coalesce("links", F.lit("")))


def report_jobs(variants: DataFrame, calls: DataFrame, reads: DataFrame, flanking: int = 50, key: str = "variant_id") -> DataFrame:
    """One row per variant and carrier with reads (sample_id, path): the region that a browser report shows and a file name
    that is safe everywhere.  What draws a report runs outside."""
    carried = calls.where("dosage > 0").select(key, "sample_id").join(reads.withColumnRenamed("path", "reads"), "sample_id")
    rows = carried.join(variants.select(key, "chrom", "pos", "ref", "alt"), key)
    start = F.greatest(F.col("pos") - flanking, F.lit(1))
    name = F.concat_ws("_", "sample_id", "chrom", F.col("pos").cast("string"), _short("ref"), _short("alt"))
    region = F.concat("chrom", F.lit(":"), start.cast("string"), F.lit("-"), (F.col("pos") + F.length("ref") - 1 + flanking).cast("string"))
    return rows.select(key, "sample_id", "chrom", "pos", "ref", "alt", "reads", region.alias("region"), F.concat(F.regexp_replace(name, "[^A-Za-z0-9._-]", "_"), F.lit("_report.html")).alias("path"))


def _short(allele: str, most: int = 10) -> Column:
    """An allele, or its beginning and a hash of it if it is long."""
    c = F.col(allele)
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.substring(c, 1, 3), F.lit("_"), F.substring(F.md5(c), 1, 6)))


def first_rows(variants: DataFrame, key: str = "variant_id", order: tuple[str, ...] = ("gene",)) -> DataFrame:
    """One row a key: of several the first by the order's columns, then by all others as text."""
    from pyspark.sql import Window

    others = [F.col(f"`{c}`").cast("string") for c in variants.columns if c != key and c not in order]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order, *others))
    return variants.withColumn("_place", place).where("_place = 1").drop("_place")
