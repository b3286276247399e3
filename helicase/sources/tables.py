"""Readers of the side tables: regions, pedigrees, phenotypes, gene lists, gene attributes, covariates, weights."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.functions import text


def _file_stem() -> Column:
    return F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.[^.]*(\.gz)?$", "")


def read_bed(spark: SparkSession, path: str, labelled: bool = False) -> DataFrame:
    """chrom (without chr), start, end, name; comments, track lines and rows that aren't an interval go.

    labelled: names end in the file's name, as region annotations have it.
    """
    f = F.split("value", "\t")
    chrom, start, end = F.regexp_replace(F.get(f, F.lit(0)), "^chr", ""), F.get(f, F.lit(1)).try_cast("bigint"), F.get(f, F.lit(2)).try_cast("bigint")
    default = F.concat(F.lit("region_"), start.cast("string"), F.lit("_"), end.cast("string"))
    name = F.coalesce(F.nullif(F.trim(F.get(f, F.lit(3))), F.lit("")), default)
    if labelled:
        name = F.concat(name, F.lit("_"), _file_stem())
    rows = spark.read.text(path).where(~F.col("value").rlike("^(#|track|browser)"))
    return rows.select(chrom.alias("chrom"), start.alias("start"), end.alias("end"), name.alias("name")).where("start < end")


def read_ped(spark: SparkSession, path: str) -> DataFrame:
    """Pedigree rows; . is 0; a row without exactly six columns raises."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    checked = F.when(F.size(f) == 6, f).otherwise(F.raise_error(F.concat(F.lit("pedigree row without six columns: "), F.col("value"))))
    names = ("family_id", "sample_id", "father_id", "mother_id", "sex", "affected_status")
    rows = rows.select(checked.alias("f"))
    return rows.select(*(F.when(F.get("f", F.lit(i)) == ".", "0").otherwise(F.get("f", F.lit(i))).alias(n) for i, n in enumerate(names)))


def read_delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """A table with a header, all text, empty cells null; the separator follows the suffix if not given."""
    sep = sep or ("," if path.removesuffix(".gz").endswith(".csv") else "\t")
    return spark.read.csv(path, sep=sep, header=True, nullValue="", quote='"' if sep == "," else "")


def read_variants_tsv(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str]]:
    """A variant table with columns as identifiers and the map from the old names."""
    df = read_delimited(spark, path)
    names = text.identifiers(df.columns)
    return df.toDF(*names.values()), names


def read_phenotypes(spark: SparkSession, path: str, sample: str, value: str) -> DataFrame:
    """sample_id, terms (distinct, sorted) of a .csv or .tsv with many rows a sample."""
    if not path.removesuffix(".gz").endswith((".csv", ".tsv")):
        raise ValueError("a phenotype file ends in .csv or .tsv")
    rows = read_delimited(spark, path).select(F.col(f"`{sample}`").alias("sample_id"), F.col(f"`{value}`").alias("term"))
    return rows.groupBy("sample_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Column value of non-empty lines that are no comments: genes, terms or samples, one a line."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> '' AND NOT startswith(value, '#')")


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    """list_name, gene (upper case); a line may hold several, separated by commas."""
    rows = spark.read.text(path).select("value", _file_stem().alias("list_name")).where("NOT startswith(trim(value), '#')")
    rows = rows.select("list_name", F.explode(F.split(F.upper("value"), ",")).alias("gene"))
    return rows.select("list_name", F.trim("gene").alias("gene")).where("gene <> ''").distinct()


def normalised_genes(genes: str) -> list[str]:
    """Sorted distinct genes of a file or of a list separated by commas or blanks; all stays alone."""
    if os.path.exists(genes):
        with open(genes, encoding="utf-8") as f:
            genes = f.read()
    found = sorted(set(genes.replace(",", " ").split()))
    return ["all"] if "all" in found else found


def read_gene_json(spark: SparkSession, path: str, identifier: str, data_fields: list[str]) -> DataFrame:
    """gene (upper case), attributes map<string,string> from a list of objects or an object of objects."""
    raw = spark.read.text(path, wholetext=True)
    entry = "map<string,string>"
    listed = F.from_json("value", F.lit(f"array<{entry}>"))
    keyed = F.map_values(F.from_json("value", F.lit(f"map<string,{entry}>")))
    rows = raw.select(F.explode(F.when(F.trim("value").startswith("["), listed).otherwise(keyed)).alias("o"))
    rows = rows.where(F.element_at("o", F.lit(identifier)).isNotNull())
    return rows.select(F.upper(F.element_at("o", F.lit(identifier))).alias("gene"), F.map_filter("o", lambda k, v: k.isin(*data_fields) & v.isNotNull()).alias("attributes"))


def read_genotype_rules(spark: SparkSession, path: str) -> DataFrame:
    """gene, modes (het, hom, comp_het; commas between) of the first two columns of a table; other modes raise."""
    df = read_delimited(spark, path)
    modes = F.transform(F.split(F.lower(F.col(f"`{df.columns[1]}`")), ","), F.trim)
    fits = F.forall(modes, lambda m: m.isin("het", "hom", "comp_het"))
    checked = F.when(fits, modes).otherwise(F.raise_error(F.concat(F.lit("not a genotype mode: "), F.col(f"`{df.columns[1]}`"))))
    return df.where(f"`{df.columns[0]}` IS NOT NULL AND `{df.columns[1]}` IS NOT NULL").select(F.trim(F.col(f"`{df.columns[0]}`")).alias("gene"), checked.cast("array<string>").alias("modes"))


def read_numbers(spark: SparkSession, path: str, key: str, column: str) -> DataFrame:
    """sample_id, value of a table's column of numbers; rows without a number are left out."""
    df = read_delimited(spark, path)
    return df.select(F.col(f"`{key}`").alias("sample_id"), F.col(f"`{column}`").try_cast("double").alias("value")).where("value IS NOT NULL")


#: Levels of a covariate that is named categorical, at most.
MOST_LEVELS = 50


def read_covariates(spark: SparkSession, path: str, samples: list[str], sep: str | None = None, categorical: list[str] | None = None) -> DataFrame:
    """sample_id and numeric columns for exactly the samples; text with up to five levels, and every column that is named
    categorical, is coded, the first level dropped.

    A sample without a row, a missing number, or more levels raises.
    """
    df = read_delimited(spark, path, sep)
    key, names = df.columns[0], df.columns[1:]
    wanted = spark.createDataFrame([(s,) for s in samples], "sample_id string")
    df = df.withColumnRenamed(key, "sample_id")
    absent = [r.sample_id for r in wanted.join(df, "sample_id", "left_anti").limit(5).collect()]
    if absent:
        raise ValueError(f"no covariates for {', '.join(sorted(absent))}")
    df = df.join(wanted, "sample_id", "left_semi")
    odd = df.agg(*(F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull()).alias(c) for c in names)).first()
    out = [F.col("sample_id")]
    if unknown := sorted(set(categorical or []) - {*names}):
        raise ValueError(f"no covariates {', '.join(unknown)}")
    for c in names:
        if not odd[c] and c not in (categorical or []):
            out.append(F.col(f"`{c}`").try_cast("double").alias(c))
            continue
        most = MOST_LEVELS if c in (categorical or []) else 5
        levels = sorted(r[0] for r in df.select(f"`{c}`").where(f"`{c}` IS NOT NULL").distinct().limit(most + 1).collect())
        if len(levels) > most:
            raise ValueError(f"covariate {c} has more than {most} levels")
        out += [(F.col(f"`{c}`") == v).cast("double").alias(f"{c}_{v}") for v in levels[1:]]
    df = df.select(*out)
    empty = df.agg(*(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns)).first().asDict()
    if any(empty.values()):
        raise ValueError(f"missing values in {', '.join(k for k, v in empty.items() if v)}")
    return df


def read_components(spark: SparkSession, path: str, k: int) -> DataFrame:
    """sample_id, pc1..pck of PLINK (with or without header), or a table of sample and numbers."""
    f = F.split(F.trim("value"), r"[\s,]+")
    rows = spark.read.text(path).where("trim(value) <> '' AND NOT startswith(trim(value), '#')").select(f.alias("f"))
    first = rows.first()
    if first is None:
        raise ValueError("no components")

    def is_number(s: str) -> bool:
        try:
            float(s)
            return True
        except ValueError:
            return False

    # two identifier columns if the second is text too or repeats the first
    data = next((r.f for r in rows.limit(2).collect() if is_number(r.f[-1])), first.f)
    skip = 2 if len(data) > 2 and (not is_number(data[1]) or data[0] == data[1]) else 1
    pcs = [F.get("f", F.lit(skip + i)).try_cast("double").alias(f"pc{i + 1}") for i in range(min(k, len(data) - skip))]
    return rows.select(F.get("f", F.lit(skip - 1)).alias("sample_id"), *pcs).where("pc1 IS NOT NULL")


def read_gene_weights(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """gene, weight of the first column and the named one (the second, if none is named); a weight that is no positive
    number, or no such column, raises."""
    df = read_delimited(spark, path)
    if column is not None and column not in df.columns:
        raise ValueError(f"no column {column} in {path}")
    w = F.col(f"`{column or df.columns[1]}`").try_cast("double")
    checked = F.when(w > 0, w).otherwise(F.raise_error(F.concat(F.lit("not a positive weight: "), F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit("?")))))
    return df.select(F.col(f"`{df.columns[0]}`").alias("gene"), checked.cast("double").alias("weight"))


def read_pm5_lookup(spark: SparkSession, path: str) -> DataFrame:
    """gene, aa_pos, ref_aa, alt_aa, clnsig, review of a lookup: one object with all keys, or an object a line."""
    raw = spark.read.text(path, wholetext=True)
    entry = "array<struct<ref_aa:string,alt_aa:string,clnsig:string,review:string>>"
    table = F.from_json("value", F.lit(f"struct<lookup:map<string,{entry}>>"))
    rows = raw.select(F.explode(table["lookup"]).alias("key", "entries"))
    lines = spark.read.text(path).select(F.from_json("value", F.lit(f"struct<key:string,entries:{entry}>")).alias("o")).where("o.key IS NOT NULL")
    rows = rows.union(lines.select("o.key", "o.entries")).select("key", F.inline("entries"))
    return rows.select(F.substring_index("key", ":", 1).alias("gene"), F.substring_index("key", ":", -1).try_cast("int").alias("aa_pos"), "ref_aa", "alt_aa", "clnsig", "review")


def read_clinvar_summary(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, sep="\t", header=True, quote="")
    return df.toDF(*[c.lstrip("#") for c in df.columns])


def read_scoring_model(folder: str) -> dict:
    """variables, formulas and output_scores of a model's folder."""
    out = {}
    for name in ("variable_assignment_config.json", "formula_config.json"):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out |= json.load(f)
    return out


def read_sample_files(spark: SparkSession, pattern: str, sample_regex: str) -> DataFrame:
    """All matching TSVs together, with the sample that each path names."""
    df = spark.read.csv(pattern, sep="\t", header=True, nullValue="", quote="", enforceSchema=False)
    return df.withColumn("sample_id", F.regexp_extract(F.col("_metadata.file_path"), sample_regex, 1))


def read_manifest(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Rows of a small TSV by their first column."""
    df = read_delimited(spark, path)
    return {r[0]: r.asDict() for r in df.collect()}


def read_reads(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, path of a file of sample,reads lines (comma or tab)."""
    f = F.split("value", "[,\t]")
    rows = spark.read.text(path).where("trim(value) <> '' AND NOT startswith(value, '#')")
    return rows.select(F.trim(F.get(f, F.lit(0))).alias("sample_id"), F.trim(F.get(f, F.lit(1))).alias("path")).where("path <> ''")


def read_gene_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """gene, chrom, start, end (0-based, half-open) of a BED of genes, or of the genes of a GTF or GFF."""
    if not path.removesuffix(".gz").endswith((".gtf", ".gff", ".gff3")):
        return read_bed(spark, path).select(F.col("name").alias("gene"), "chrom", "start", "end")
    f = F.split("value", "\t")
    name = F.regexp_extract(F.get(f, F.lit(8)), r'(?:gene_name|gene|Name)[ =]"?([^";]+)', 1)
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.get(f, F.lit(2)) == "gene")
    return rows.select(name.alias("gene"), F.regexp_replace(F.get(f, F.lit(0)), "^chr", "").alias("chrom"), (F.get(f, F.lit(3)).cast("bigint") - 1).alias("start"), F.get(f, F.lit(4)).cast("bigint").alias("end")).where("gene <> ''")


def gene_regions(coordinates: DataFrame, genes: list[str], expand: int = 0, prefix: str = "") -> DataFrame:
    """chrom, start, end in order: the genes' intervals (all, if that is the list), widened, overlapping ones merged.

    A gene without coordinates raises.
    """
    from helicase.operators import intervals

    rows = coordinates
    if genes != ["all"]:
        wanted = coordinates.sparkSession.createDataFrame([(g,) for g in genes], "gene string")
        absent = sorted(r.gene for r in wanted.join(coordinates, "gene", "left_anti").collect())
        if absent:
            raise ValueError(f"no coordinates for {', '.join(absent[:10])}")
        rows = coordinates.join(F.broadcast(wanted), "gene", "left_semi")
    merged = intervals.merged(intervals.expanded(rows.select("chrom", "start", "end"), expand))
    return merged.withColumn("chrom", F.concat(F.lit(prefix), "chrom")).orderBy("chrom", "start", "end")
