"""Variant identifiers, link columns and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helicase.functions.text import link


def variant_ids(variants: DataFrame, chrom: str = "chrom", pos: str = "pos", ref: str = "ref", alt: str = "alt") -> DataFrame:
    """variants with VAR_ID: var_, a number in the total order of their keys, _ and four characters of the key's hash.

    Numbers come from counts of chromosome and position ranges, so no task orders the whole table.
    """
    span = 1 << 20
    rows = variants.withColumn("_range", F.floor(F.col(pos) / span))
    sizes = rows.groupBy(chrom, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy(chrom, "_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(chrom, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(chrom, "_range").orderBy(pos, ref, alt))
    rows = rows.join(sizes, [chrom, "_range"])
    digest = F.substring(F.md5(F.concat(F.col(chrom).cast("string"), F.col(pos).cast("string"), F.col(ref), F.col(alt))), 1, 4)
    number = (F.col("_before") + inside).cast("string")
    number = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return rows.withColumn("VAR_ID", F.concat(F.lit("var_"), number, F.lit("_"), digest)).drop("_range", "_before")


def links(variants: DataFrame, templates: dict[str, str]) -> DataFrame:
    """variants with a column per template, in order of names."""
    return variants.withColumns({n: link(templates[n], variants.columns) for n in sorted(templates)})


def _number(i: Column, width: int = 3) -> Column:
    text = i.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def sequential(samples: DataFrame, prefix: str = "SAMPLE") -> DataFrame:
    """sample_id, pseudonym by sorted ids: PREFIX_001."""
    return samples.select("sample_id", F.concat(F.lit(f"{prefix}_"), _number(F.row_number().over(Window.orderBy("sample_id")))).alias("pseudonym"))


def categorical(samples: DataFrame, category: str) -> DataFrame:
    """Numbers within the sample's category, whose name is cut to ten capitals and digits; UNKNOWN if it has none."""
    name = F.substring(F.regexp_replace(F.upper(F.coalesce(F.col(category), F.lit("UNKNOWN"))), "[^A-Z0-9]", ""), 1, 10)
    name = F.when(name == "", "UNKNOWN").otherwise(name)
    rows = samples.select("sample_id", name.alias("_c"))
    return rows.select("sample_id", F.concat("_c", F.lit("_"), _number(F.row_number().over(Window.partitionBy("_c").orderBy("sample_id")))).alias("pseudonym"))


def anonymous(samples: DataFrame, hashed: bool = False) -> DataFrame:
    """A letter for every 999 samples and three digits, or six characters of the id's hash."""
    if hashed:
        return _distinct(samples.select("sample_id", F.substring(F.md5("sample_id"), 1, 6).alias("pseudonym")))
    i = F.row_number().over(Window.orderBy("sample_id")) - 1
    return samples.select("sample_id", F.concat(F.char((65 + F.floor(i / 999)).cast("bigint")), _number(i % 999 + 1)).alias("pseudonym"))


def custom(samples: DataFrame, pattern: str) -> DataFrame:
    """A pattern of {index}, {index:03d} and columns of samples; SAMPLE_001 where a column is null."""
    import re

    i = F.row_number().over(Window.orderBy("sample_id"))
    parts = []
    for k, piece in enumerate(re.split(r"\{(\w+(?::0?\d+d)?)\}", pattern)):
        name, _, width = piece.partition(":")
        if k % 2 == 0:
            parts.append(F.lit(piece))
        elif name == "index":
            parts.append(_number(i, int(width.strip("0d") or 1)) if width else i.cast("string"))
        else:
            parts.append(F.col(name).cast("string") if name in samples.columns else F.lit(None).cast("string"))
    return _distinct(samples.select("sample_id", F.coalesce(F.concat(*parts), F.concat(F.lit("SAMPLE_"), _number(i))).alias("pseudonym")))


def _distinct(rows: DataFrame) -> DataFrame:
    """Equal pseudonyms get _2, _3 and so on, by sample."""
    n = F.row_number().over(Window.partitionBy("pseudonym").orderBy("sample_id"))
    return rows.withColumn("_n", n).select("sample_id", F.when(F.col("_n") == 1, F.col("pseudonym")).otherwise(F.concat("pseudonym", F.lit("_"), F.col("_n").cast("string"))).alias("pseudonym"))


def pseudonymised_calls(calls: DataFrame, names: DataFrame) -> DataFrame:
    """calls with pseudonyms for sample ids; ids without one stay."""
    return calls.join(names, "sample_id", "left").withColumn("sample_id", F.coalesce("pseudonym", "sample_id")).drop("pseudonym")


def pseudonymised_pedigree(pedigree: DataFrame, names: DataFrame) -> DataFrame:
    """The pedigree under pseudonyms, with families FAM001 by sorted id."""
    rows = pedigree
    for c in ("sample_id", "father_id", "mother_id"):
        rows = rows.join(names.select(F.col("sample_id").alias(c), F.col("pseudonym").alias("_p")), c, "left").withColumn(c, F.coalesce("_p", c)).drop("_p")
    family = F.dense_rank().over(Window.orderBy("family_id"))
    return rows.withColumn("family_id", F.concat(F.lit("FAM"), _number(family)))


def pseudonymised_text(rows: DataFrame, columns: list[str], names: DataFrame, key: str = "variant_id") -> DataFrame:
    """rows with the sample ids in text cells replaced: whole words that are sample ids.

    Cells are taken apart into words and what stands between, words are joined with the pseudonyms once for all columns,
    and all is put together again; no id is replaced inside a longer word.
    """
    piece = r"([A-Za-z0-9_.-]+|[^A-Za-z0-9_.-]+)"
    cells = F.array(*(F.struct(F.lit(c).alias("_column"), F.col(c).alias("_cell")) for c in columns))
    parts = rows.select(key, F.inline(cells)).where("_cell IS NOT NULL").select(key, "_column", F.posexplode(F.regexp_extract_all(F.col("_cell"), F.lit(piece))).alias("_i", "_word"))
    told = parts.join(names.select(F.col("sample_id").alias("_word"), "pseudonym"), "_word", "left")
    part = F.struct("_i", F.coalesce("pseudonym", "_word").alias("t"))
    whole = told.groupBy(key, "_column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["t"]), "").alias("_told"))
    wide = whole.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_column", "_told"))).alias("_told"))
    return rows.join(wide, key, "left").withColumns({c: F.coalesce(F.element_at("_told", F.lit(c)), F.col(c)) for c in columns}).drop("_told")
