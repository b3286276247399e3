"""Reports: summaries of one table and of many samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_genes(variants: DataFrame, n: int = 10) -> DataFrame:
    return variants.groupBy("GENE").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "GENE").limit(n)


def summary(variants: DataFrame, calls: DataFrame) -> DataFrame:
    """One row: variants, genes, samples, and maps of counts by impact and inheritance pattern."""
    counts = lambda c, out: variants.where(f"{c} IS NOT NULL AND {c} NOT IN ('none', 'reference')").groupBy(c).count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(c), "count")))).alias(out))
    one = variants.agg(F.count("*").alias("n_variants"), F.count_distinct("GENE").alias("n_genes")).withColumn("_k", F.lit(1))
    for part in [calls.agg(F.count_distinct("sample_id").alias("n_samples")), counts("IMPACT", "impacts")] + ([counts("Inheritance_Pattern", "patterns")] if "Inheritance_Pattern" in variants.columns else []):
        one = one.join(part.withColumn("_k", F.lit(1)), "_k")
    return one.drop("_k")


def occurrence_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with Variant_Count: how often the key occurs over all samples."""
    return rows.withColumn("Variant_Count", F.count("*").over(Window.partitionBy(*keys)))


def cohort_genes(rows: DataFrame, gene: str = "gene", sample: str = "sample_id") -> DataFrame:
    """gene, variant_count, sample_count, most samples first."""
    out = rows.groupBy(gene).agg(F.count("*").alias("variant_count"), F.count_distinct(sample).alias("sample_count"))
    return out.orderBy(F.desc("sample_count"), F.desc("variant_count"), gene)
