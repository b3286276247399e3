"""Statistics of a variant table: fixed ones, pivots, and those that a configuration names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helicase.plans.pyexpr import Aggregates, ExpressionError, named


# Statistics where no configuration names others.
DEFAULT = {
    "dataset_stats": [
        {"name": "total_variants", "expression": "len(df)"},
        {"name": "total_genes", "expression": "df['GENE'].nunique()", "required_columns": ["GENE"]},
        {"name": "total_samples", "expression": "len([col for col in df.columns if col.endswith('_GT')])"},
        {"name": "high_impact_count", "expression": "(df['IMPACT'] == 'HIGH').sum()", "required_columns": ["IMPACT"]},
        {"name": "moderate_impact_count", "expression": "(df['IMPACT'] == 'MODERATE').sum()", "required_columns": ["IMPACT"]},
        {"name": "mean_allele_frequency", "expression": "pd.to_numeric(df['gnomAD_exomes_AF'], errors='coerce').mean()", "required_columns": ["gnomAD_exomes_AF"]},
    ],
    "gene_stats": [
        {"name": "variant_count", "expression": "size()", "groupby": "GENE"},
        {"name": "high_impact_variants", "expression": "(group_df['IMPACT'] == 'HIGH').sum()", "groupby": "GENE", "required_columns": ["IMPACT"]},
        {"name": "mean_cadd_score", "expression": "pd.to_numeric(group_df['dbNSFP_CADD_phred'], errors='coerce').mean()", "groupby": "GENE", "required_columns": ["dbNSFP_CADD_phred"]},
        {"name": "max_cadd_score", "expression": "pd.to_numeric(group_df['dbNSFP_CADD_phred'], errors='coerce').max()", "groupby": "GENE", "required_columns": ["dbNSFP_CADD_phred"]},
        {"name": "unique_consequences", "expression": "group_df['Consequence'].nunique()", "groupby": "GENE", "required_columns": ["Consequence"]},
    ],
    "grouped_stats": [
        {"name": "variants_by_impact_and_gene", "expression": "size()", "groupby": ["GENE", "IMPACT"], "output_format": "pivot"},
        {"name": "inheritance_pattern_summary", "expression": "size()", "groupby": ["Inheritance_Pattern"], "required_columns": ["Inheritance_Pattern"]},
    ],
}


def configured(df: DataFrame, config: dict | None = None) -> dict[str, DataFrame]:
    """The tables of a configuration (the default one if None): dataset, genes, and one per grouped statistic by name;
    those whose columns are not there are left out."""
    config = DEFAULT if config is None else config
    out = {"dataset": dataset(df, config.get("dataset_stats", []))}
    genes = [s for s in config.get("gene_stats", []) if s.get("groupby", "GENE") in df.columns]
    if _usable(df, genes):
        out["genes"] = per_gene(df, genes)
    for s in config.get("grouped_stats", []):
        if all(c in df.columns for c in [*s["groupby"], *s.get("required_columns", [])]) and _usable(df, [s]):
            out[s["name"]] = grouped(df, s)
    return out


def united(tables: list[DataFrame]) -> DataFrame:
    """Tables of statistics one below the other; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def basic(variants: DataFrame, calls: DataFrame, n_samples: int) -> DataFrame:
    """metric, value: variants, samples, genes, het and hom calls, and counts by EFFECT and IMPACT."""
    one = variants.agg(F.count("*").alias("Number of variants"), F.count_distinct("GENE").alias("Number of genes"))
    gts = calls.agg(F.count_if(F.col("dosage") == 1).alias("Het counts"), F.count_if(F.col("dosage") == 2).alias("Hom counts"))

    def tall(df: DataFrame) -> DataFrame:
        pairs = ", ".join(f"'{c}', cast(`{c}` AS bigint)" for c in df.columns)
        return df.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (metric, value)")

    parts = [tall(one), tall(gts), variants.limit(1).select(F.lit("Number of samples").alias("metric"), F.lit(n_samples).cast("bigint").alias("value"))]
    for name, column in (("Effect", "EFFECT"), ("Impact", "IMPACT")):
        counts = variants.where(f"{column} IS NOT NULL").groupBy(column).agg(F.count("*").alias("value"))
        parts.append(counts.select(F.concat(F.lit(f"{name}_"), F.col(column)).alias("metric"), "value"))
    return reduce(DataFrame.unionByName, parts)


def by_gene(counts: DataFrame, columns: tuple[str, ...] = ("proband_count", "control_count", "proband_allele_count", "control_allele_count")) -> DataFrame:
    """Sums per GENE; a column that is not there is 0."""
    return counts.groupBy("GENE").agg(*((F.sum(c) if c in counts.columns else F.lit(0)).cast("bigint").alias(c) for c in columns))


def pivot(variants: DataFrame, column: str, values: list[str] | None = None) -> DataFrame:
    """GENE by the values of a column: counts, 0 where there is none."""
    return variants.groupBy("GENE").pivot(column, values).count().fillna(0)


def merged(gene_stats: DataFrame, *others: DataFrame) -> DataFrame:
    out = gene_stats
    for o in others:
        out = out.join(o, "GENE", "left")
    return out.fillna(0)


def _usable(df: DataFrame, stats: list[dict]) -> dict[str, object]:
    """Compiled statistics; those with a missing column or an expression that is not allowed are left out."""
    compiler, out = Aggregates(named(df)), {}
    for s in stats:
        if all(c in df.columns for c in s.get("required_columns", [])):
            try:
                out[s["name"]] = compiler.compile_stat(s["expression"])
            except ExpressionError:
                continue
    return out


def dataset(df: DataFrame, stats: list[dict]) -> DataFrame:
    """metric, value (double): all statistics in one aggregation."""
    made = _usable(df, stats)
    if not made:
        return df.sparkSession.createDataFrame([], "metric string, value double")
    row = df.agg(*(c.cast("double").alias(n) for n, c in made.items()))
    pairs = ", ".join(f"'{n}', `{n}`" for n in made)
    return row.selectExpr(f"stack({len(made)}, {pairs}) AS (metric, value)")


def per_gene(df: DataFrame, stats: list[dict], default: str = "GENE") -> DataFrame:
    """One aggregation per key set, joined on GENE."""
    by: dict[str, list[dict]] = {}
    for s in stats:
        by.setdefault(s.get("groupby", default), []).append(s)
    parts = [df.groupBy(k).agg(*(c.cast("double").alias(n) for n, c in _usable(df, ss).items())) for k, ss in by.items() if k in df.columns]
    return reduce(lambda a, b: a.join(b, default, "outer"), parts)


def grouped(df: DataFrame, stat: dict) -> DataFrame:
    """A statistic by its keys, long (value) or, with two keys and that format, pivoted on the second."""
    keys, made = list(stat["groupby"]), _usable(df, [stat])
    if not made:
        raise ExpressionError(stat["expression"])
    value = made[stat["name"]].cast("double").alias("value")
    if stat.get("output_format") == "pivot" and len(keys) == 2:
        return df.groupBy(keys[0]).pivot(keys[1]).agg(value).fillna(0.0)
    return df.groupBy(*keys).agg(value)
