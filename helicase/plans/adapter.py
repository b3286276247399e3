"""One fixed mapping from the star-schema tables to variants, samples, calls and pedigrees, in Spark and in SQL.

variant: part; gene: brand and type; sample: supplier; call: lineitem by part and supplier, whose dosage comes from the
largest quantity (above 48: 2, above 44: 1, else 0, which has no row); family: three suppliers in a row, the first the
child of the other two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HET, HOM = 44, 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    base = lambda letters: F.substring(F.lit(letters), (size % 4 + 1).cast("int"), F.lit(1))
    return table(spark, sf_dir, "part").select(
        key.alias("variant_id"), F.when(key % 23 == 22, "X").otherwise((key % 23).cast("string")).alias("chrom"), (key * 100 + size).alias("pos"),
        base("ACGT").alias("ref"), base("CGTA").alias("alt"), F.concat_ws(":", "p_brand", "p_type").alias("gene"),
        F.get(F.lit(["HIGH", "MODERATE", "LOW", "MODIFIER"]), (size % 4).cast("int")).alias("impact"),
        F.get(F.lit(["stop_gained", "missense_variant", "synonymous_variant", "intron_variant"]), (size % 4).cast("int")).alias("effect"),
        ((key % 1000) / 20000.0).alias("af"), (size * 0.7).alias("cadd"), ((key % 101) / 100.0).alias("revel"),
        F.when(key % 7 != 0, (key % 5).cast("string")).alias("ac"), F.when(key % 3 == 0, "PASS").when(key % 3 == 1, "q10").alias("filter"),
        F.get(F.lit(["tolerated", "deleterious"]), (key % 2).cast("int")).alias("sift"), F.get(F.lit(["benign", "probably_damaging", "possibly_damaging"]), (key % 3).cast("int")).alias("polyphen"),
        "p_brand", "p_type", "p_size", "p_name",
    )


def table_of(v: DataFrame) -> DataFrame:
    """variants under the report's column names."""
    return v.select("variant_id", F.col("chrom").alias("CHROM"), F.col("pos").alias("POS"), F.col("ref").alias("REF"), F.col("alt").alias("ALT"), F.col("gene").alias("GENE"), F.col("effect").alias("EFFECT"), F.col("impact").alias("IMPACT"), F.col("af").cast("string").alias("AF"), F.col("cadd").cast("string").alias("CADD"), F.col("filter").alias("FILTER"), "p_brand", "p_type")


def sample_id(c):
    return F.concat(F.lit("S"), F.lpad(c.cast("string"), 7, "0"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(sample_id(F.col("s_suppkey")).alias("sample_id"), F.col("s_suppkey").alias("place"), (F.col("s_nationkey") % 2 == 1).alias("is_case"), "s_nationkey", "s_acctbal", "s_suppkey")


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).select("sample_id", "is_case")


def pedigree(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = samples(spark, sf_dir), F.col("s_suppkey")
    child = k % 3 == 0
    return s.select(
        F.concat(F.lit("F"), F.floor(k / 3).cast("string")).alias("family_id"), "sample_id",
        F.when(child, sample_id(k + 1)).otherwise("0").alias("father_id"), F.when(child, sample_id(k + 2)).otherwise("0").alias("mother_id"),
        (k % 2 + 1).cast("string").alias("sex"), (child | (F.col("s_acctbal") > 4000)).alias("affected"), "place",
    )


def _called(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """variant_id, gene, sample_id, dosage, gt of every part and supplier that met in those line items."""
    q = lines.groupBy("l_partkey", "l_suppkey").agg(F.max("l_quantity").alias("q"))
    d = F.when(F.col("q") > HOM, 2).when(F.col("q") > HET, 1).otherwise(0)
    gene = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws(":", "p_brand", "p_type").alias("gene"))
    rows = q.join(gene, "l_partkey").select(F.col("l_partkey").alias("variant_id"), "gene", sample_id(F.col("l_suppkey")).alias("sample_id"), d.alias("dosage"))
    return rows.withColumn("gt", F.get(F.lit(["0/0", "0/1", "1/1"]), F.col("dosage")))


def all_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """variant_id, gene, sample_id, dosage, gt of every part and supplier that met, hom-ref ones too."""
    return _called(spark, sf_dir, table(spark, sf_dir, "lineitem"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all_calls without hom-ref ones: line items whose quantity makes no call change no other's largest, so they are not grouped."""
    return _called(spark, sf_dir, table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > HET))


#: The same mapping for DuckDB, to be followed by further common table expressions or a SELECT.
SQL = f"""
WITH RECURSIVE variants AS (
  SELECT p_partkey AS variant_id, CASE WHEN p_partkey % 23 = 22 THEN 'X' ELSE (p_partkey % 23)::VARCHAR END AS chrom, p_partkey * 100 + p_size AS pos,
    substr('ACGT', (p_size % 4 + 1)::INT, 1) AS ref, substr('CGTA', (p_size % 4 + 1)::INT, 1) AS alt, p_brand || ':' || p_type AS gene,
    CASE p_size % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MODERATE' WHEN 2 THEN 'LOW' ELSE 'MODIFIER' END AS impact,
    CASE p_size % 4 WHEN 0 THEN 'stop_gained' WHEN 1 THEN 'missense_variant' WHEN 2 THEN 'synonymous_variant' ELSE 'intron_variant' END AS effect,
    (p_partkey % 1000)::DOUBLE / 20000.0::DOUBLE AS af, p_size::DOUBLE * 0.7::DOUBLE AS cadd, (p_partkey % 101)::DOUBLE / 100.0::DOUBLE AS revel,
    CASE WHEN p_partkey % 7 <> 0 THEN (p_partkey % 5)::VARCHAR END AS ac, CASE p_partkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'q10' END AS filter,
    CASE p_partkey % 2 WHEN 0 THEN 'tolerated' ELSE 'deleterious' END AS sift, CASE p_partkey % 3 WHEN 0 THEN 'benign' WHEN 1 THEN 'probably_damaging' ELSE 'possibly_damaging' END AS polyphen,
    p_brand, p_type, p_size, p_name
  FROM part),
samples AS (SELECT 'S' || lpad(s_suppkey::VARCHAR, 7, '0') AS sample_id, s_suppkey AS place, s_nationkey % 2 = 1 AS is_case, s_acctbal, s_suppkey, s_nationkey FROM supplier),
pedigree AS (
  SELECT 'F' || (s_suppkey // 3)::VARCHAR AS family_id, sample_id,
    CASE WHEN s_suppkey % 3 = 0 THEN 'S' || lpad((s_suppkey + 1)::VARCHAR, 7, '0') ELSE '0' END AS father_id, CASE WHEN s_suppkey % 3 = 0 THEN 'S' || lpad((s_suppkey + 2)::VARCHAR, 7, '0') ELSE '0' END AS mother_id,
    (s_suppkey % 2 + 1)::VARCHAR AS sex, s_suppkey % 3 = 0 OR s_acctbal > 4000 AS affected, place
  FROM samples),
all_calls AS (
  SELECT l_partkey AS variant_id, p_brand || ':' || p_type AS gene, 'S' || lpad(l_suppkey::VARCHAR, 7, '0') AS sample_id,
    CASE WHEN max(l_quantity) > {HOM} THEN 2 WHEN max(l_quantity) > {HET} THEN 1 ELSE 0 END AS dosage
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey, l_suppkey, p_brand, p_type),
calls AS (SELECT *, CASE dosage WHEN 1 THEN '0/1' ELSE '1/1' END AS gt FROM all_calls WHERE dosage > 0)
"""
