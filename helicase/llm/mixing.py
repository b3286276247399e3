"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document draws u from a hash of its doc_id and the seed; its key is -ln(u) / quality.  Within a source the
documents of least key come first (the order of weighted sampling without replacement).  A source's target is taken
as complete epochs, every document so many times, and then a fraction: documents in key order until their prefix sum
of words reaches what is left; the document that crosses it is cut at a word, or taken whole if most of it fits.

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating.  They share SHARE of all words; none gets
more than MOST_EPOCHS times its own, and what that leaves is shared again by weight.  That fixed point is found in
closed form: with sources by cap per weight, all before some place are capped and the others get level * weight.

A source may hold any share of the rows: rows are grouped by source and key range, prefix sums are window sums inside
such a group plus the sums of the groups before, which come from a table of sums.  Ranges are steps of the key's
logarithm, halved until the fullest of all sources has about RANGE_ROWS rows, whatever qualities do to the keys (but rows
with one doc_id have one key and so one group; only their numbers are in it).  Only doc_id, source, size and key are shuffled.  Sources themselves are few: their table,
a row each, is ordered in one task.

Defined results: a null text has no words and is never taken.  Rows with one doc_id have one key if their quality is
one, and go by size; repeated rows are documents like any other.  A source without words has target 0.  An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helicase.llm.common import materialised

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1"
#: Steps of a doubling of the key at first, how often they are cut at most (doubles tell no more apart), and rows of a range.
STEPS = 64
MOST_CUTS = 1 << 36
RANGE_ROWS = 20_000
#: Hidden column by which repeated() knows rows.
ROW = "_mixing_row"
# Characters that lower a document's quality.
SYMBOLS = "#*$%&|<>"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def quality(text: Column) -> Column:
    """From 0.05 to 1: falls with the share of symbols, to the least at one in ten."""
    chars = F.length(text)
    share = (chars - F.length(F.translate(text, SYMBOLS, ""))) / F.greatest(chars, F.lit(1))
    return F.coalesce(F.lit(1.0) - F.lit(0.95) * F.least(share * F.lit(10.0), F.lit(1.0)), F.lit(1.0))


def uniform(doc_id: Column, seed: str) -> Column:
    """In (0, 1), from 52 bits of a hash."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame) -> DataFrame:
    """skey, source_size, target from rows with skey, source_size."""
    by_name, by_cap = Window.orderBy("skey"), Window.orderBy("ratio", "skey")
    weight = F.get(F.lit(list(WEIGHTS)), (F.row_number().over(by_name) - 1) % len(WEIGHTS)).cast("double")
    rows = sizes.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * MOST_EPOCHS).cast("double"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    every = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every).cast("double") * F.lit(SHARE)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level)
    rows = rows.withColumn("level", F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(every))
    return rows.select("skey", "source_size", F.least("cap", F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target"))


def mixed(docs: DataFrame, whole: bool = False, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken and keep's columns for each row of docs (doc_id, source, text)."""
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), (-F.ln(uniform(F.col("doc_id"), seed)) / quality(F.col("text"))).alias("key"), *keep)
    rows = rows.withColumn("skey", F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source")))
    rows = materialised(rows.select("doc_id", "size", "key", "skey", *keep), "mix")
    scale = F.log2("key") * STEPS
    full = rows.groupBy("skey", F.floor(scale).alias("step")).count().agg(F.max("count")).first()[0] or 0
    rows = rows.withColumn("reach", F.floor(scale * F.lit(min(MOST_CUTS, max(1, -(-full // RANGE_ROWS))))))
    sums = rows.groupBy("skey", "reach").agg(F.sum("size").alias("part"))
    aims = targets(sums.groupBy("skey").agg(F.sum("part").alias("source_size")))
    ahead = Window.partitionBy("skey").orderBy("reach").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("skey", "reach", F.coalesce(F.sum("part").over(ahead), F.lit(0)).alias("base")).join(aims, "skey")
    rows = rows.join(sums, ["skey", "reach"])
    inside = Window.partitionBy("skey", "reach").orderBy("key", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("before", F.col("base") + F.sum("size").over(inside) - F.col("size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    left = F.floor(F.col("target") - epochs * F.col("source_size") + F.lit(0.5)).cast("bigint") - F.col("before")
    if whole:
        extra = F.when(left * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    else:
        extra = F.least("size", F.greatest(left, F.lit(0)))
    return rows.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + extra).cast("bigint").alias("taken"), *keep)


def repeated(docs: DataFrame) -> DataFrame:
    """docs, every row as often as the mix takes it whole.

    Rows are known by a hash of all their columns: rows that share it are alike, whatever other rows share their doc_id.
    What the mix takes of such a group is dealt evenly; the few groups that a budget crosses, one a source at most, give
    what is left over as copies of one row.
    """
    known = docs.withColumn(ROW, F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns)))
    taken = mixed(known, whole=True, keep=(ROW,)).where("size > 0").groupBy(ROW)
    taken = taken.agg(F.count("*").alias("n"), F.sum(F.floor(F.col("taken") / F.col("size"))).alias("times")).where("times > 0")
    each, left = (F.floor(F.col("times") / F.col("n"))).cast("int"), (F.col("times") % F.col("n")).cast("int")
    taken = materialised(taken.select(ROW, each.alias("_mixing_each"), left.alias("_mixing_left")), "taken")
    rows = known.join(taken, ROW)
    copies = lambda n: F.explode(F.sequence(F.lit(1), F.col(n)))
    every = rows.where("_mixing_each > 0").withColumn("_mixing_copy", copies("_mixing_each")).select(*docs.columns)
    if taken.where("_mixing_left > 0").isEmpty():
        return every
    one = rows.where("_mixing_left > 0").groupBy(ROW, "_mixing_left").agg(F.first(F.struct(*docs.columns)).alias("_mixing_one"))
    return every.union(one.withColumn("_mixing_copy", copies("_mixing_left")).select("_mixing_one.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / {1 << 52}.0::DOUBLE)
      / coalesce(1.0::DOUBLE - 0.95::DOUBLE * least((length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::DOUBLE / greatest(length(text), 1)::DOUBLE * 10.0::DOUBLE, 1.0::DOUBLE), 1.0::DOUBLE) AS key
  FROM documents),
s AS (SELECT skey, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY skey) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, (source_size * 2)::DOUBLE AS cap FROM s),
l AS (
  SELECT *, cap / weight AS ratio,
    ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
      / sum(weight) OVER (ORDER BY cap / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (SELECT skey, source_size, least(cap, coalesce((SELECT level FROM l WHERE level <= ratio ORDER BY ratio, skey LIMIT 1), 0.0::DOUBLE) * weight) AS target FROM l),
b AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs,
    coalesce(sum(d.size) OVER (PARTITION BY d.skey ORDER BY d.key, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.skey = t.skey)
SELECT doc_id, size, source_size, target,
  (epochs * size + least(size, greatest(floor(target - epochs * source_size + 0.5::DOUBLE)::BIGINT - before, 0)))::BIGINT AS taken
FROM b
"""
