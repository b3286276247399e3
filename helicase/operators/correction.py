"""Multiple testing: Benjamini-Hochberg, Bonferroni, their weighted forms, Cauchy combination, genomic inflation.

Corrections order all tests of a family.  Different p-values are dealt to ranges of their logarithm, cut until the fullest
has about RANGE_ROWS; ranks are counts of the ranges before plus places inside one, and the running minimum is carried
backwards over ranges.  Only the table of ranges is one group.  Tables of genes, which are small, may say so (small) and
are ordered at once.  family names columns that keep families apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helicase.sources.store import materialised

#: Steps of a halving of p at first, and different p-values of a range, about.
STEPS = 64
RANGE_ROWS = 20_000
_ALL = "_family"


def _ranges(df: DataFrame, p: str, keys: list[str]) -> DataFrame:
    """_r, the range of each row's p, ascending with it."""
    scale = F.when(F.col(p) > 0, F.log2(F.col(p)) * STEPS).otherwise(F.lit(-1e6))
    full = df.groupBy(*keys, F.floor(scale).alias("_r")).count().agg(F.max("count")).first()[0] or 0
    return df.withColumn("_r", F.floor(scale * F.lit(max(1, -(-full // RANGE_ROWS)))))


def _carried(ranges: DataFrame, keys: list[str], value: str, backwards: bool) -> DataFrame:
    """keys, _r with _before (sum of the ranges before and, as _all, of all) or _after (the least value of those after)."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema if f.name in (*keys, "_r"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_r")
        own = table.select([*keys, "_r"])
        x = table[value].to_numpy()
        if backwards:
            later = np.append(np.minimum.accumulate(x[::-1])[::-1][1:], np.inf)
            return own.append_column("_after", pa.array(later, pa.float64()))
        sums = np.cumsum(x)
        return own.append_column("_before", pa.array(sums - x, pa.int64())).append_column("_all", pa.array(np.full(len(x), sums[-1]), pa.int64()))

    return ranges.groupBy(*keys).applyInArrow(run, f"{kinds}, _after double" if backwards else f"{kinds}, _before bigint, _all bigint")


def _bh(df: DataFrame, p: str, out: str, family: list[str], small: bool) -> DataFrame:
    # an ascending rank makes m p / rank, whose least value from there on is the adjusted p; of equal ones the last counts
    if small:
        up = Window.partitionBy(*family).orderBy(F.col(p).asc_nulls_last())
        every, tail = Window.partitionBy(*family), up.rowsBetween(0, Window.unboundedFollowing)
        ranked = df.withColumn("_raw", F.when(F.col(p).isNotNull(), F.col(p) * F.count(p).over(every) / F.row_number().over(up)))
        return ranked.withColumn(out, F.when(F.col(p).isNotNull(), F.least(F.min("_raw").over(tail), F.lit(1.0)))).drop("_raw")
    keys = family or [_ALL]
    df = df if family else df.withColumn(_ALL, F.lit(0))
    rows = materialised(df.where(F.col(p).isNotNull()).groupBy(*keys, F.col(p).alias("_value")).agg(F.count("*").alias("_n")), "p-values")
    rows = _ranges(rows, "_value", keys)
    counts = _carried(rows.groupBy(*keys, "_r").agg(F.sum("_n").alias("_n")), keys, "_n", False)
    inside = Window.partitionBy(*keys, "_r").orderBy("_value")
    rows = rows.join(counts, [*keys, "_r"])
    rank = F.col("_before") + F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = materialised(rows.withColumn("_raw", F.col("_value") * F.col("_all") / rank).select(*keys, "_r", "_value", "_raw"), "raw")
    later = _carried(rows.groupBy(*keys, "_r").agg(F.min("_raw").alias("_raw")), keys, "_raw", True)
    least = F.least(F.min("_raw").over(inside.rowsBetween(0, Window.unboundedFollowing)), F.col("_after"), F.lit(1.0))
    found = rows.join(later, [*keys, "_r"]).select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), "_value", least.alias(out))
    match = [F.col(p) == F.col("_value"), *(F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys))]
    return df.drop(out).join(found, match, "left").drop("_value", _ALL, *(f"_key{i}" for i in range(len(keys))))


def benjamini_hochberg(df: DataFrame, p: str = "p", out: str = "q", family: list[str] | None = None, small: bool = False) -> DataFrame:
    return _bh(df, p, out, family or [], small)


def _count(df: DataFrame, p: str, family: list[str]) -> tuple[DataFrame, Column]:
    """df, and the number of its tests by family, from an aggregate of its own."""
    if not family:
        return df, df.agg(F.count(p)).scalar()
    sizes = df.groupBy(*family).agg(F.count(p).alias("_tests"))
    return df.join(sizes, family, "left"), F.col("_tests")


def bonferroni(df: DataFrame, p: str = "p", out: str = "q", family: list[str] | None = None, small: bool = False) -> DataFrame:
    if small:
        return df.withColumn(out, F.least(F.col(p) * F.count(p).over(Window.partitionBy(*(family or []))), F.lit(1.0)))
    rows, n = _count(df, p, family or [])
    return rows.withColumn(out, F.least(F.col(p) * n, F.lit(1.0))).drop("_tests")


def weighted(df: DataFrame, weights: DataFrame, method: str = "fdr", p: str = "p", out: str = "q", small: bool = False) -> DataFrame:
    """df (gene, p) with out and fdr_weight: weights (gene, weight), 1 if absent, scaled to mean 1, divide p first.

    A single test keeps its p.
    """
    rows = df.join(weights.select("gene", "weight"), "gene", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    mean = F.avg(F.when(F.col(p).isNotNull(), F.col("weight")))
    if small:
        every = Window.partitionBy()
        mean, n = mean.over(every), F.count(p).over(every)
    else:
        rows = materialised(rows, "weighted")
        mean, n = rows.agg(mean).scalar(), rows.agg(F.count(p)).scalar()
    rows = rows.withColumn("fdr_weight", F.col("weight") / mean).withColumn("_n", n)
    rows = rows.withColumn("_p", F.least(F.col(p) / F.col("fdr_weight"), F.lit(1.0)))
    rows = _bh(rows, "_p", out, [], small) if method == "fdr" else bonferroni(rows, "_p", out, small=small)
    return rows.withColumn(out, F.when(F.col("_n") == 1, F.col(p)).otherwise(F.col(out))).drop("_p", "_n", "weight")


def cauchy(ps: list[Column], weights: list[float] | None = None) -> Column:
    """The Cauchy combination of p-values: nulls and ones drop out, one value is itself, tiny ones are 1 / (p pi)."""
    weights = weights or [1.0] * len(ps)
    used = [(p.isNotNull() & (p < 1)).cast("int") for p in ps]
    n = sum(used[1:], used[0])
    tan = [F.when(p < 1e-15, 1.0 / (p * math.pi)).otherwise(F.tan((F.lit(0.5) - p) * math.pi)) for p in ps]
    top = [F.when(u == 1, t * w).otherwise(0.0) for u, t, w in zip(used, tan, weights, strict=True)]
    low = [F.when(u == 1, F.lit(w)).otherwise(0.0) for u, w in zip(used, weights, strict=True)]
    t = sum(top[1:], top[0]) / F.nullif(sum(low[1:], low[0]), F.lit(0.0))
    both = F.when(t > 1e15, 1.0 / (t * math.pi)).otherwise(0.5 - F.atan(t) / math.pi)
    only = F.coalesce(*(F.when(u == 1, p) for u, p in zip(used, ps, strict=True)))
    ones = F.coalesce(*ps)
    return F.when(n == 0, ones).when(n == 1, only).otherwise(both)


def qq(df: DataFrame, p: str = "p", family: list[str] | None = None, small: bool = False, ties: list[str] | None = None) -> DataFrame:
    """df's tests with rank / (n + 1) and both sides on the -log10 scale.

    Equal p-values have following ranks, by the columns ties or, without these, in any order; those of one value, numbers
    and ties only, are numbered in one task.
    """
    keys, order = family or [], [p, *(ties or [])]
    rows = df.where(F.col(p).isNotNull())
    if small:
        rank, n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)), F.count("*").over(Window.partitionBy(*keys))
        rows = rows.withColumn("expected", rank / (n + 1))
    else:
        own = keys or [_ALL]
        rows = materialised(rows if keys else rows.withColumn(_ALL, F.lit(0)), "tests")
        rows = _ranges(rows, p, own)
        counts = _carried(rows.groupBy(*own, "_r").agg(F.count("*").alias("_n")), own, "_n", False)
        rows = rows.join(counts, [*own, "_r"])
        rank = F.col("_before") + F.row_number().over(Window.partitionBy(*own, "_r").orderBy(*order))
        rows = rows.withColumn("expected", rank / (F.col("_all") + 1)).drop("_r", "_before", "_all", _ALL)
    return rows.withColumns({"expected_log10": -F.log10("expected"), "observed_log10": -F.log10(F.greatest(F.col(p), F.lit(1e-300)))})
