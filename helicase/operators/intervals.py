"""Interval algebra: range joins by bins, merging, intersection, expansion.

A range join needs an equality to be a hash or merge join.  Bins form a tree, eight of a level in one of the next; an
interval stands in the one bin that holds it, and who looks for it looks into one bin of each level.  Where only the
question is whether anything overlaps, both sides stand in all bins of BIN bases that they touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = 1 << 14


def bare_chrom(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "^chr", "")


def _binned(regions: DataFrame, start: str, end: str, size: int) -> DataFrame:
    first, last = F.floor(F.col(start) / size), F.floor((F.col(end) - 1) / size)
    return regions.withColumn("_bin", F.explode(F.sequence(first, last)))


#: Bits of the bases of a bin by level: each bin holds eight of the level below, the last level holds any chromosome.
SHIFTS = (14, 17, 20, 23, 26, 29, 62)


def _level(start: Column, end: Column) -> Column:
    """The level whose one bin holds the interval: the lowest at which its first and last base share a bin."""
    return F.coalesce(*(F.when(F.shiftright(start, s) == F.shiftright(end - 1, s), F.lit(i)) for i, s in enumerate(SHIFTS)), F.lit(len(SHIFTS) - 1))


def _bin(start: Column, level: Column) -> Column:
    """A bin's number: its level and its place there."""
    place = F.coalesce(*(F.when(level == i, F.shiftright(start, s)) for i, s in enumerate(SHIFTS)))
    return place * len(SHIFTS) + level


def _above(start: Column, own: Column, strictly: bool) -> Column:
    """The numbers of the bins that hold the interval's own bin; that bin too, unless strictly."""
    bins = [F.when((own < i) if strictly else (own <= i), F.shiftright(start, s) * len(SHIFTS) + i) for i, s in enumerate(SHIFTS)]
    return F.array_compact(F.array(*bins))


def indexed(regions: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """regions with _bin, the one bin of a tree that holds each: as many rows as before, however long they are."""
    return regions.withColumn("_bin", _bin(F.col(start), _level(F.col(start), F.col(end))))


def at_positions(variants: DataFrame, regions: DataFrame) -> DataFrame:
    """variants (chrom, pos, others) with the name of every region [start, end) that holds the position.

    A position looks into one bin of each level that regions have.
    """
    right = indexed(regions.where("end > start").select(bare_chrom(F.col("chrom")).alias("_chrom"), F.col("start").alias("_start"), F.col("end").alias("_end"), "name"), "_start", "_end")
    levels = sorted(r[0] for r in right.select(F.pmod("_bin", F.lit(len(SHIFTS)))).distinct().collect())  # seven at most
    bins = F.array(*(F.shiftright(F.col("pos").cast("bigint"), SHIFTS[i]) * len(SHIFTS) + i for i in levels)) if levels else F.array().cast("array<bigint>")
    left = variants.withColumns({"_chrom": bare_chrom(F.col("chrom")), "_bin": F.explode(bins)})
    found = left.join(right, ["_chrom", "_bin"]).where((F.col("pos") >= F.col("_start")) & (F.col("pos") < F.col("_end")))
    return found.drop("_chrom", "_bin", "_start", "_end")


def any_overlap(spans: DataFrame, regions: DataFrame, start: str, end: str, size: int = BIN) -> DataFrame:
    """Rows whose span touches a region, once each.

    Spans inside one bin, nearly all, meet regions in one semi-join; only longer ones are dealt to their bins and made
    single again.
    """
    first, last = F.floor(F.col(start) / size), F.floor((F.col(end) - 1) / size)
    rows = spans.withColumns({"_chrom": bare_chrom(F.col("chrom")), "_bin": first, "_last": last})
    right = _binned(regions.select(bare_chrom(F.col("chrom")).alias("_rchrom"), F.col("start").alias("_rstart"), F.col("end").alias("_rend")), "_rstart", "_rend", size).withColumnRenamed("_bin", "_rbin")
    meets = (F.col("_chrom") == F.col("_rchrom")) & (F.col("_bin") == F.col("_rbin")) & (F.col(start) < F.col("_rend")) & (F.col("_rstart") < F.col(end))
    short = rows.where("_bin = _last").join(right, meets, "left_semi").select(*spans.columns)
    wide = rows.where("_bin < _last").withColumn("_row", F.monotonically_increasing_id())
    wide = wide.withColumn("_bin", F.explode(F.sequence("_bin", "_last"))).join(right, meets, "left_semi")
    once = wide.groupBy("_row").agg(*(F.first(c, ignorenulls=False).alias(c) for c in spans.columns)).drop("_row")
    return short.union(once)


#: Bases of a stretch, in which intervals are ordered together.
STRETCH = 1 << 20
#: Intervals that are ordered by chromosome at once.
AT_ONCE = 200_000


def merged(regions: DataFrame) -> DataFrame:
    """Overlapping and book-ended intervals of a chromosome as one.

    Up to AT_ONCE intervals are ordered by chromosome.  More of them are ordered within stretches of their starts; how far
    those before a stretch reach, and how many islands begin before it, come from tables of one row a stretch, so no task
    orders a whole chromosome.
    """
    if regions.count() <= AT_ONCE:
        by = Window.partitionBy("chrom").orderBy("start", "end")
        apart = F.col("start") > F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
        rows = regions.select("chrom", "start", "end", F.coalesce(apart, F.lit(True)).cast("int").alias("_new"))
        rows = rows.withColumn("_island", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        return rows.groupBy("chrom", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")
    rows = regions.select("chrom", "start", "end", F.floor(F.col("start") / STRETCH).alias("_s"))
    earlier = Window.partitionBy("chrom").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy("chrom", "_s").agg(F.max("end").alias("_top")).select("chrom", "_s", F.max("_top").over(earlier).alias("_before"))
    order = Window.partitionBy("chrom", "_s").orderBy("start", "end")
    reach = F.greatest("_before", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.join(tops, ["chrom", "_s"]).withColumn("_new", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    rows = rows.withColumn("_i", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = rows.groupBy("chrom", "_s", "_i").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("_new").alias("_new"))
    counts = parts.groupBy("chrom", "_s").agg(F.sum("_new").alias("_n")).select("chrom", "_s", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    whole = parts.join(counts, ["chrom", "_s"]).groupBy("chrom", (F.col("_first") + F.col("_i")).alias("_island"))
    return whole.agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def intersected(a: DataFrame, b: DataFrame) -> DataFrame:
    """chrom, start, end of the overlap of every pair of intervals, one from each side.

    Of two that overlap one's bin holds the other's: each side looks its own bin and those above up in the other's.
    """
    left, right = (indexed(x.where("end > start").select("chrom", F.col("start").alias(f"s{i}"), F.col("end").alias(f"e{i}")), f"s{i}", f"e{i}") for i, x in ((1, a), (2, b)))
    level = F.pmod("_bin", F.lit(len(SHIFTS)))
    up = left.withColumn("_bin", F.explode(_above(F.col("s1"), level, False))).join(right, ["chrom", "_bin"])
    down = left.join(right.withColumn("_bin", F.explode(_above(F.col("s2"), level, True))), ["chrom", "_bin"])
    start, end = F.greatest("s1", "s2"), F.least("e1", "e2")
    return up.unionByName(down).where(start < end).select("chrom", start.alias("start"), end.alias("end"))


def expanded(regions: DataFrame, by: int) -> DataFrame:
    return regions.withColumns({"start": F.greatest(F.col("start") - by, F.lit(0)), "end": F.col("end") + by})


def balanced(regions: DataFrame, n: int) -> DataFrame:
    """regions with chunk 0..n-1: by order, about equal bases each."""
    order = Window.orderBy("chrom", "start", "end").rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("end") - F.col("start")
    total = F.sum(size).over(Window.partitionBy(F.lit(1)))
    return regions.withColumn("chunk", F.least(F.floor((F.sum(size).over(order) - size) * n / total), F.lit(n - 1)).cast("int"))
