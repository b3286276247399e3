"""Corrections by ranges, bins as a tree, components without squares: brute force and plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helicase.operators import association, burden, correction, intervals


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def adjusted(ps):
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    out, least = [0.0] * len(ps), 1.0
    for rank in range(len(ps), 0, -1):
        least = min(least, ps[order[rank - 1]] * len(ps) / rank)
        out[order[rank - 1]] = least
    return out


def test_ranked_corrections_equal_a_sort(spark, monkeypatch):
    """Ties across and inside ranges, zeros, ones, missing values and families, in ranges of a few p-values."""
    monkeypatch.setattr(correction, "RANGE_ROWS", 3)
    rnd = random.Random(3)
    ps = [rnd.choice([rnd.random(), rnd.random() ** 6, 0.5, 1.0, 0.0, 1e-200]) for _ in range(400)] + [None] * 5
    rows = [(i, p, "ab"[i % 2]) for i, p in enumerate(ps)]
    df = spark.createDataFrame(rows, "id int, p double, f string").repartition(4)
    for family, groups in (([], [[r for r in rows if r[1] is not None]]), (["f"], [[r for r in rows if r[1] is not None and r[2] == f] for f in "ab"])):
        found = {r.id: r for r in correction.benjamini_hochberg(df, family=family).collect()}
        plain = {r.id: r.q for r in correction.benjamini_hochberg(df, family=family, small=True).collect()}
        points = {r.id: r.expected for r in correction.qq(df, family=family).collect()}
        counts = {r.id: r.q for r in correction.bonferroni(df, family=family).collect()}
        assert len(found) == len(rows)
        assert all(found[i].q is None and found[i].p is None for i in range(400, 405))
        for group in groups:
            own = adjusted([r[1] for r in group])
            for r, q in zip(group, own, strict=True):
                assert found[r[0]].q == pytest.approx(q, rel=1e-12)
                assert plain[r[0]] == pytest.approx(q, rel=1e-12)
                assert counts[r[0]] == pytest.approx(min(1.0, r[1] * len(group)))
            assert sorted(points[r[0]] for r in group) == pytest.approx([(k + 1) / (len(group) + 1) for k in range(len(group))])
    weights = spark.createDataFrame([("a", 3.0)], "gene string, weight double")
    genes = df.where("p IS NOT NULL").withColumnRenamed("f", "gene")
    both = [{r.id: r.q for r in correction.weighted(genes, weights, small=s).collect()} for s in (True, False)]
    assert both[0] == pytest.approx(both[1])


def test_corrections_order_nothing_in_one_task(spark):
    df = spark.range(1000).select("id", ((F.col("id") * 7919) % 1009 / 1010.0 + 0.0001).alias("p"))
    for found in (correction.benjamini_hochberg(df), correction.qq(df), correction.bonferroni(df)):
        windows = [x for x in plan_of(found).split("\n") if "Window [" in x or "windowspecdefinition" in x]
        assert all("_r" in w for w in windows), windows


def overlapping(regions, start, end):
    return [r for r in regions if r[1] < end and start < r[2]]


def test_bins_hold_long_and_short_regions(spark):
    """Whole chromosomes beside exons: the same pairs as a search of all, and an index of as many rows as regions."""
    rnd = random.Random(8)
    regions = [("1", 0, 248_956_422, "whole"), ("chr2", 5, 6, "base"), ("1", 1 << 29, (1 << 29) + 1, "far")]
    for i in range(150):
        start = rnd.randrange(300_000_000)
        regions.append((rnd.choice(["1", "2"]), start, start + rnd.choice([1, 50, 16_384, 200_000, 9_000_000]), f"r{i}"))
    edges = [(1 << s) + d for s in (14, 17, 20, 23, 26, 29) for d in (-1, 0, 1)]
    regions += [("1", e - 1, e + 1, f"e{e}") for e in edges]
    table = spark.createDataFrame(regions, "chrom string, start bigint, end bigint, name string")
    assert intervals.indexed(table).count() == len(regions)
    points = [(i, rnd.choice(["1", "chr2"]), rnd.choice([*edges, rnd.randrange(300_000_000), 5])) for i in range(300)]
    found = intervals.at_positions(spark.createDataFrame(points, "id int, chrom string, pos int"), table)
    expected = {(i, r[3]) for i, c, pos in points for r in regions if r[0].removeprefix("chr") == c.removeprefix("chr") and r[1] <= pos < r[2]}
    got = [(r.id, r.name) for r in found.collect()]
    assert len(got) == len(expected) > 300
    assert set(got) == expected
    other = table.where("name <> 'whole'").select("chrom", (F.col("start") + 1000).alias("start"), (F.col("end") + 1500).alias("end"))
    pairs = sorted((r.chrom, r.start, r.end) for r in intervals.intersected(table, other).collect())
    right = [(r.chrom, r.start, r.end) for r in other.collect()]
    assert pairs == sorted((a[0], max(a[1], b[1]), min(a[2], b[2])) for a in regions for b in right if a[0] == b[0] and max(a[1], b[1]) < min(a[2], b[2]))
    assert intervals.at_positions(spark.createDataFrame(points, "id int, chrom string, pos int"), table.limit(0)).count() == 0


@pytest.mark.parametrize("at_once", [0, 200_000])
def test_merged_intervals(spark, monkeypatch, at_once):
    monkeypatch.setattr(intervals, "AT_ONCE", at_once)
    rows = [("1", 5, 10), ("1", 10, 12), ("1", 14, 15), ("1", 1, 3_000_000), ("2", 0, 1), ("2", 2, 3)]
    found = intervals.merged(spark.createDataFrame(rows, "chrom string, start bigint, end bigint"))
    assert sorted(tuple(r) for r in found.select("chrom", "start", "end").collect()) == [("1", 1, 3_000_000), ("2", 0, 1), ("2", 2, 3)]


def test_score_interval_inverts_the_score_test(spark):
    """At a limit the score statistic of the first cell is the quantile; zero cells and large counts too."""
    tables = [(12, 5, 88, 95), (1, 9, 9, 1), (0, 7, 40, 33), (3, 0, 97, 100), (20_000, 15_000, 480_000, 485_000), (5, 5, 0, 0)]
    df = spark.createDataFrame(tables, "a int, b int, c int, d int")
    way = burden.Interval("score", 0.1, 0.5)
    ratio, low, high = burden.odds(*(F.col(c) for c in "abcd"), way)
    for r in df.withColumns({"low": low, "high": high}).collect():
        a, b, c, d = (float(r[x]) for x in "abcd")
        if c + d == 0:
            assert r.low is None
            continue
        if 0 in (a, b, c, d):
            a, b, c, d = a + 0.5, b + 0.5, c + 0.5, d + 0.5
        row, col, n = a + b, a + c, a + b + c + d
        for theta, sign in ((r.low, 1), (r.high, -1)):
            # the expected cell at that odds ratio solves a quadratic
            q, p, s = theta - 1, -(theta * (row + col) + (n - row - col)), theta * row * col
            e = (-p - np.sqrt(p * p - 4 * q * s)) / (2 * q)
            z = (a - e) * np.sqrt(1 / e + 1 / (row - e) + 1 / (col - e) + 1 / (n - row - col + e))
            assert z == pytest.approx(sign * 1.6448536269514722, rel=1e-4)
        assert r.low < a * d / (b * c) < r.high


def test_components_hold_nothing_of_samples_squared(spark):
    """More samples than directions: the leading components of the centred matrix, by steps."""
    rng = np.random.default_rng(4)
    group = rng.integers(0, 3, 60)
    dosage = rng.binomial(2, np.clip(0.02 + 0.9 * (rng.random((3, 150)) < 0.3)[group], 0, 1))
    calls = [(int(v), f"s{s:02}", int(dosage[s, v])) for s, v in zip(*np.nonzero(dosage), strict=True)]
    df = spark.createDataFrame(calls, "variant_id bigint, sample_id string, dosage int").repartition(3)
    samples = spark.createDataFrame([(f"s{s:02}",) for s in range(60)], "sample_id string")
    found = association.principal_components(df, samples, 2)
    rows = np.array([tuple(r)[1:] for r in found.orderBy("sample_id").collect()])
    u, s, _ = np.linalg.svd(dosage - dosage.mean(0), full_matrices=False)
    assert np.allclose(np.abs(rows), np.abs(u[:, :2] * s[:2]), atol=1e-5)
    assert all(rows[np.abs(rows[:, c]).argmax(), c] > 0 for c in range(2))
