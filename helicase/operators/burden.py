"""Gene burden: cohorts, per-variant counts, two-level aggregation, exact tests."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helicase.functions import dist
from helicase.operators.correction import benjamini_hochberg, bonferroni


@dataclass(frozen=True)
class Interval:
    """How odds ratios get their interval: on the log scale (normal_approx) or from score tests (score)."""

    method: str = "normal_approx"
    alpha: float = 0.05
    continuity: float = 0.5

    def z(self) -> float:
        return dist.norm_ppf(1 - self.alpha / 2)


class TooFewCases(ValueError):
    """The cohort has fewer cases than a test needs."""


def cohort(samples: DataFrame, cases: DataFrame | None = None, controls: DataFrame | None = None) -> DataFrame:
    """sample_id, is_case: named samples win; a missing side is all others; with neither, all are controls."""
    rows = samples.select("sample_id").distinct()
    if cases is None and controls is None:
        return rows.withColumn("is_case", F.lit(False))

    def marked(side: DataFrame, name: str) -> DataFrame:
        return side.select("sample_id").distinct().withColumn(name, F.lit(True))

    if cases is not None:
        rows = rows.join(marked(cases, "_case"), "sample_id", "left")
    if controls is not None:
        rows = rows.join(marked(controls, "_control"), "sample_id", "left")
    if controls is None:
        return rows.select("sample_id", F.coalesce("_case", F.lit(False)).alias("is_case"))
    if cases is None:
        return rows.select("sample_id", F.col("_control").isNull().alias("is_case"))
    return rows.where("_case IS NOT NULL OR _control IS NOT NULL").select("sample_id", F.coalesce("_case", F.lit(False)).alias("is_case"))


def cohort_by_terms(phenotypes: DataFrame, case_terms: list[str], control_terms: list[str]) -> DataFrame:
    """The same by phenotype terms (sample_id, terms): with both lists a sample must match exactly one."""
    hit = lambda terms: F.arrays_overlap("terms", F.array(*map(F.lit, terms))) if terms else F.lit(False)
    rows = phenotypes.select("sample_id", F.coalesce(hit(case_terms), F.lit(False)).alias("c"), F.coalesce(hit(control_terms), F.lit(False)).alias("k"))
    if case_terms and control_terms:
        return rows.where("c <> k").select("sample_id", F.col("c").alias("is_case"))
    return rows.select("sample_id", (F.col("c") if case_terms else ~F.col("k") if control_terms else F.lit(False)).alias("is_case"))


def cohort_sizes(who: DataFrame) -> tuple[int, int]:
    n = who.agg(F.count_if("is_case"), F.count_if(~F.col("is_case"))).first()
    return n[0], n[1]


def variant_counts(calls: DataFrame, who: DataFrame) -> DataFrame:
    """Per variant the carriers, alleles and homozygotes among cases (proband) and controls."""
    rows = calls.where("dosage > 0").join(who, "sample_id")

    def counts(side: Column, name: str) -> list[Column]:
        return [
            F.count_if(side).alias(f"{name}_variant_count"), F.coalesce(F.sum(F.when(side, F.col("dosage"))), F.lit(0)).cast("bigint").alias(f"{name}_allele_count"),
            F.count_if(side & (F.col("dosage") == 2)).alias(f"{name}_homozygous_count"),
        ]

    return rows.groupBy("variant_id").agg(*counts(F.col("is_case"), "proband"), *counts(~F.col("is_case"), "control"))


def gene_counts(calls: DataFrame, who: DataFrame) -> DataFrame:
    """Per gene, from each sample's largest dosage there: carriers and alleles of both sides, and the gene's variants."""
    rows = calls.where("dosage > 0")
    best = rows.groupBy("gene", "sample_id").agg(F.max("dosage").alias("d")).join(who, "sample_id")
    case = F.col("is_case")
    sums = best.groupBy("gene").agg(
        F.count_if(case).alias("case_carriers"), F.count_if(~case).alias("control_carriers"),
        F.coalesce(F.sum(F.when(case, F.col("d"))), F.lit(0)).cast("bigint").alias("case_alleles"), F.coalesce(F.sum(F.when(~case, F.col("d"))), F.lit(0)).cast("bigint").alias("control_alleles"),
    )
    variants = rows.groupBy("gene").agg(F.count_distinct("variant_id").alias("n_variants"))
    return sums.join(variants, "gene")


def log_factorial(n: Column) -> Column:
    """ln n!: a table below 16, Stirling's series from there on (its error is below 1e-13)."""
    small = F.lit([math.lgamma(i + 1.0) for i in range(16)])
    x = F.greatest(n, F.lit(16)).cast("double")
    tail = F.lit(1.0) / (x * 12.0) - F.lit(1.0) / (x * x * x * 360.0) + F.lit(1.0) / (x * x * x * x * x * 1260.0)
    return F.when(n < 16, F.get(small, F.greatest(n, F.lit(0)).cast("int"))).otherwise((x + 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + tail)


def fisher(df: DataFrame, a: str, b: str, c: str, d: str, out: str = "p") -> DataFrame:
    """df with the two-sided exact p of [[a, b], [c, d]]: tables no likelier than the one seen, ties within 1e-7.

    Log probabilities follow from the first by the ratio of neighbours; a running pair of log and total passes over the
    support once.
    """
    a_, b_, c_, d_ = (F.col(x).cast("bigint") for x in (a, b, c, d))
    df = df.withColumns({"_n": a_ + b_ + c_ + d_, "_row": a_ + b_, "_col": a_ + c_})
    df = df.withColumns({"_lo": F.greatest(F.lit(0), F.col("_row") + F.col("_col") - F.col("_n")), "_hi": F.least("_row", "_col")})
    n, row, col = F.col("_n"), F.col("_row"), F.col("_col")
    fixed = log_factorial(row) + log_factorial(n - row) + log_factorial(col) + log_factorial(n - col) - log_factorial(n)
    df = df.withColumn("_fixed", fixed)

    def log_p(k: Column) -> Column:
        return F.col("_fixed") - log_factorial(k) - log_factorial(row - k) - log_factorial(col - k) - log_factorial(n - row - col + k)

    df = df.withColumns({"_first": log_p(F.col("_lo")), "_seen": log_p(a_) + 1e-7})

    def ratio(k: Column) -> Column:
        return F.ln((row - k + 1).cast("double") * (col - k + 1)) - F.ln(k.cast("double") * (n - row - col + k))

    def added(log: Column) -> Column:
        return F.when(log <= F.col("_seen"), F.exp(log)).otherwise(F.lit(0.0))

    def step(acc: Column, k: Column) -> Column:
        log = acc["log"] + ratio(k)
        return F.struct(log.alias("log"), (acc["total"] + added(log)).alias("total"))

    steps = F.when(F.col("_hi") > F.col("_lo"), F.sequence(F.col("_lo") + 1, F.col("_hi"))).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(F.col("_first").alias("log"), added(F.col("_first")).alias("total"))
    total = F.aggregate(steps, start, step)["total"]
    return df.withColumn(out, F.least(total, F.lit(1.0))).drop("_n", "_row", "_col", "_lo", "_hi", "_fixed", "_first", "_seen")


#: Halvings by which a score limit is found.
HALVINGS = 60


def _score_limit(a: Column, row: Column, col: Column, n: Column, z: float, lower: bool) -> Column:
    """The odds ratio at which the first cell's score test reaches z: its expected cell, given the margins, by halving.

    The scaled distance of a from an expected cell falls as that grows; at the edge of what the margins allow the limit is
    zero or infinite.
    """
    least, most = F.greatest(F.lit(0.0), row + col - n), F.least(row, col)

    def far(e: Column) -> Column:
        return (a - e) * F.sqrt(1 / e + 1 / (row - e) + 1 / (col - e) + 1 / (n - row - col + e))

    def step(s: Column, _: Column) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        above = far(mid) > (z if lower else -z)
        return F.struct(F.when(above, mid).otherwise(s["lo"]).alias("lo"), F.when(above, s["hi"]).otherwise(mid).alias("hi"))

    start = F.struct((least if lower else a).alias("lo"), (a if lower else most).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, step)
    e = (found["lo"] + found["hi"]) / 2
    edge = (a <= least) if lower else (a >= most)
    return F.when(edge, F.lit(0.0 if lower else float("inf"))).otherwise(e * (n - row - col + e) / F.nullif((row - e) * (col - e), F.lit(0.0)))


def odds(a: Column, b: Column, c: Column, d: Column, interval: Interval | None = None) -> tuple[Column, Column, Column]:
    """Odds ratio of [[a, b], [c, d]] and its interval; the continuity correction is added to all cells if one is zero.

    An empty margin has no interval; a zero off the diagonal makes the ratio infinite.  A score interval that is not found
    is the one on the log scale.
    """
    interval = interval or Interval()
    z = interval.z()
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    empty = (a + b == 0) | (c + d == 0) | (a + c == 0) | (b + d == 0)
    ratio = F.when(b * c > 0, a * d / F.nullif(b * c, F.lit(0.0))).when(a * d > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    add = F.when((a == 0) | (b == 0) | (c == 0) | (d == 0), interval.continuity).otherwise(0.0)
    a, b, c, d = a + add, b + add, c + add, d + add
    log, se = F.ln(a * d / F.nullif(b * c, F.lit(0.0))), F.sqrt(1 / F.nullif(a, F.lit(0.0)) + 1 / F.nullif(b, F.lit(0.0)) + 1 / F.nullif(c, F.lit(0.0)) + 1 / F.nullif(d, F.lit(0.0)))
    low, high = F.exp(log - z * se), F.exp(log + z * se)
    if interval.method == "score":
        limits = [_score_limit(a, a + b, a + c, a + b + c + d, z, lower) for lower in (True, False)]
        low, high = (F.coalesce(F.nanvl(s, F.lit(None).cast("double")), n) for s, n in zip(limits, (low, high), strict=True))
    return ratio, F.when(~empty, low), F.when(~empty, high)


def fourfold(calls: DataFrame, who: DataFrame, mode: str) -> DataFrame:
    """gene_counts with the fourfold table a, b, c, d of carriers (samples) or alleles of cases and controls, and cohort
    sizes n_case, n_control; genes with more alleles than there can be are left out."""
    if mode not in ("samples", "alleles"):
        raise ValueError("mode is samples or alleles")
    n_case, n_control = cohort_sizes(who)
    name, times = ("carriers", 1) if mode == "samples" else ("alleles", 2)
    rows = gene_counts(calls, who).withColumns({"a": F.col(f"case_{name}"), "b": F.col(f"control_{name}"), "n_case": F.lit(n_case), "n_control": F.lit(n_control)})
    return rows.withColumns({"c": F.lit(n_case * times) - F.col("a"), "d": F.lit(n_control * times) - F.col("b")}).where("c >= 0 AND d >= 0")


def gene_burden(calls: DataFrame, who: DataFrame, mode: str, correction: str = "fdr", interval: Interval | None = None) -> DataFrame:
    """The burden table: mode "samples" tests carriers, "alleles" allele counts."""
    rows, name = fourfold(calls, who, mode), "carriers" if mode == "samples" else "alleles"
    rows = fisher(rows, "a", "b", "c", "d", "raw_p_value")
    rows = (benjamini_hochberg if correction == "fdr" else bonferroni)(rows, "raw_p_value", "corrected_p_value", small=True)
    ratio, low, high = odds(F.col("a"), F.col("b"), F.col("c"), F.col("d"), interval)
    return rows.select(
        F.col("gene").alias("GENE"), F.col("n_case").cast("bigint").alias("proband_count"), F.col("n_control").cast("bigint").alias("control_count"),
        F.col("a").cast("bigint").alias(f"proband_{name}"), F.col("b").cast("bigint").alias(f"control_{name}"), "raw_p_value", "corrected_p_value",
        ratio.alias("odds_ratio"), low.alias("or_ci_lower"), high.alias("or_ci_upper"), F.col("n_variants").cast("bigint").alias("n_qualifying_variants"),
    )


def legacy_gene_counts(counts: DataFrame, n_case: int, n_control: int) -> DataFrame:
    """Sums of per-variant counts by gene, at most all samples and all alleles."""
    cap = {"proband_variant_count": n_case, "control_variant_count": n_control, "proband_allele_count": 2 * n_case, "control_allele_count": 2 * n_control}
    return counts.groupBy("gene").agg(*(F.least(F.sum(k), F.lit(v)).cast("bigint").alias(k) for k, v in cap.items()), F.count("*").alias("n_variants"))


def checked(n_case: int, n_control: int, least: int = 10, few: int = 200, most_ratio: float = 20.0) -> list[str]:
    """Raises below the least number of cases; warnings for small or lopsided cohorts."""
    if n_case < least:
        raise TooFewCases(f"only {n_case} cases; {least} are needed")
    out = ["NO_PRACTICAL_POWER"] if n_case < 50 else []
    out += ["LOW_CASE_COUNT"] if n_case < few else []
    return out + (["IMBALANCED_COHORT"] if n_control > most_ratio * n_case else [])


def inflation(chi: list[float]) -> float | None:
    """Median chi-squared over its expectation; None below two values."""
    chi = sorted(x for x in chi if not math.isnan(x))
    if len(chi) < 2:
        return None
    mid = len(chi) // 2
    return (chi[mid] if len(chi) % 2 else (chi[mid - 1] + chi[mid]) / 2) / 0.4549364231195724


def by_shortened_ids(samples: DataFrame, phenotypes: DataFrame, removed: str) -> DataFrame:
    """sample_id, terms: phenotypes under the sample's id, else under the id without the text that file names carry."""
    own = samples.select("sample_id").join(phenotypes, "sample_id", "left")
    short = F.replace("sample_id", F.lit(removed), F.lit(""))
    other = phenotypes.select(F.col("sample_id").alias("_short"), F.col("terms").alias("_terms"))
    return own.join(other, short == F.col("_short"), "left").select("sample_id", F.coalesce("terms", "_terms").alias("terms"))


def few_carriers(genes: DataFrame, least: int = 10) -> DataFrame:
    """gene_counts() with warnings where few cases carry anything."""
    return genes.withColumn("warnings", F.when(F.col("case_carriers") < least, "LOW_CASE_CARRIERS").otherwise(""))
