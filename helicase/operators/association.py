"""Rare-variant association: what genes are tested on, the tests by name, the engine that joins their results.

Regressions and the sums of kernel tests are aggregates over carriers (genetests); a gene reaches one task only as its
scores and products, variants squared, never as samples times variants.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helicase.functions import dist, kernels, weights
from helicase.functions.text import PTV_EFFECTS
from helicase.operators import genetests
from helicase.operators.burden import Interval, checked, fisher, fourfold, gene_counts, odds
from helicase.operators.correction import benjamini_hochberg, bonferroni, cauchy, qq, weighted
from helicase.operators.genetests import RESULT, Cohort, GeneSums
from helicase.sources.store import materialised, put_text


def site_filter(calls: DataFrame, n_samples: int, most_missing: float = 0.10) -> DataFrame:
    """Calls of variants that few samples miss (null dosage)."""
    bad = calls.groupBy("variant_id").agg(F.count_if(F.col("dosage").isNull()).alias("m")).where(F.col("m") / n_samples > most_missing)
    return calls.join(bad, "variant_id", "left_anti")


def masked_samples(calls: DataFrame, most_missing: float = 0.80) -> DataFrame:
    """gene, sample_id of samples that miss most of a gene's variants."""
    n = calls.groupBy("gene").agg(F.count_distinct("variant_id").alias("n"))
    missed = calls.where("dosage IS NULL").groupBy("gene", "sample_id").agg(F.count_distinct("variant_id").alias("m"))
    return missed.join(n, "gene").where(F.col("m") / F.col("n") > most_missing).select("gene", "sample_id")


def frequencies(calls: DataFrame, n_samples: int) -> DataFrame:
    """variant_id, gene, maf: half the mean observed dosage over all samples; absent calls are 0."""
    sums = calls.groupBy("variant_id", "gene").agg(F.coalesce(F.sum("dosage"), F.lit(0)).alias("s"), F.count_if(F.col("dosage").isNull()).alias("m"))
    return sums.select("variant_id", "gene", (F.col("s") / (2 * F.nullif(F.lit(n_samples) - F.col("m"), F.lit(0)))).alias("maf"))


def imputed(calls: DataFrame, n_samples: int, binary: bool = True) -> DataFrame:
    """calls with maf, and missing dosages replaced by twice the frequency (rounded for binary traits)."""
    rows = calls.join(frequencies(calls, n_samples).drop("gene"), "variant_id")
    value = 2 * F.col("maf")
    return rows.withColumn("dosage", F.coalesce(F.col("dosage").cast("double"), F.round(value) if binary else value))


def enough_alleles(calls: DataFrame, least: int = 5) -> DataFrame:
    """gene, mac of genes with that many alternate alleles."""
    return calls.groupBy("gene").agg(F.coalesce(F.sum("dosage"), F.lit(0)).cast("bigint").alias("mac")).where(F.col("mac") >= least)


def coast_category(effect, impact, sift=None, polyphen=None):
    """3 truncating, 2 damaging missense, 1 benign missense, 0 other; without both predictions all are 0."""
    if sift is None and polyphen is None:
        return F.lit(0)
    hit = lambda c, names: F.coalesce(F.arrays_overlap(F.split(F.lower(c), "[,;&|]"), F.array(*map(F.lit, names))), F.lit(False)) if c is not None else F.lit(False)
    bad = hit(sift, ("d", "deleterious", "damaging")) | hit(polyphen, ("d", "p", "probably_damaging", "possibly_damaging"))
    good = hit(sift, ("t", "tolerated")) & hit(polyphen, ("b", "benign"))
    missense = F.array_contains(F.split(effect, "&"), "missense_variant")
    truncating = (impact == "HIGH") & F.arrays_overlap(F.split(effect, "&"), F.array(*map(F.lit, PTV_EFFECTS)))
    return F.when(truncating, 3).when(missense & bad, 2).when(missense & good, 1).otherwise(0)


#: Kernel tests by name; each takes a gene's sums and gives p_value and, optionally, effect, se, ci_lower, ci_upper,
#: warnings and status.
TESTS: dict[str, Callable[[GeneSums], dict]] = {
    "skat": lambda s: {"p_value": kernels.skat(s.scored.weighted(s.weights))[0], "warnings": ""},
    "skato": lambda s: {"p_value": kernels.skat_o(s.scored.weighted(s.weights))[0], "warnings": ""},
    "burden": lambda s: {"p_value": collapsed_score(s), "warnings": ""},
    "acat_v": lambda s: {"p_value": kernels.per_variant(s.scored, s.weights, s.alleles / (2 * s.n)), "warnings": ""},
}
#: Tests that are regressions on a gene's predictors, and the allelic series.
REGRESSIONS = ("logistic_burden", "linear_burden")
#: Other names of tests.
ALIASES = {"skat_python": "skat", "skat_o": "skato"}
#: What the test skat computes, by the setting of that name.
SKAT_METHODS = {"SKAT": "skat", "Burden": "burden", "SKATO": "skato"}


def collapsed_score(s: GeneSums) -> float:
    """The score test of the weighted sum of variants with the variance that kernel programs give it alone: covariates are
    not taken out of the sum, and a binary trait counts with variance one, so the test is conservative."""
    var = s.plain_sum(s.weights) * (1.0 if s.binary else 1 / s.variance)
    return dist.chi2_sf(float(s.weights @ s.scored.score) ** 2 / var, 1) if var > 0 else math.nan


def _series_kernel(by: tuple[float, ...]) -> Callable[[GeneSums], dict]:
    """The mixture test of the allelic series, and which categories a gene has."""

    def run(s: GeneSums) -> dict:
        s = s.variants(np.isin(s.categories, (1, 2, 3)) & (s.alleles > 0))
        absent = [name for k, name in ((1, "BMV"), (2, "DMV"), (3, "PTV")) if not (s.categories == k).any()]
        if len(absent) == 3:
            return {"p_value": None, "status": "skipped", "warnings": "ALL_CATEGORIES_EMPTY"}
        aaf = np.clip(s.alleles / (2 * s.n), 1e-8, 1 - 1e-8)
        w = np.sqrt(np.array(by)[s.categories - 1] / (aaf * (1 - aaf)))
        told = {"status": "partial", "warnings": f"MISSING_{'_'.join(absent)}"} if absent else {"status": "complete", "warnings": ""}
        return {"p_value": kernels.skat_o(s.scored.weighted(w))[0], **told}

    return run


def _series_predictors(by: tuple[float, ...]) -> dict[str, list[Column]]:
    """Six burden models over counts and indicators of the categories: joint, weighted sum, weighted maximum."""
    counts = [F.col(f"count{k}") for k in (1, 2, 3)]
    out = {}
    for name, n in (("count", counts), ("ind", [(c > 0).cast("double") for c in counts])):
        scaled = [c * w for c, w in zip(n, by, strict=True)]
        out |= {f"coast:base_{name}": n, f"coast:sum_{name}": [scaled[0] + scaled[1] + scaled[2]], f"coast:max_{name}": [F.greatest(*scaled)]}
    return out


def register(name: str, test: Callable[[GeneSums], dict]) -> None:
    """Adds a test of one's own over a gene's sums.  A name that is taken by another test raises."""
    if name in ("fisher", "coast", *REGRESSIONS, *ALIASES) or TESTS.get(name, test) is not test:
        raise ValueError(f"there is a test {name}")
    TESTS[name] = test


def test_names(tests: list[str]) -> list[str]:
    """Known names, once each; unknown ones raise."""
    known = {*TESTS, *REGRESSIONS, "fisher", "coast"}
    found = list(dict.fromkeys(ALIASES.get(t, t) for t in tests))
    if unknown := [t for t in found if t not in known]:
        raise ValueError(f"no test {', '.join(unknown)}; known: {', '.join(sorted({*known, *ALIASES}))}")
    return found


def backend(name: str = "auto") -> str:
    """What computes kernel tests: this engine for python and auto; others raise."""
    if name not in ("python", "auto"):
        raise ValueError(f"no backend {name}: python and auto are known")
    return "python"


def test_genes(calls: DataFrame, cohort: Cohort, tests: list[str], series: tuple[float, ...] = (1.0, 2.0, 3.0), skat_method: str = "SKAT", firth_steps: int = 100) -> DataFrame:
    """RESULT rows of calls (gene, variant_id, sample_id, dosage, weight, category and, optionally, masked).

    Samples that are masked in a gene are left out of it; its null model is then fitted without them.  fisher is not one
    of these tests.
    """
    rows = calls if "masked" in calls.columns else calls.withColumn("masked", F.lit(False))
    carried = materialised(genetests.carriers(rows), "carriers")
    predictors = {t: [genetests.burden_of(F.col("has"))] for t in tests if t in REGRESSIONS}
    if "coast" in tests:
        predictors |= _series_predictors(series)
    extra = [f"b{i}" for i in range(max(map(len, predictors.values()), default=0))]
    changed = materialised(genetests.changes(carried, cohort, predictors), "changes")
    keys = changed.select(*genetests.KEY).distinct()
    parts, by_model = [], None
    own = {SKAT_METHODS[skat_method] if t == "skat" else t: t for t in tests if t in TESTS}
    kernel = {shown: TESTS[t] for t, shown in own.items()} | ({"coast:mixture": _series_kernel(series)} if "coast" in tests else {})
    if "linear_burden" in tests or not cohort.binary:
        linear = genetests.linear_fits(changed, cohort, extra)
        parts += [genetests.linear_tests(linear[0], cohort, ["linear_burden"])] if "linear_burden" in tests else []
    if cohort.binary:
        plain = keys
        if "logistic_burden" in tests:
            told = genetests.carrier_notes(changed, cohort, ["logistic_burden"])
            plain = plain.join(told.where("one_side").select(*genetests.KEY), list(genetests.KEY), "left_anti")
        plain = plain.unionByName(calls.sparkSession.createDataFrame([("", "cohort")], "gene string, test string"))
        fits = materialised(genetests.fitted(plain, changed, cohort, extra).hint("rebalance"), "fitted")  # a row a fit: few files
        parts += [genetests.logistic_tests(told, changed, cohort, extra, fits, firth_steps)] if "logistic_burden" in tests else []
        by_model = genetests.likelihood_tests(fits, cohort, changed) if "coast" in tests else None
        nulls = genetests.null_models(cohort, changed, fits=fits) if kernel else None
    else:
        by_model = genetests.f_tests(linear[0], cohort) if "coast" in tests else None
        nulls = genetests.null_models(cohort, changed, linear=linear) if kernel else None
    if kernel:
        sums = materialised(genetests.kernel_sums(carried, cohort, nulls), "sums")
        found = materialised(genetests.kernel_results(sums, cohort, nulls, kernel).hint("rebalance"), "kernels")
        parts.append(found.where("test <> 'coast:mixture'"))
        if "coast" in tests:
            parts.append(_series(found.where("test = 'coast:mixture'"), by_model))
    return _all(parts)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _series(mixture: DataFrame, models: DataFrame) -> DataFrame:
    """The allelic series: the Cauchy combination of six burden models and the mixture test, which has their weight."""
    names = [*_series_predictors((1.0, 2.0, 3.0))]
    wide = models.groupBy("gene").pivot("test", names).agg(F.first("p_value"))
    rows = mixture.join(wide, "gene", "left")
    ps = [F.nanvl(F.col(c), F.lit(None).cast("double")) for c in (*(f"`{n}`" for n in names), "p_value")]
    rows = rows.withColumn("p_value", F.when(F.col("status") != "skipped", cauchy(ps, [1.0] * 6 + [6.0])))
    return rows.withColumn("test", F.lit("coast")).select(*(c.split()[0] for c in RESULT.split(", ")))


def fisher_results(calls: DataFrame, who: DataFrame, mode: str = "samples", interval: Interval | None = None) -> DataFrame:
    """The exact test of carriers, or of alleles, with the odds ratio and its interval."""
    rows = fourfold(calls, who, mode)
    ratio, low, high = odds(F.col("a"), F.col("b"), F.col("c"), F.col("d"), interval)
    rows = fisher(rows, "a", "b", "c", "d", "p_value")
    return rows.select("gene", F.lit("fisher").alias("test"), "p_value", ratio.alias("effect"), F.lit(None).cast("double").alias("se"), low.alias("ci_lower"), high.alias("ci_upper"), F.lit("").alias("warnings"), F.lit(None).cast("string").alias("status"))


def observed(calls: DataFrame, n_samples: int, most_missing_site: float = 0.10, most_missing_sample: float = 0.80) -> DataFrame:
    """calls of variants that few samples miss, with masked: whether the sample misses most of the gene's kept variants."""
    kept = site_filter(calls, n_samples, most_missing_site)
    mask = masked_samples(kept, most_missing_sample).withColumn("masked", F.lit(True))
    return kept.join(mask, ["gene", "sample_id"], "left").withColumn("masked", F.coalesce("masked", F.lit(False)))


@dataclass
class Plan:
    """How run_all tests genes: what the settings of a run say."""

    weights: str = "beta:1,25"
    weight_params: dict = field(default_factory=dict)
    correction: str = "fdr"
    binary: bool = True
    least_alleles: int = 5
    least_cases: int = 10
    few_cases: int = 200
    most_ratio: float = 20.0
    least_carriers: int = 10
    most_missing_site: float = 0.10
    most_missing_sample: float = 0.80
    burden_mode: str = "samples"
    interval: Interval = field(default_factory=Interval)
    series: tuple[float, ...] = (1.0, 2.0, 3.0)
    skat_method: str = "SKAT"
    firth_steps: int = 100


#: Columns of calls that a run reads; they are made once.
CALLS = ("gene", "variant_id", "sample_id", "dosage", "cadd", "revel", "category")


def run_all(
    calls: DataFrame, who: DataFrame, tests: list[str], covariates: DataFrame | None = None, components: DataFrame | None = None, gene_weights: DataFrame | None = None, plan: Plan | None = None,
) -> DataFrame:
    """One row per gene: n_cases, n_controls, n_variants, <test>_pvalue and <test>_effect, the combined acat_o_pvalue, its
    q-value (only that is corrected) and warnings.

    calls: gene, variant_id, sample_id, dosage and, where weights or COAST need them, cadd, revel and category; who:
    sample_id and is_case or, for a quantitative trait, value.  Too few cases raise TooFewCases.  With skat or skato the
    combination holds acat_v too.  fisher counts all calls, as the burden table does; the other tests leave out sites and
    samples that miss too many.  A quantitative trait has neither fisher nor logistic_burden, and no cases to count.
    """
    plan = plan or Plan()
    tests = test_names(tests)
    if not plan.binary and (odd := {"fisher", "logistic_burden"} & {*tests}):
        raise ValueError(f"no {', '.join(sorted(odd))} for a quantitative trait")
    if plan.binary and "linear_burden" in tests:
        raise ValueError("no linear_burden for a binary trait")
    if "skat" in tests and SKAT_METHODS[plan.skat_method] in tests and plan.skat_method != "SKAT":
        raise ValueError(f"skat by the method {plan.skat_method} is one of the tests already")
    trait = who.select("sample_id", (F.col("is_case").cast("double") if plan.binary else F.col("value").cast("double")).alias("y")).where("y IS NOT NULL")
    cohort = Cohort.of(trait, [(n, t) for n, t in (("covariates", covariates), ("components", components)) if t is not None], plan.binary)
    n_case, n_control = (cohort.n_case, cohort.n - cohort.n_case) if plan.binary else (None, None)
    cohort_notes = checked(n_case, n_control, plan.least_cases, plan.few_cases, plan.most_ratio) if plan.binary else []
    calls = materialised(calls.select(*(c for c in CALLS if c in calls.columns)), "calls")  # counts and the exact test read them too
    kept = materialised(observed(calls, cohort.n, plan.most_missing_site, plan.most_missing_sample), "observed")
    rows = imputed(kept, cohort.n, plan.binary)
    scores = [F.col(c) if c in calls.columns else None for c in ("cadd", "revel")]
    rows = rows.withColumn("weight", weights.by_spec(plan.weights, F.col("maf"), *scores, **plan.weight_params))
    if "category" not in rows.columns:
        rows = rows.withColumn("category", F.lit(0))
    rows = rows.join(enough_alleles(kept, plan.least_alleles), "gene", "left_semi")
    others = [t for t in tests if t != "fisher"]
    if "acat_v" not in others and {"skat", "skato"} & set(others):
        others.append("acat_v")
    ordered = [t for t in tests if t == "fisher"] + others
    parts = [test_genes(rows, cohort, others, plan.series, plan.skat_method, plan.firth_steps)] if others else []
    parts += [fisher_results(calls, who, plan.burden_mode, plan.interval)] if "fisher" in tests else []
    found = [F.first("p_value").alias("pvalue"), F.first("effect").alias("effect"), F.first("status").alias("status"), F.first("warnings").alias("warnings")]
    wide = _all(parts).groupBy("gene").pivot("test", ordered).agg(*found)
    if plan.binary:
        carriers = gene_counts(calls, who).select("gene", "n_variants", "case_carriers")
    else:
        carriers = calls.where("dosage > 0").groupBy("gene").agg(F.count_distinct("variant_id").alias("n_variants"))
    shown = {t: "skat_o" if t == "skato" or (t == "skat" and plan.skat_method == "SKATO") else t for t in ordered}
    wide = wide.join(carriers, "gene", "left").withColumnsRenamed({f"{t}_{k}": f"{n}_{k}" for t, n in shown.items() if t != n for k in ("pvalue", "effect", "status", "warnings")})
    names = [shown[t] for t in ordered]
    ps = [F.nanvl(F.col(f"{t}_pvalue"), F.lit(None).cast("double")) for t in names]
    wide = wide.withColumn("acat_o_pvalue", cauchy(ps))
    few = F.when(F.coalesce("case_carriers", F.lit(0)) < plan.least_carriers, F.lit("LOW_CASE_CARRIERS")) if plan.binary else F.lit(None).cast("string")
    own = [F.when(F.col(f"{t}_warnings") != "", F.col(f"{t}_warnings")) for t in names]
    wide = wide.withColumn("warnings", F.array_join(F.array_compact(F.array(few, *own, *map(F.lit, cohort_notes))), ";"))
    if gene_weights is not None:
        wide = weighted(wide, gene_weights, plan.correction, "acat_o_pvalue", "acat_o_qvalue", small=True)
    else:
        wide = (benjamini_hochberg if plan.correction == "fdr" else bonferroni)(wide, "acat_o_pvalue", "acat_o_qvalue", small=True)
    extra = ["coast_status"] if "coast" in names else []
    extra += ["fdr_weight"] if gene_weights is not None else []
    counts = [F.lit(n_case).cast("bigint").alias("n_cases"), F.lit(n_control).cast("bigint").alias("n_controls")] if plan.binary else [F.lit(cohort.n).cast("bigint").alias("n_samples")]
    return wide.select("gene", *counts, "n_variants", *(f"{t}_{k}" for t in names for k in ("pvalue", "effect")), "acat_o_pvalue", "acat_o_qvalue", *extra, "warnings")


def lambda_gc(results: DataFrame, p: str = "p_value") -> DataFrame:
    """test, lambda_gc: the median chi-squared of the p-values over its expectation; null below two values.

    The chi-squared of a p is monotone, so the middle p-values (one or two a test) are enough.
    """
    rows = results.where(F.col(p).isNotNull() & ~F.isnan(p))
    order = Window.partitionBy("test").orderBy(p)
    rows = rows.withColumns({"_i": F.row_number().over(order), "_n": F.count("*").over(Window.partitionBy("test"))})
    mid = rows.where("_n >= 2 AND _i IN (floor((_n + 1) / 2), floor(_n / 2) + 1)")
    spark = results.sparkSession
    by: dict[str, list[float]] = {}
    for r in mid.select("test", p).collect():
        by.setdefault(r[0], []).append(dist.chi2_isf(r[1], 1) / 0.4549364231195724)
    return spark.createDataFrame([(t, sum(v) / len(v)) for t, v in sorted(by.items())], "test string, lambda_gc double")


def diagnostics_summary(results: DataFrame, n_case: int, n_control: int, notes: list[str], p: str = "p_value") -> list[str]:
    """Lines that tell cohort sizes, tests, their inflation (flagged below 100 tests), cohort warnings and flagged genes."""
    n = {r[0]: r[1] for r in results.where(F.col(p).isNotNull() & ~F.isnan(p)).groupBy("test").count().collect()}
    gc = {r.test: r.lambda_gc for r in lambda_gc(results, p).collect()}
    out = ["Association diagnostics", "", f"cases: {n_case}", f"controls: {n_control}", "", "Tests:", *(f"  {t}" for t in sorted(n)), "", "Inflation (lambda GC):"]
    out += [f"  {t}: {gc[t]:.4f} (n={n[t]}){' unreliable: fewer than 100 tests' if n[t] < 100 else ''}" for t in sorted(gc)] or ["  no valid p-values"]
    out += ["", "Cohort warnings:", *(f"  {w}" for w in notes)] if notes else []
    if "warnings" in results.columns:
        flagged = results.where("warnings <> ''").select("gene").distinct().count()
        out += ["", f"Genes with warnings: {flagged}"]
    return out


#: Colours of a plot's tests, in turn.
COLOURS = ("#1b6ca8", "#c0392b", "#2e8b57", "#8e44ad", "#d68910", "#555555")


def qq_plot(rows: DataFrame, size: int = 480) -> str:
    """A quantile plot as an SVG document from rows of test, expected_log10, observed_log10.

    Points that fall together at two decimals are one, so the drawing is bounded whatever the number of tests.
    """
    spots = rows.select("test", F.round("expected_log10", 2).alias("x"), F.round("observed_log10", 2).alias("y")).distinct().orderBy("test", "x", "y").collect()
    tests = sorted({r.test for r in spots})
    most_x, most_y = (max([1.0, *(r[k] for r in spots)]) for k in ("x", "y"))
    left = lambda x: 50 + (size - 70) * x / most_x
    up = lambda y: size - 50 - (size - 70) * y / most_y
    end = min(most_x, most_y)
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{size}" height="{size}" font-family="sans-serif" font-size="12"><rect width="100%" height="100%" fill="white"/>']
    out.append(f'<path d="M50 {up(0):.1f}H{size - 20}M50 {up(0):.1f}V20" stroke="black" fill="none"/><path d="M{left(0):.1f} {up(0):.1f}L{left(end):.1f} {up(end):.1f}" stroke="gray" stroke-dasharray="4"/>')
    out += [f'<circle cx="{left(r.x):.1f}" cy="{up(r.y):.1f}" r="2" fill="{COLOURS[tests.index(r.test) % len(COLOURS)]}"/>' for r in spots]
    out += [f'<text x="{left(t):.1f}" y="{size - 34}">{t}</text>' for t in range(int(most_x) + 1)] + [f'<text x="30" y="{up(t):.1f}">{t}</text>' for t in range(int(most_y) + 1)]
    out += [f'<text x="60" y="{30 + 16 * i}" fill="{COLOURS[i % len(COLOURS)]}">{t}</text>' for i, t in enumerate(tests)]
    out.append(f'<text x="{size // 2}" y="{size - 12}">expected -log10 p</text><text x="14" y="{size // 2}" transform="rotate(-90 14 {size // 2})">observed -log10 p</text></svg>')
    return "".join(out)


def write_diagnostics(results: DataFrame, folder: str, p: str = "p_value", cohort: tuple[int, int] | None = None, notes: list[str] = ()) -> None:
    """lambda_gc and qq tables of long results (test, p) as TSV folders, a plot, and, with the cohort's sizes, a summary."""
    lambda_gc(results, p).write.mode("overwrite").csv(f"{folder}/lambda_gc", sep="\t", header=True)
    rows = qq(results.where(~F.isnan(p)), p, ["test"])
    rows.select("test", "expected_log10", "observed_log10").write.mode("overwrite").csv(f"{folder}/qq_data", sep="\t", header=True)
    put_text(results.sparkSession, f"{folder}/qq_plot.svg", qq_plot(rows))
    if cohort is not None:
        lines = diagnostics_summary(results, *cohort, list(notes), p)
        results.sparkSession.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/summary")


def weight_gains(df: DataFrame, level: float = 0.05) -> DataFrame:
    """gene with gained or lost where weights changed significance; df: gene, q_plain, q_weighted."""
    change = F.when((F.col("q_plain") >= level) & (F.col("q_weighted") < level), "gained").when((F.col("q_plain") < level) & (F.col("q_weighted") >= level), "lost")
    return df.withColumn("change", change).where("change IS NOT NULL")


#: Directions beside those asked for that components are sought with, and steps at most.
SPARE, MOST_STEPS = 10, 60
#: How near a step must come to multiples of the leading directions, as a share of the largest.
SETTLED = 1e-7


def principal_components(calls: DataFrame, samples: DataFrame, k: int, steps: int = MOST_STEPS) -> DataFrame:
    """sample_id, pc1..pck of the dosages, centred by variant: the leading components times their singular values.

    By block power iteration: some more directions than components are a table of numbers by sample; calls joined with it
    give numbers by variant, calls joined with these the next directions, which are made orthogonal by their products with
    each other.  Nothing grows with samples squared; the driver holds products of directions.  A component's sign is such
    that its largest entry is positive.
    """
    rows = calls.where("dosage > 0").join(samples.select("sample_id").distinct(), "sample_id", "left_semi").groupBy("variant_id", "sample_id").agg(F.sum("dosage").cast("double").alias("v"))
    rows = materialised(rows, "dosages")
    people = materialised(samples.select("sample_id").distinct(), "people")
    n = people.count()
    wide = max(1, min(n, k + SPARE))
    means = materialised(rows.groupBy("variant_id").agg((F.sum("v") / n).alias("mean")), "means")
    k = min(k, n, max(1, calls.select("variant_id").distinct().count()))
    # seeded directions: each sample's numbers follow from its name
    number = lambda j: F.xxhash64("sample_id", F.lit(j)) / F.lit(float(1 << 63))
    q = _orthogonal(people.select("sample_id", F.array(*(number(j) for j in range(wide))).alias("q")), wide)
    for _ in range(steps):
        y = materialised(_through(rows, means, q, wide), "step")
        both = q.join(y, "sample_id")
        h, yy = _products(both, "q", "y", wide), _products(y.withColumn("q", F.col("y")), "q", "y", wide)
        # how far the step leads the leading directions off multiples of themselves
        values, vectors = np.linalg.eigh(h)
        lead = np.argsort(-values, kind="stable")[: min(k, wide)]
        off = np.einsum("ic,ij,jc->c", vectors[:, lead], yy, vectors[:, lead]) - values[lead] ** 2
        if float(np.sqrt(np.maximum(off, 0)).max(initial=0.0)) <= SETTLED * max(float(values.max()), 1e-300):
            break
        q = _orthogonal(y.select("sample_id", F.col("y").alias("q")), wide)
    best = np.argsort(-values, kind="stable")[:k]
    turn = vectors[:, best] * np.sqrt(np.maximum(values[best], 0.0))
    at = lambda c, m: F.lit([float(x) for x in m[:, c]])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)
    found = materialised(q.select("sample_id", *(dot(F.col("q"), at(c, turn)).alias(f"pc{c + 1}") for c in range(k))), "components")
    names = [f"pc{c + 1}" for c in range(k)]
    ends = found.agg(*(f(F.col(c)).alias(f"{c}_{f.__name__}") for c in names for f in (F.min, F.max))).first() or {}
    signs = [F.col(c) * (-1.0 if -(ends[f"{c}_min"] or 0.0) > (ends[f"{c}_max"] or 0.0) else 1.0) for c in names]
    return samples.select("sample_id").join(found.select("sample_id", *(s.alias(c) for s, c in zip(signs, names, strict=True))), "sample_id")


def _sums_of(parts: list[Column]) -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0.0)).alias(f"s{i}") for i, c in enumerate(parts)]


def _products(rows: DataFrame, left: str, right: str, wide: int) -> np.ndarray:
    """The products of two columns of arrays, summed over the rows; they are symmetric here, so one half is enough."""
    pairs = [(i, j) for i in range(wide) for j in range(i, wide)]
    row = rows.agg(*_sums_of([F.get(left, F.lit(i)) * F.get(right, F.lit(j)) for i, j in pairs])).first()
    out = np.zeros((wide, wide))
    for (i, j), x in zip(pairs, row, strict=True):
        out[i, j] = out[j, i] = x
    return out


def _orthogonal(rows: DataFrame, wide: int) -> DataFrame:
    """The same span by orthonormal directions; those without length are zero."""
    rows = materialised(rows, "directions")
    for _ in range(2):  # once more for what rounding leaves
        values, vectors = np.linalg.eigh(_products(rows, "q", "q", wide))
        scale = np.where(values > 1e-20 * max(values.max(), 1e-300), 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
        turn = vectors * scale
        dot = lambda c, turn=turn: F.aggregate(F.zip_with(F.col("q"), F.lit([float(x) for x in turn[:, c]]), lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)
        rows = materialised(rows.select("sample_id", F.array(*(dot(c) for c in range(wide))).alias("q")), "directions")
    return rows


def _through(rows: DataFrame, means: DataFrame, q: DataFrame, wide: int) -> DataFrame:
    """sample_id, y: the centred dosages times their transpose times the directions."""
    total = [float(x) for x in q.agg(*_sums_of([F.get("q", F.lit(j)) for j in range(wide)])).first()]
    by_variant = rows.join(q, "sample_id").groupBy("variant_id").agg(*_sums_of([F.col("v") * F.get("q", F.lit(j)) for j in range(wide)]))
    b = by_variant.join(means, "variant_id").select("variant_id", "mean", F.array(*(F.col(f"s{j}") - F.col("mean") * total[j] for j in range(wide))).alias("b"))
    b = materialised(b, "by-variant")
    shift = [float(x) for x in b.agg(*_sums_of([F.col("mean") * F.get("b", F.lit(j)) for j in range(wide)])).first()]
    by_sample = rows.join(b, "variant_id").groupBy("sample_id").agg(*_sums_of([F.col("v") * F.get("b", F.lit(j)) for j in range(wide)]))
    every = q.select("sample_id").join(by_sample, "sample_id", "left")
    return every.select("sample_id", F.array(*(F.coalesce(F.col(f"s{j}"), F.lit(0.0)) - shift[j] for j in range(wide))).alias("y"))
