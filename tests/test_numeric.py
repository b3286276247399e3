import math

import dense
import numpy as np
import pytest
from pyspark.sql import functions as F

from helicase.functions import dist, kernels, quadform
from helicase.operators import association, genetests


def test_distribution_identities():
    for x in (0.1, 1.0, 5.0, 30.0):
        assert dist.chi2_sf(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-10)
        assert dist.chi2_sf(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9)
        assert dist.f_sf(x, 2, 10) == pytest.approx((1 + x / 5) ** -5, rel=1e-10)
        assert dist.t_two_sided(x, 1) == pytest.approx(1 - 2 * math.atan(x) / math.pi, rel=1e-9)
        assert dist.ncx2_sf(x, 3, 0) == dist.chi2_sf(x, 3)
    for p in (1e-12, 1e-3, 0.3, 0.7, 0.999):
        assert dist.norm_sf(-dist.norm_ppf(p)) == pytest.approx(p, rel=1e-9)
        assert dist.chi2_sf(dist.chi2_isf(p, 3), 3) == pytest.approx(p, rel=1e-9)


def test_noncentral_mean_over_poisson():
    assert dist.ncx2_sf(4.0, 1, 1.0) == pytest.approx(dist.norm_sf(1.0) + dist.norm_sf(3.0), rel=1e-9)


def test_fisher_textbook():
    assert dist.fisher_two_sided(3, 1, 1, 3) == pytest.approx(34 / 70, rel=1e-9)
    assert dist.fisher_two_sided(0, 5, 5, 0) == pytest.approx(2 / 252, rel=1e-9)


def test_quadratic_forms():
    lam = np.ones(4)
    assert quadform.imhof(9.0, lam) == pytest.approx(dist.chi2_sf(9, 4), abs=1e-6)
    assert quadform.liu(9.0, lam) == pytest.approx(dist.chi2_sf(9, 4), rel=1e-9)
    assert quadform.saddle(9.0, lam) == pytest.approx(dist.chi2_sf(9, 4), rel=2e-2)
    many = quadform.p_values(np.array([3.0, 9.0]), np.array([2.0, 1.0, 0.5]))
    assert many[1] == pytest.approx(quadform.p_value(9.0, np.array([2.0, 1.0, 0.5]))[0], abs=1e-6)


def test_regression_recovers_known_fits():
    x = np.column_stack([np.ones(6), np.arange(6.0)])
    beta, se, rss = dense.ols(x, 2 + 3 * np.arange(6.0) + np.array([0.1, -0.1, 0.0, 0.0, 0.1, -0.1]))
    assert beta[1] == pytest.approx(3, abs=0.05)
    group = np.array([0] * 10 + [1] * 10)
    y = np.array([1] * 3 + [0] * 7 + [1] * 6 + [0] * 4, float)
    b, se, done = dense.logistic(np.column_stack([np.ones(20), group]), y)
    assert done
    assert b[1] == pytest.approx(math.log((6 / 4) / (3 / 7)), abs=1e-6)
    assert se[1] == pytest.approx(math.sqrt(1 / 6 + 1 / 4 + 1 / 3 + 1 / 7), abs=1e-6)


def test_firth_is_finite_under_separation():
    x = np.column_stack([np.ones(8), [0, 0, 0, 0, 1, 1, 1, 1]])
    y = np.array([0, 0, 0, 0, 1, 1, 1, 1], float)
    beta, _, done = dense.firth(x, y)
    # adding one half to each cell of a two by two table is what the penalty does there
    assert done
    assert beta[1] == pytest.approx(2 * math.log(9), abs=1e-3)


def test_kernel_tests_agree_where_they_must():
    rng = np.random.default_rng(3)
    y = (rng.random(120) < 0.5).astype(float)
    g = rng.binomial(2, 0.2, (120, 5)).astype(float)
    null = dense.fit_null(y)
    one = kernels.skat_o(dense.scored(null, g[:, :1]))[0]
    assert one == pytest.approx(kernels.summed(dense.scored(null, g[:, :1])))
    p, rho = kernels.skat_o(dense.scored(null, g))
    assert 0 < p <= 1
    assert 0 <= rho <= 1
    assert math.isnan(kernels.skat(dense.scored(null, g[:, :1]))[0])


def test_skat_is_calibrated():
    rng = np.random.default_rng(5)
    ps = []
    for _ in range(150):
        y = (rng.random(150) < 0.5).astype(float)
        ps.append(kernels.skat(dense.scored(dense.fit_null(y), rng.binomial(2, 0.1, (150, 6)).astype(float)))[0])
    assert 0.4 < np.mean(ps) < 0.6
    assert np.mean(np.array(ps) < 0.05) < 0.12


def test_cauchy_rules():
    assert kernels.cauchy([0.3, None, 1.0]) == 0.3
    assert kernels.cauchy([0.02, 0.02]) == pytest.approx(0.02)
    assert kernels.cauchy([None, None]) is None
    assert kernels.cauchy([1e-20, 0.5]) == pytest.approx(2e-20, rel=1e-3)


def gene(seed, n, k):
    """Genotypes and a phenotype as the published values were made from."""
    rng = np.random.default_rng(seed)
    g = rng.choice([0, 1, 2], size=(n, k), p=[0.6, 0.3, 0.1]).astype(float)
    return g, rng.integers(0, 2, n).astype(float)


def long(spark, g, y, category=None, masked=()):
    """Calls and cohort of a dense matrix, one gene."""
    rows = [("g", int(v), f"s{i:04d}", float(g[i, v]), 1.0, int(category[v]) if category is not None else 0, i in masked) for i, v in zip(*np.nonzero(g), strict=True)]
    calls = spark.createDataFrame(rows, "gene string, variant_id bigint, sample_id string, dosage double, weight double, category int, masked boolean")
    return calls, spark.createDataFrame([(f"s{i:04d}", float(v)) for i, v in enumerate(y)], "sample_id string, y double")


def covariate_table(spark, x):
    return spark.createDataFrame([(f"s{i:04d}", *map(float, r)) for i, r in enumerate(x)], "sample_id string, " + ", ".join(f"c{j} double" for j in range(x.shape[1])))


def results(calls, cohort, tests, **more):
    return {r.test: r for r in association.test_genes(calls, cohort, tests, **more).collect()}


def test_published_values(spark):
    g, y = gene(42, 50, 5)
    maf = g.mean(0) / 2
    calls, who = long(spark, g, y)
    weights = spark.createDataFrame([(v, float(25 * (1 - maf[v]) ** 24)) for v in range(5)], "variant_id bigint, weight double")
    found = results(calls.drop("weight").join(weights, "variant_id"), genetests.Cohort.of(who), ["burden", "skat"])
    assert found["burden"].p_value == pytest.approx(0.8166240139405816, rel=1e-4)
    assert found["skat"].p_value == pytest.approx(0.5192992314098306, rel=1e-4)


def test_mixture_of_tests_falls_back():
    """Without numbers from inversion the matching chi-squared decides, and comes near."""
    g, y = gene(7, 120, 6)
    s = dense.scored(dense.fit_null(y), g)
    exact = kernels.skat_o(s)[0]
    saved = quadform.p_values
    quadform.p_values = lambda q, lam: np.full(len(q), np.nan)
    try:
        matched = kernels.skat_o(s)[0]
    finally:
        quadform.p_values = saved
    assert matched == pytest.approx(exact, rel=0.1)
    flat = kernels.SharedDirection.of(np.array([[5.0, -5.0], [-5.0, 5.0]]))
    assert flat.along(0.5) == 0.0


@pytest.mark.parametrize("binary", [True, False])
@pytest.mark.parametrize("local", [20_000, 0])
def test_aggregates_equal_whole_matrices(spark, monkeypatch, binary, local):
    """Scores, products, regressions and the allelic series of a gene with covariates and masked samples, steps taken in one
    task or as aggregates."""
    monkeypatch.setattr(genetests, "MOST_LOCAL", local)
    rng = np.random.default_rng(11)
    n, p, masked = 90, 6, {3, 17}
    g = (rng.random((n, p)) < 0.2) * rng.integers(1, 3, (n, p)).astype(float)
    g[list(masked), 0] = 1.0
    x = np.column_stack([rng.standard_normal(n).round(2), rng.integers(0, 2, n)])
    y = (rng.random(n) < 0.4).astype(float) if binary else rng.standard_normal(n) + x[:, 0]
    category = np.array([1, 1, 2, 2, 3, 3])
    calls, who = long(spark, g, y, category, masked)
    cohort = genetests.Cohort.of(who, [("covariates", covariate_table(spark, x))], binary)
    name = "logistic_burden" if binary else "linear_burden"
    found = results(calls, cohort, [name, "skat", "skato", "acat_v", "burden", "coast"])
    keep = np.array([i not in masked for i in range(n)])
    null, rest = dense.fit_null(y[keep], x[keep], binary), g[keep]
    s = dense.scored(null, rest)
    b = rest.sum(1)
    full = np.column_stack([null.x, b])
    beta, se = (dense.logistic if binary else dense.ols)(full, y[keep])[:2]
    assert found[name].effect == pytest.approx(beta[-1], rel=1e-6)
    assert found[name].se == pytest.approx(se[-1], rel=1e-6)
    assert found["skat"].p_value == pytest.approx(kernels.skat(s)[0], rel=1e-5)
    assert found["skato"].p_value == pytest.approx(kernels.skat_o(s)[0], rel=1e-5)
    assert found["acat_v"].p_value == pytest.approx(kernels.per_variant(s, np.ones(p), rest.sum(0) / (2 * keep.sum())), rel=1e-6)
    assert found["coast"].p_value == pytest.approx(dense.allelic_series(null, rest, category), rel=1e-5)
    assert found["coast"].status == "complete"


@pytest.mark.parametrize("local", [20_000, 0])
def test_penalised_steps_equal_the_whole_fit(spark, monkeypatch, local):
    """Separated carriers with a covariate: estimate and error of the penalised fit."""
    monkeypatch.setattr(genetests, "MOST_LOCAL", local)
    rng = np.random.default_rng(3)
    n = 60
    x, y = rng.standard_normal((n, 1)).round(2), (rng.random(n) < 0.5).astype(float)
    g = np.zeros((n, 2))
    g[np.flatnonzero(y == 1)[:4], 0] = 1.0
    g[np.flatnonzero(y == 1)[3:7], 1] = 2.0
    calls, who = long(spark, g, y)
    found = results(calls, genetests.Cohort.of(who, [("covariates", covariate_table(spark, x))]), ["logistic_burden"])["logistic_burden"]
    beta, se, done = dense.firth(np.column_stack([np.ones(n), x, g.sum(1)]), y)
    assert done
    assert found.warnings == "ZERO_CARRIERS_ONE_GROUP;QUASI_SEPARATION;FIRTH"
    assert found.effect == pytest.approx(beta[-1], abs=1e-4)
    assert found.se == pytest.approx(se[-1], abs=1e-4)


def test_kernel_sums_of_a_gene_are_dealt_by_sample(spark):
    """A gene with all calls is summed in many tasks: the exchange is by gene and sample, then by pair."""
    g, y = gene(5, 200, 4)
    calls, who = long(spark, g, y)
    cohort = genetests.Cohort.of(who)
    carried = genetests.carriers(calls)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one task
    try:
        assert max(r["count"] for r in carried.groupBy(F.spark_partition_id()).count().collect()) < 120
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    nulls = spark.createDataFrame([(None, [0.0], [50.0], 1.0, 0)], "gene string, beta array<double>, info array<double>, variance double, n_masked int")
    sums = {(r.a, r.b): r for r in genetests.kernel_sums(carried, cohort, nulls).collect()}
    assert sums[0, 2].plain == pytest.approx(float(g[:, 0] @ g[:, 2]))
    assert sums[1, 1].score == pytest.approx(float(g[:, 1] @ (y - 0.5)))
    assert sum(r.carriers for r in sums.values()) == int((g.sum(1) > 0).sum())


def test_allelic_series_tells_its_status(spark):
    g, y = gene(100, 100, 9)
    category = np.array([1, 1, 1, 2, 2, 2, 3, 3, 3])

    def series(g, y, category, **more):
        calls, who = long(spark, g, y, category)
        return results(calls, genetests.Cohort.of(who), ["coast"], **more)["coast"]

    found = series(g, y, category)
    assert (found.status, found.warnings) == ("complete", "")
    assert found.p_value > 0.01
    partial = series(g, y, np.where(category == 2, 0, category))
    assert (partial.status, partial.warnings) == ("partial", "MISSING_DMV")
    none = series(g, y, np.zeros(9, int))
    assert (none.p_value, none.status, none.warnings) == (None, "skipped", "ALL_CATEGORIES_EMPTY")
    rng = np.random.default_rng(42)
    g = rng.choice([0, 1, 2], size=(100, 9), p=[0.6, 0.3, 0.1]).astype(float)
    y = rng.integers(0, 2, 100).astype(float)
    for j in (6, 7, 8):
        g[y == 1, j] = np.minimum(g[y == 1, j] + rng.binomial(1, 0.5, int(y.sum())), 2)
    strong = series(g, y, category)
    assert strong.p_value < 0.01
    assert series(g, y, category, series=(1.0, 1.0, 1.0)).p_value != pytest.approx(strong.p_value, rel=1e-3)


def mixed_exponentials(q, means):
    """Tail of a sum of exponentials of different means."""
    return sum(math.exp(-q / a) * math.prod(a / (a - b) for b in means if b != a) for a in means)


@pytest.mark.parametrize("accuracy", [1e-5, 1e-7, 1e-9])
def test_inversion_keeps_its_bound(accuracy):
    rnd = np.random.default_rng(1)
    for size in (2, 3, 5, 8):
        lam = np.repeat(rnd.uniform(0.2, 4, size), 2)
        for q in (0.05, 1.0, float(lam.sum()), 4 * float(lam.sum()), 12 * float(lam.sum())):
            p, bound, fault = quadform.bounded(q, lam, accuracy)
            assert fault == 0 and bound <= accuracy
            assert abs(p - mixed_exponentials(q, list(2 * lam[::2]))) <= accuracy, (size, q)


def test_inversion_published_values():
    """Six, three and one times squares of normals: tabulated to four digits; and of equal weights."""
    for q, below in ((1, 0.0542), (7, 0.4936), (20, 0.8760)):
        p, bound, fault = quadform.bounded(q, np.array([6.0, 3.0, 1.0]))
        assert fault == 0 and 1 - p == pytest.approx(below, abs=6e-5)
    for df in (2, 3, 4, 7, 40):
        for q in (0.5, df, 3 * df):
            assert quadform.bounded(2.5 * q, np.full(df, 2.5), 1e-6)[0] == pytest.approx(dist.chi2_sf(q, df), abs=1e-6)


def test_inversion_many_values_and_faults():
    lam = np.array([5.0, 3.0, 1.0, 0.5])
    qs = np.array([0.3, 9.0, 20.0, 60.0])
    many, bound, fault = quadform.bounded(qs, lam)
    assert fault == 0 and many == pytest.approx([quadform.bounded(q, lam)[0] for q in qs], abs=2e-7)
    assert many == pytest.approx(quadform.imhof(qs, lam), abs=1e-6)
    # a weight that hardly counts takes more terms than allowed: the value stands with the bound that it has
    p, bound, fault = quadform.bounded(3.0, np.array([1.0, 1e-7]), 1e-9)
    assert fault == 1 and 1e-9 < bound and abs(p - dist.chi2_sf(3.0, 1)) <= bound + 1e-6
    p, bound, fault = quadform.bounded(9.0, lam, limit=8)
    assert fault == 1 and abs(p - quadform.bounded(9.0, lam)[0]) <= bound
    for q, weights in ((9.0, []), (math.nan, [1.0, 2.0]), (1.0, [1.0, math.inf]), (0.0, [1.0, 2.0]), (1.0, [1.0, -1.0])):
        p, bound, fault = quadform.bounded(q, np.array(weights))
        assert fault == 2 and math.isnan(p)
    assert quadform.p_value(15.0, lam)[1] == "inversion"
