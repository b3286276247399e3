"""Results that larger tables bring out: names apart by case, ties, numbers of four digits."""

import math
import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helicase.functions import dist, kernels, quadform, spectra
from helicase.operators import association, correction, genetests, identifiers

#: Bytes that a block may take besides its matrix.
HELD_BESIDE = 18e6
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_cohort_scan_can_be_written(spark, tmp_path):
    """N and n are columns of their own in a file as well, and the caller's session stays as it was."""
    from helicase.plans.catalogue_io import QUERIES

    df = QUERIES["cohort_scan"](spark, SF)
    df.write.parquet(str(tmp_path / "scan"))
    back = df.sparkSession.read.parquet(str(tmp_path / "scan"))
    assert back.columns == ["sample_id", "N", "n"]
    assert back.agg(F.sum("n"), F.min("N")).first()[:] == (back.count(), "1")
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


@pytest.mark.parametrize("small", [True, False])
def test_equal_p_values_are_ranked_by_ties(spark, small):
    rows = [(i, 0.5 if i % 3 else 0.25) for i in reversed(range(60))]
    df = spark.createDataFrame(rows, "id int, p double").repartition(7)
    found = {r.id: r.expected for r in correction.qq(df, ties=["id"], small=small).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    assert found == {i: pytest.approx((k + 1) / 61) for k, (i, _) in enumerate(order)}


def test_numbers_of_four_digits_stay_whole(spark):
    """Pseudonyms and families beyond 999 are not cut to three digits, which would make them equal."""
    ids = spark.range(1100).select(F.format_string("s%05d", "id").alias("sample_id"), F.lit("a").alias("c"))
    assert identifiers.categorical(ids, "c").select("pseudonym").distinct().count() == 1100
    family = ids.select(F.col("sample_id").alias("family_id"), "sample_id", F.lit("0").alias("father_id"), F.lit("0").alias("mother_id"))
    told = identifiers.pseudonymised_pedigree(family, identifiers.custom(ids, "P{index}"))
    assert told.select("family_id").distinct().count() == 1100
    assert told.agg(F.max("family_id")).first()[0] == "FAM999"
    assert told.where("family_id = 'FAM1100'").count() == 1


@pytest.mark.parametrize("taken", [True, False])
def test_a_direction_moves_eigenvalues(taken):
    rng = np.random.default_rng(1)
    d = np.concatenate([np.repeat([0.0, 1.0, 3.0], 8), rng.random(30), 1 + 1e-9 * rng.random(6)])
    z, carried = rng.standard_normal(len(d)), rng.standard_normal((len(d), 2))
    z[::7] = 0.0
    values, found = spectra.with_direction(d, z, carried, taken)
    whole = np.diag(d) + (-1 if taken else 1) * np.outer(z, z)
    assert np.allclose(np.sort(values), np.linalg.eigvalsh(whole), atol=1e-11)
    assert np.allclose((found.T * values) @ found, carried.T @ whole @ carried, atol=1e-9)


@pytest.mark.parametrize("binary", [True, False])
def test_tests_on_pairs_equal_those_on_matrices(spark, monkeypatch, binary):
    """Genes of sparse carriers, with a covariate and masked samples: all kernel tests, with and without matrices."""
    rng = np.random.default_rng(2)
    n, p = 150, 40
    g = (rng.random((n, p)) < 0.02) * rng.integers(1, 3, (n, p))
    rows = [("g", int(v), f"s{i:03d}", float(g[i, v]), float(v % 3 + 1), int(v % 4), i in (4, 9)) for i, v in zip(*np.nonzero(g), strict=True)]
    rows += [("h", 0, f"s{i:03d}", 1.0, 1.0, 1, False) for i in range(5)]
    calls = spark.createDataFrame(rows, "gene string, variant_id bigint, sample_id string, dosage double, weight double, category int, masked boolean")
    people = [(f"s{i:03d}", float(rng.random() < 0.4) if binary else float(rng.normal()), float(round(rng.normal(), 1))) for i in range(n)]
    table = spark.createDataFrame(people, "sample_id string, y double, c double")
    cohort = genetests.Cohort.of(table.select("sample_id", "y"), [("covariates", table.select("sample_id", "c"))], binary)

    def found():
        rows = association.test_genes(calls, cohort, ["skat", "skato", "burden", "acat_v", "coast"]).collect()
        return {(r.gene, r.test): (r.p_value if r.p_value is not None else np.nan, r.status) for r in rows}

    whole = found()
    monkeypatch.setattr(genetests, "MOST_DENSE", 0)
    pairs = found()
    assert pairs.keys() == whole.keys()
    for k, (p_value, status) in pairs.items():
        assert p_value == pytest.approx(whole[k][0], rel=1e-7, nan_ok=True), k
        assert status == whole[k][1]


def test_a_gene_of_many_variants_is_no_matrix():
    """6,000 variants that meet in twos: one matrix of them alone has 288 MB."""
    n = 6000
    a = np.concatenate([np.arange(n), np.arange(0, n, 2)])
    b = np.concatenate([np.arange(n), np.arange(1, n, 2)])
    own = a == b
    rng = np.random.default_rng(4)
    table = pa.table({
        "a": a, "b": b, "product": np.where(own, 1.0, 0.3), "plain": np.where(own, 4.0, 1.0), "score": np.where(own, rng.normal(size=len(a)), 0.0), "alleles": np.where(own, 3.0, 0.0),
        "with_x": [[1.0] for _ in a], "weight": np.ones(len(a)), "category": pa.array(np.ones(len(a), int), pa.int32()), "carriers": np.ones(len(a), int),
        "info": [[1e4] for _ in a], "n_masked": np.zeros(len(a), int), "variance": np.ones(len(a)),
    })
    tracemalloc.start()
    try:
        sums = genetests._gene_sums(table, 100_000, True)
        ps = [association.TESTS[t](sums)["p_value"] for t in ("skat", "skato", "burden", "acat_v")]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all(0 < p < 1 for p in ps)
    assert sums.carriers == len(a)
    assert peak < 150e6
    few = sums.variants(np.arange(n) < 6)
    assert np.allclose(few.scored.cross[:2, :2], [[1.0, 0.3], [0.3, 1.0]])
    assert kernels.skat(few.scored)[0] == pytest.approx(kernels.skat(few.scored.dense())[0])


def linked(n, seed=5):
    """Pairs of n variants in one component, and two columns."""
    rng = np.random.default_rng(seed)
    a, b = np.arange(n - 1), np.arange(1, n)
    more = np.unique(np.sort(rng.integers(0, n, (n // 2, 2)), axis=1), axis=0)
    more = more[more[:, 1] - more[:, 0] > 1]
    at, to = np.concatenate([np.arange(n), a, more[:, 0]]), np.concatenate([np.arange(n), b, more[:, 1]])
    value = np.where(at == to, rng.integers(2, 5, len(at)), rng.integers(1, 3, len(at)) / 4)
    return at, to, value, np.column_stack([rng.random(n), np.ones(n)])


@pytest.mark.parametrize("n", [2, 3, 4, 70, 300])
def test_a_block_is_reduced_in_its_place(monkeypatch, n):
    """As by eigenvectors: values, and carried columns whose products with powers of the matrix stay to rounding."""
    monkeypatch.setattr(spectra, "WIDE", 2)
    at, to, value, carried = linked(n)
    whole = np.zeros((n, n))
    whole[at, to] = whole[to, at] = value
    values, found = spectra.blocks(n, at, to, value, carried)
    assert np.allclose(np.sort(values), np.linalg.eigvalsh(whole), atol=1e-11)
    for k in range(4):
        assert np.allclose((found.T * values**k) @ found, carried.T @ np.linalg.matrix_power(whole, k) @ carried, rtol=1e-11)


def test_a_linked_gene_holds_one_matrix():
    """1,600 variants that carriers link: one matrix of them has 20 MB, and no second one is made."""
    n = 1600
    at, to, value, carried = linked(n)
    tracemalloc.start()
    try:
        spectra.blocks(n, at, to, value, carried)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < n * n * 8 + HELD_BESIDE


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_typed_scan_takes_no_rows_from_python(spark, monkeypatch):
    from helicase.plans.catalogue_io import QUERIES

    def refused(*_, **__):
        raise AssertionError("rows from Python")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    assert QUERIES["typed_rare_scan"](spark, SF).count() > 0


def test_a_run_makes_calls_once(spark):
    """What calls are made from is read once for all tests and counts, not again by each."""
    n, made = 60, spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(f"g{v % 2}", v, f"s{(7 * v + 3 * k) % n:02d}", k % 2 + 1, k % 4) for v in range(12) for k in range(5)]
    schema = "gene string, variant_id bigint, sample_id string, dosage int, category int"
    calls = spark.createDataFrame(rows, schema).mapInArrow(counted, schema)
    who = spark.createDataFrame([(f"s{i:02d}", i % 3 == 0) for i in range(n)], "sample_id string, is_case boolean")
    found = association.run_all(calls, who, ["fisher", "logistic_burden", "skat", "coast"]).collect()
    assert sorted((r.gene, r.n_variants) for r in found) == [("g0", 6), ("g1", 6)]
    assert made.value == len(rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_only_line_items_that_make_calls_are_grouped(spark):
    from helicase.plans import adapter

    found = adapter.calls(spark, SF)
    assert "GreaterThan(l_quantity,44" in found._jdf.queryExecution().toString()
    whole = adapter.all_calls(spark, SF).where("dosage > 0")
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty() and found.count() > 0


def test_results_of_genes_are_written_in_few_files(spark, monkeypatch):
    """A file starts a program on an executor (its mode is set), which counts as another executor until it runs; and carriers
    that are alike reach the tests as one row."""
    rows = [(f"g{g:02d}", 4 * g + v, f"s{s:02d}", 1.0, 1.0, 1 + v % 3) for g in range(24) for v in range(4) for s in range(3 * v + g % 5, 3 * v + g % 5 + 12)]
    calls = spark.createDataFrame(rows, "gene string, variant_id bigint, sample_id string, dosage double, weight double, category int")
    cohort = genetests.Cohort.of(spark.range(60).select(F.format_string("s%02d", "id").alias("sample_id"), (F.col("id") % 2).cast("double").alias("y")))
    files, plain, before = {}, association.materialised, spark.conf.get("spark.sql.shuffle.partitions")

    def counted(df, name, *more):
        made = plain(df, name, *more)
        files[name] = len(made.inputFiles())
        return made

    monkeypatch.setattr(association, "materialised", counted)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert association.test_genes(calls, cohort, ["coast"]).where("p_value BETWEEN 0 AND 1").count() == 24
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert files["fitted"] <= 2 and files["kernels"] <= 2


def test_equal_carriers_are_counted_before_they_are_dealt_to_tests(spark):
    rows = [("g", f"s{i:03d}", i == 7, [(1, 1.0, 1.0, 1 + i % 3)]) for i in range(90)]
    carried = spark.createDataFrame(rows, "gene string, sample_id string, masked boolean, has array<struct<variant_id: bigint, d: double, weight: double, category: int>>")
    cohort = genetests.Cohort.of(spark.range(90).select(F.format_string("s%03d", "id").alias("sample_id"), (F.col("id") % 2).cast("double").alias("y")))
    found = genetests.changes(carried, cohort, association._series_predictors((1.0, 2.0, 3.0)))
    told = {(r.test, r.b0, r.b1, r.b2): (r.n, r.ny) for r in found.collect()}
    assert told["coast:sum_ind", 2.0, 0.0, 0.0] == (29.0, 14.0) and told["coast:sum_ind", 0.0, 0.0, 0.0] == (-90.0, -45.0)
    assert told["coast:base_count", 0.0, 0.0, 1.0] == (30.0, 15.0) and told["null", 0.0, 0.0, 0.0] == (-1.0, -1.0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    tests_at, counted_at = plan.index("Generate"), plan.rindex("Aggregate")
    assert tests_at < counted_at  # the plan is told from its end


def linked_gene(variants, samples, scale=1.0, each=3):
    """A gene whose carriers link nearly all its variants."""
    rng = np.random.default_rng(11)
    carriers = np.array([rng.choice(samples, each, replace=False) for _ in range(variants)])
    y = (rng.random(samples) < 0.5) - 0.5
    by_sample = {}
    for v, some in enumerate(carriers):
        for s in some:
            by_sample.setdefault(int(s), []).append(v)
    pairs = {}
    for has in by_sample.values():
        for i, a in enumerate(has):
            for b in has[i:]:
                pairs[a, b] = pairs.get((a, b), 0.0) + 0.25
    at, to = np.array(list(pairs)).T
    return kernels.Linked(scale * y[carriers].sum(1), at, to, np.array(list(pairs.values())), np.full((variants, 1), each * 0.25 / math.sqrt(samples * 0.25)))


def test_linked_genes_are_told_by_power_sums(monkeypatch):
    """No block is held, and no eigenvalue found, for tails that power sums tell; they are what eigenvalues tell."""
    plain, far = linked_gene(2600, 9000), linked_gene(2600, 9000, 1.25)
    exact = [quadform.p_value(float((s.score**2).sum()) / 2, s.weights())[0] for s in (plain, far)] + [kernels._best_mixture(plain.score, plain)[0]]
    # nearly all of this mixture is one weight: its tail given the rest, which is nearly normal
    lam, far_out = np.sort(plain.mixed(0.999)), (0.001 * float((plain.score**2).sum()) + 0.999 * float(plain.score.sum()) ** 2) / 2
    x, w = np.polynomial.hermite_e.hermegauss(40)
    left = far_out - lam[:-1].sum() - math.sqrt(2 * (lam[:-1] ** 2).sum()) * x
    one = float(w @ [dist.chi2_sf(v / lam[-1], 1) for v in left]) / math.sqrt(2 * math.pi)
    fresh = linked_gene(2600, 9000), linked_gene(2600, 9000, 1.25)
    assert np.bincount(spectra.components(2600, fresh[0].at, fresh[0].to)).max() > 2 * spectra.WIDE

    def held(*_):
        raise AssertionError("a block is held")

    monkeypatch.setattr(spectra, "_tridiagonal", held)
    assert kernels.skat(fresh[0])[0] == pytest.approx(exact[0], abs=2e-7)
    told, way = kernels.skat(fresh[1])
    assert exact[1] < 1e-5 and way == "saddlepoint" and told == pytest.approx(exact[1], rel=1e-3)
    assert quadform.p_value(far_out, next(fresh[0].forms()).mixed(0.999))[0] == pytest.approx(one, abs=1e-7)
    assert kernels.skat_o(fresh[0])[0] == pytest.approx(exact[2], abs=5e-5)  # panels of eigenvalues are wrong by 1e-5 there


def test_power_sums_are_those_of_eigenvalues():
    s = linked_gene(1500, 4000, each=4)
    dense = s.dense().gram
    lam = np.linalg.eigvalsh(dense)
    walked = spectra._walked(1500, s.at, s.to, s.product, 10)
    assert walked == pytest.approx((np.linalg.eigvalsh(s.cross)[:, None] ** np.arange(1, 11)).sum(0), rel=1e-10)
    large, sums = spectra.leading(lambda x: dense @ x, 1500)
    assert len(large) and large == pytest.approx(lam[::-1][: len(large)], rel=1e-9)
    form = kernels.Powered.of(s, 8, s.leading).shared()
    other = s.shared()
    assert (form.length, form.loading, form.tied) == pytest.approx((other.length, other.loading, other.tied), rel=1e-8)
    assert [quadform.power(form.lam, k) for k in (1, 2, 3, 4)] == pytest.approx([quadform.power(other.lam, k) for k in (1, 2, 3, 4)], rel=1e-9)
    for rho in (0.01, 0.5):
        assert [quadform.power(form, k) for form in [kernels.Powered.of(s, 8, s.leading).mixed(rho)] for k in (1, 2, 3, 4)] == pytest.approx([quadform.power(s.mixed(rho), k) for k in (1, 2, 3, 4)], rel=1e-9)


def test_power_sums_that_do_not_reach_give_way_to_eigenvalues():
    s = linked_gene(450, 900)
    s.product[:] = s.product * np.where((s.at == 0) & (s.to == 0), 400.0, 1.0)  # one weight above all others
    s.score[0] = 40.0
    with pytest.raises(quadform.Unmet):
        quadform.p_value(float((s.score**2).sum()) / 2, kernels.Powered.of(s, 8, (np.empty(0), np.empty(0))).weights())
    assert kernels.skat(s)[0] == pytest.approx(quadform.p_value(float((s.score**2).sum()) / 2, s.weights())[0], abs=2e-7)
