"""A whole run over a small VCF, and operators that have no query."""

import json

import pytest
from pyspark.sql import functions as F

from helicase.operators import annotate, association, burden, identifiers, report, scoring
from helicase.plans import analysis

HEAD = """##fileformat=VCFv4.2
##INFO=<ID=AF,Number=A,Type=Float,Description="x">
##INFO=<ID=ANN,Number=.,Type=String,Description="x">
##FORMAT=<ID=GT,Number=1,Type=String,Description="x">
##FORMAT=<ID=DP,Number=1,Type=Integer,Description="x">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tC\tF\tM
"""


def line(pos, af, impact, gene, *gts, flt="PASS"):
    return f"1\t{pos}\t.\tA\tG\t50\t{flt}\tAF={af};ANN=G|missense_variant|{impact}|{gene}|||||||p.Arg5Trp||||,G|x|MODIFIER|{gene}\tGT:DP\t" + "\t".join(f"{g}:30" for g in gts) + "\n"


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "a.vcf").write_text(HEAD + line(100, 0.001, "HIGH", "G1", "0/1", "0/1", "0/0") + line(200, 0.001, "MODERATE", "G1", "0/1", "0/0", "0/1") + line(300, 0.2, "HIGH", "G2", "1/1", "0/1", "0/1") + line(400, 0.001, "LOW", "G2", "0/1", "0/0", "0/0", flt="q"))
    (tmp_path / "f.ped").write_text("X C F M 1 2\nX F 0 0 1 1\nX M 0 0 2 1\n")
    (tmp_path / "p.tsv").write_text("s\tt\nC\tcase\nF\tcontrol\nM\tcontrol\n")
    (tmp_path / "r.bed").write_text("1\t50\t150\tpromoter\n")
    (tmp_path / "stats.json").write_text(json.dumps({"dataset_stats": [{"name": "n", "expression": "len(df)"}]}))
    (tmp_path / "model").mkdir()
    (tmp_path / "model" / "variable_assignment_config.json").write_text(json.dumps({"variables": {"IMPACT": "impact|default:''", "Inheritance_Pattern": "pattern"}}))
    (tmp_path / "model" / "formula_config.json").write_text(json.dumps({"output_scores": ["s"], "formulas": [{"s": "(impact == 'HIGH') * 2 + (pattern == 'compound_heterozygous')"}]}))
    return tmp_path


def test_whole_run(spark, inputs):
    s = analysis.Settings(
        vcf=str(inputs / "a.vcf"), presets=["pass", "coding"], filter="(AF < 0.3) & (GEN[0].DP >= 20)", pedigree=str(inputs / "f.ped"), phenotypes=str(inputs / "p.tsv"), sample_column="s", value_column="t", case_terms=["case"], control_terms=["control"],
        annotate_regions=[str(inputs / "r.bed")], scoring_model=str(inputs / "model"), statistics=str(inputs / "stats.json"), burden_mode="samples", links={"L": "x/{chrom}-{pos}"}, final_filter="s >= 1",
    )
    found = analysis.analyse(spark, s)
    rows = {r.pos: r for r in found.variants.collect()}
    assert sorted(rows) == [100, 200, 300]
    assert rows[100].Inheritance_Pattern == "compound_heterozygous"
    told = json.loads(rows[100].Inheritance_Details)
    assert [x["sample_id"] for x in told["samples_with_pattern"]] == ["C", "F"]
    assert told["samples_with_pattern"][0] == {"sample_id": "C", "genotype": "0/1", "affected": True, "compound_het_partners": ["1:200:A>G"], "compound_het_gene": "G1", "compound_het_configuration": "compound_heterozygous"}
    assert (told["affected_count"], told["carrier_count"], told["segregation_p_value"]) == (1, 1, 1.0)
    assert rows[100].Custom_Annotation == "Region=promoter_r"
    assert rows[300].GT == "C(1/1);F(0/1);M(0/1)"
    assert rows[100].s == 3
    assert rows[100].VAR_ID.startswith("var_0001_")
    assert rows[200].L == "x/1-200"
    assert (rows[300].proband_allele_count, rows[300].control_allele_count) == (2, 2)
    assert [tuple(r) for r in found.statistics.collect()] == [("n", 3.0)]
    assert {r.GENE for r in found.burden.collect()} == {"G1", "G2"}


def test_command_line(spark, inputs):
    (inputs / "c.json").write_text(json.dumps({"presets": {"own": "(AF < 0.01)"}, "links": {"L": "y/{pos}"}}))
    analysis.main(["--vcf", str(inputs / "a.vcf"), "--out", str(inputs / "out"), "--config", str(inputs / "c.json"), "--presets", "own"])
    lines = [x for p in (inputs / "out" / "variants").glob("part*") for x in p.read_text().splitlines()]
    assert len([x for x in lines if x.startswith("1\t")]) == 3


def test_cohorts(spark):
    samples = spark.createDataFrame([(s,) for s in "abcd"], "sample_id string")
    cases, controls = samples.where("sample_id = 'a'"), samples.where("sample_id IN ('a', 'b')")
    told = lambda *a: {r.sample_id: r.is_case for r in burden.cohort(samples, *a).collect()}
    assert told() == dict.fromkeys("abcd", False)
    assert told(cases) == {"a": True, "b": False, "c": False, "d": False}
    assert told(None, controls) == {"a": False, "b": False, "c": True, "d": True}
    assert told(cases, controls) == {"a": True, "b": False}
    with pytest.raises(ValueError, match="cases"):
        burden.checked(5, 100)
    assert burden.checked(50, 5000) == ["LOW_CASE_COUNT", "IMBALANCED_COHORT"]


def test_pseudonyms(spark):
    samples = spark.createDataFrame([("b", "Cases A!"), ("a", "Cases A!"), ("c", None)], "sample_id string, site string")
    assert {r.sample_id: r.pseudonym for r in identifiers.sequential(samples, "P").collect()} == {"a": "P_001", "b": "P_002", "c": "P_003"}
    assert {r.sample_id: r.pseudonym for r in identifiers.categorical(samples, "site").collect()} == {"a": "CASESA_001", "b": "CASESA_002", "c": "UNKNOWN_001"}
    assert {r.sample_id: r.pseudonym for r in identifiers.custom(samples, "{site}-{index:03d}").collect()} == {"a": "Cases A!-001", "b": "Cases A!-002", "c": "SAMPLE_003"}
    assert {r.pseudonym for r in identifiers.custom(samples, "same").collect()} == {"same", "same_2", "same_3"}
    assert identifiers.anonymous(samples, hashed=True).select(F.length("pseudonym").alias("n")).distinct().first().n == 6


def test_packing_positional_cells(spark):
    rows = spark.createDataFrame([(1, "0/1, 1/1"), (2, "a(0/1:3);b(1/1)")], "variant_id int, GT string")
    found = {(r.variant_id, r.sample_id): r.gt for r in annotate.unpacked(rows, samples=["a", "b"]).collect()}
    assert found == {(1, "a"): "0/1", (1, "b"): "1/1", (2, "a"): "0/1", (2, "b"): "1/1"}
    assert annotate.gene_list_flags(spark.createDataFrame([(1, "x,y")], "variant_id int, gene string"), spark.createDataFrame([("my list.txt", "Y")], "list_name string, gene string"), ["my list.txt"]).first().my_list == "yes"


def test_report_and_scoring_rules(spark):
    v = spark.createDataFrame([("G", "HIGH", "de_novo"), ("G", "LOW", "none")], "GENE string, IMPACT string, Inheritance_Pattern string")
    c = spark.createDataFrame([("s",)], "sample_id string")
    row = report.summary(v, c).first()
    assert (row.n_variants, row.n_genes, row.n_samples, row.impacts, row.patterns) == (2, 1, 1, {"HIGH": 1, "LOW": 1}, {"de_novo": 1})
    model = {"variables": {"absent": "x|default:3", "GENE": "g"}, "formulas": [{"a": "x * 2"}, {"b": "a + (g == 'G')"}], "output_scores": ["b"]}
    assert [r.b for r in scoring.apply_scoring(v, model).collect()] == [7.0, 7.0]
    assert scoring.needs_inheritance({"variables": {"Inheritance_Pattern": "p"}, "formulas": [{"a": "p == 'x'"}]})
    assert not scoring.needs_inheritance({"variables": {"Inheritance_Pattern": "p", "Z": "z"}, "formulas": [{"a": "z + 1"}]})


def test_components_separate_groups(spark):
    calls = [(v, f"s{s}", 2) for s in range(10) for v in (range(20) if s < 5 else range(20, 40))]
    df = spark.createDataFrame(calls, "variant_id bigint, sample_id string, dosage int")
    pcs = {r.sample_id: r.pc1 for r in association.principal_components(df, df.select("sample_id").distinct(), 2).collect()}
    assert len({pcs[f"s{s}"] > sum(pcs.values()) / 10 for s in range(5)}) == 1
    assert (pcs["s0"] > pcs["s9"]) == (pcs["s1"] > pcs["s8"])


def test_components_are_exact_for_many_variants(spark):
    """More variants than the former 4096 shared columns: components equal those of the whole centred matrix."""
    import numpy as np

    rng = np.random.default_rng(18)
    dosage = rng.integers(0, 3, (12, 6000)) * (rng.random((12, 6000)) < 0.4)
    calls = [(int(v), f"s{s:02}", int(dosage[s, v])) for s, v in zip(*np.nonzero(dosage), strict=True)]
    df = spark.createDataFrame(calls, "variant_id bigint, sample_id string, dosage int").repartition(5)
    samples = spark.createDataFrame([(f"s{s:02}",) for s in range(12)], "sample_id string")
    found = association.principal_components(df, samples, 3)
    assert found.columns == ["sample_id", "pc1", "pc2", "pc3"]
    rows = np.array([tuple(r)[1:] for r in found.orderBy("sample_id").collect()])
    u, s, _ = np.linalg.svd(dosage - dosage.mean(0), full_matrices=False)
    assert np.allclose(np.abs(rows), np.abs(u[:, :3] * s[:3]), atol=1e-6)


def test_small_helpers(spark, tmp_path):
    samples = spark.createDataFrame([("a_L1",), ("b",)], "sample_id string")
    terms = spark.createDataFrame([("a", ["x"]), ("b", ["y"])], "sample_id string, terms array<string>")
    assert {r.sample_id: r.terms for r in burden.by_shortened_ids(samples, terms, "_L1").collect()} == {"a_L1": ["x"], "b": ["y"]}
    genes = spark.createDataFrame([("g", 3), ("h", 30)], "gene string, case_carriers int")
    assert {r.gene: r.warnings for r in burden.few_carriers(genes).collect()} == {"g": "LOW_CASE_CARRIERS", "h": ""}
    assert annotate.of_transcripts(spark.createDataFrame([("NM_1.2",), ("NM_2.1",)], "FEATUREID string"), ["NM_1.5"]).count() == 1
    calls = spark.createDataFrame([(1, g) for g in ("0/1", "0/1", "1/1", "0/0", "1/1", "0/1")], "variant_id int, gt string")
    assert annotate.two_commonest(calls).first().gt == "0/1,1/1"
    results = spark.createDataFrame([("t", 0.1 * i) for i in range(1, 10)], "test string, p_value double")
    association.write_diagnostics(results, str(tmp_path / "d"))
    assert spark.read.csv(str(tmp_path / "d" / "qq_data"), sep="\t", header=True).count() == 9
    assert association.lambda_gc(results).first().lambda_gc == pytest.approx(1.0, abs=0.01)
    gains = association.weight_gains(spark.createDataFrame([("g", 0.2, 0.01), ("h", 0.01, 0.2), ("i", 0.2, 0.2)], "gene string, q_plain double, q_weighted double"))
    assert {r.gene: r.change for r in gains.collect()} == {"g": "gained", "h": "lost"}


def test_engine_joins_tests(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    people = [(f"s{i:03d}", i < 40) for i in range(80)]
    calls = [(v, f"g{v % 3}", p[0], int(rng.integers(1, 3)), int(v % 3 + 1)) for v in range(15) for p in people if rng.random() < (0.3 if v % 3 == 0 and p[1] else 0.1)]
    df = spark.createDataFrame(calls, "variant_id bigint, gene string, sample_id string, dosage int, category int")
    who = spark.createDataFrame(people, "sample_id string, is_case boolean")
    weights = spark.createDataFrame([("g0", 2.0)], "gene string, weight double")
    rows = {r.gene: r for r in association.run_all(df, who, ["fisher", "skato", "coast", "logistic_burden"], gene_weights=weights).collect()}
    assert set(rows) == {"g0", "g1", "g2"}
    assert rows["g0"].acat_o_pvalue < 0.01
    assert rows["g0"].acat_o_pvalue < min(rows["g1"].acat_o_pvalue, rows["g2"].acat_o_pvalue)
    assert rows["g0"].fdr_weight == pytest.approx(1.5)
    with pytest.raises(ValueError, match="no test"):
        association.run_all(df, who, ["absent"])
