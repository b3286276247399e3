"""The command line with every group of options, steps that a second run finds, block-gzip in ranges, faults named at once."""

import json
import os
import random
import zlib

import pytest

from helicase.plans import analysis, config
from helicase.sources import sheets, tables, vcf
from test_analysis import HEAD, line


def block(data):
    """One member as bgzip writes it: its size stands in an extra field."""
    by = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = by.compress(data) + by.flush()
    size = len(body) + 25
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + size.to_bytes(2, "little") + body + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")


@pytest.mark.parametrize("ends", [True, False])
def test_block_gzip_is_read_in_ranges(spark, tmp_path, ends):
    rnd = random.Random(1)
    lines = [f"{i}\t" + "".join(rnd.choices("ACGTé", k=rnd.choice([0, 5, 40, 3000]))) for i in range(900)]
    data = "\n".join(lines).encode() + (b"\n" if ends else b"")
    raw, at = b"", 0
    while at < len(data):
        n = rnd.choice([50, 700, 9000])
        raw += block(data[at : at + n])
        at += n
    raw += block(b"")
    path = tmp_path / "a.vcf.gz"
    path.write_bytes(raw)
    for split in (300, 5000, 60_000, len(raw), 1 << 30):
        found = [r.value for r in vcf.block_lines(spark, f"file:{path}", len(raw), split).collect()]
        assert sorted(found) == sorted(lines), split


def test_large_block_gzip_takes_that_way(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vcf, "SPLIT_BYTES", 200)
    text = (HEAD + line(100, 0.001, "HIGH", "G1", "0/1", "0/1", "0/0") * 20).encode()
    (tmp_path / "a.vcf.gz").write_bytes(b"".join(block(text[i : i + 150]) for i in range(0, len(text), 150)) + block(b""))
    raw = vcf.lines(spark, str(tmp_path / "a.vcf.gz"))
    assert "MapInArrow" in raw._jdf.queryExecution().toString()
    assert vcf.parsed(raw).count() == 20
    assert vcf.sample_names(raw) == ["C", "F", "M"]


@pytest.fixture
def inputs(tmp_path):
    rnd = random.Random(2)
    people = [f"S{i:02}" for i in range(30)]
    head = HEAD.replace("\tC\tF\tM", "\t" + "\t".join(people))
    genes = ["G1", "G2", "G3"]
    rows = []
    for i in range(60):
        gts = [rnd.choice(["0/0"] * 5 + ["0/1", "0/1", "1/1"]) for _ in people]
        rows.append(line(100 + 10 * i, 0.001, "HIGH", genes[i % 3], *gts).replace("p.Arg5Trp", f"p.(Arg{i}Trp)").replace("|G1|||", "|G1||T1.2|"))
    (tmp_path / "a.vcf").write_text(head + "".join(rows))
    (tmp_path / "p.csv").write_text("who,term\n" + "".join(f"{p},{'case' if i < 14 else 'control'}\n" for i, p in enumerate(people)))
    (tmp_path / "genes.bed").write_text("chr1\t0\t2000\tG1\nchr1\t0\t2000\tG2\nchr1\t0\t2000\tG3\n")
    (tmp_path / "kit.bed").write_text("1\t0\t600\tkit\n")
    (tmp_path / "attr.json").write_text(json.dumps([{"symbol": "G1", "class": "tumour"}]))
    (tmp_path / "lookup.json").write_text(json.dumps({"lookup": {"G1:0": [{"ref_aa": "R", "alt_aa": "H", "clnsig": "P", "review": "x"}]}}))
    (tmp_path / "reads.csv").write_text("S00,/x/S00.bam\n")
    (tmp_path / "cov.tsv").write_text("id\tage\n" + "".join(f"{p}\t{20 + i % 7}\n" for i, p in enumerate(people)))
    (tmp_path / "fam.ped").write_text("".join(f"F {p} 0 0 1 {2 if i < 14 else 1}\n" for i, p in enumerate(people)))
    return tmp_path


def table(spark, path):
    return tables.read_delimited(spark, str(path))


def test_every_group_of_options(spark, inputs):
    i = lambda n: str(inputs / n)
    out = inputs / "out"
    args = [
        "--vcf", i("a.vcf"), "--out", str(out), "--genes", "G1 G2 G3", "--gene-coordinates", i("genes.bed"), "--capture-regions", i("kit.bed"), "--filter", "(AF < 0.01)", "--presets", "pass", "high", "--late-filter",
        "--phenotypes", i("p.csv"), "--sample-column", "who", "--value-column", "term", "--case-terms", "case", "--control-terms", "control", "--pedigree", i("fam.ped"), "--gene-json", i("attr.json"),
        "--gene-json-mapping", '{"identifier": "symbol", "dataFields": ["class"]}', "--pm5-lookup", i("lookup.json"), "--reads", i("reads.csv"), "--statistics", "default", "--burden-mode", "samples",
        "--association-tests", "fisher", "logistic_burden", "skat", "skat_o", "coast", "--covariate-file", i("cov.tsv"), "--pca-tool", "own", "--pca-components", "2", "--diagnostics-output", i("diag"), "--pseudonyms", "sequential",
        "--formats", "tsv", "xlsx", "html", "json", "archive", "--work", i("work"), "--genotype-modes", "het", "hom",
    ]
    analysis.main(args)
    rows = table(spark, out / "variants").collect()
    assert 0 < len(rows) <= 51
    assert all(int(r.pos) <= 600 for r in rows)
    first = next(r for r in rows if r.pos == "100")
    assert "class=tumour" in first.Custom_Annotation
    assert first.PM5 == "PM5"
    assert first.GT.startswith("SAMPLE_")
    assert "S0" not in first.Inheritance_Details
    found = {r.gene: r for r in table(spark, out / "association").collect()}
    assert set(found) == {"G1", "G2", "G3"}
    assert {"fisher_pvalue", "skat_o_pvalue", "coast_status", "acat_o_qvalue", "warnings"} <= set(table(spark, out / "association").columns)
    assert "LOW_CASE_COUNT" in found["G1"].warnings
    assert "cases: 14" in "\n".join(p.read_text() for p in (inputs / "diag" / "summary").glob("part*"))
    assert (inputs / "diag" / "qq_plot.svg").read_text().count("<circle") > 3
    assert {r.metric for r in table(spark, out / "statistics").collect()} >= {"total_variants", "total_genes"}
    assert table(spark, out / "gene_burden").count() == 3
    assert table(spark, out / "report_jobs").count() > 0
    book = sheets.read_workbook(str(next(out.glob("*.xlsx"))))
    assert list(book) == ["Results", "Metadata", "Statistics", "Gene Burden", "Association"]
    assert len(book["Results"]) == len(rows) + 1
    assert "Variant report" in (out / "report" / "index.html").read_text()
    assert json.loads((out / "report" / "summary.json").read_text())["n_variants"] == len(rows)
    assert len(list(inputs.glob("*.tar.gz"))) == 1
    assert "records\tmade" in (out / "steps.tsv").read_text()
    again = analysis.analyse(spark, analysis.Settings(vcf=i("a.vcf"), genes="G1 G2 G3", gene_coordinates=i("genes.bed"), capture_regions=i("kit.bed"), filter="(AF < 0.01)", presets=["pass", "high"], late_filter=True, work=i("work")))
    assert again.steps.done[:2] == [("records", "found"), ("calls", "found")]
    other = analysis.analyse(spark, analysis.Settings(vcf=i("a.vcf"), filter="(AF < 0.5)", work=i("work")))
    assert {state for _, state in other.steps.done} == {"made"}
    assert other.variants.count() == 60


def test_too_few_cases_leave_the_association_out(spark, inputs):
    i = lambda n: str(inputs / n)
    (inputs / "cases.txt").write_text("S00\nS01\n")
    found = analysis.analyse(spark, analysis.Settings(vcf=i("a.vcf"), case_samples=i("cases.txt"), association={"association_tests": ["fisher"]}))
    assert found.association is None
    with pytest.raises(ValueError, match="cadd"):
        analysis.analyse(spark, analysis.Settings(vcf=i("a.vcf"), phenotypes=i("p.csv"), sample_column="who", value_column="term", case_terms=["case"], control_terms=["control"], association={"association_tests": ["skat"], "variant_weights": "cadd"}))


def test_faults_are_named_at_once(spark, inputs, capsys):
    with pytest.raises(SystemExit) as e:
        analysis.main(["--vcf", str(inputs / "none.vcf"), "--out", str(inputs / "o"), "--phenotypes", str(inputs / "p.csv"), "--sample-column", "nobody", "--variant-weights", "odd", "--gene-json", str(inputs / "attr.json")])
    told = str(e.value)
    assert all(x in told for x in ("no such VCF", "no column nobody", "no such weights", "needs a mapping"))
    with pytest.raises(ValueError, match="unknown setting x.*skat_backend"):
        config.association({"x": 1, "skat_backend": "r"})
    assert config.association({"min_cases": 20}).min_cases == 20
    analysis.main(["--list-profiles"])
    analysis.main(["--vcf", str(inputs / "a.vcf"), "--list-fields"])
    assert "dbnsfp5" in capsys.readouterr().out
    with pytest.raises(ValueError, match="no coordinates"):
        tables.gene_regions(tables.read_gene_coordinates(spark, str(inputs / "genes.bed")), ["G1", "G9"])
    assert os.path.exists(inputs / "a.vcf")


def test_workbook_cells(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a<b>&"c"', "https://x/1?a=1&b=2", 1.5, True), (2, None, "https://x/2", float("nan"), False)], "n int, t string, url string, x double, b boolean")
    path = sheets.write_workbook(spark, {"A": rows}, str(tmp_path / "a.xlsx"))
    cells = sheets.read_workbook(path)["A"]
    assert cells[0] == ["n", "t", "url", "x", "b"]
    assert cells[1][:4] == ["1", 'a<b>&"c"', "https://x/1?a=1&b=2", "1.5"]
    assert sheets.link_columns(rows) == ["url"]
    assert sheets.column_letters(27) == "AB"


def test_rules_columns_pseudonyms_and_a_quantitative_trait(spark, inputs):
    i = lambda n: str(inputs / n)
    (inputs / "rules.tsv").write_text("GENE\tGENOTYPES\nG1\thom\ng2\thet,hom\n")
    (inputs / "num.csv").write_text("who,term,height\n" + "".join(f"S{k:02},{'case' if k < 14 else 'control'},{150 + 7 * k % 40}\n" for k in range(30)))
    s = analysis.Settings(
        vcf=i("a.vcf"), genotype_rules=i("rules.tsv"), genotype_modes=["het"], extra_sample_fields=["DP"], extra_sample_delimiter="|", gene_json=[i("attr.json")], gene_json_mapping='{"identifier": "symbol", "dataFields": ["class"]}', gene_json_columns=True,
        phenotypes=i("num.csv"), sample_column="who", value_column="term", trait_column="height", case_terms=["case"], control_terms=["control"], pedigree=i("fam.ped"), pseudonyms="categorical", pseudonym_category="cohort", pseudonym_pedigree=True,
        association={"trait_type": "quantitative", "association_tests": ["linear_burden", "skat"], "skat_method": "SKATO", "variant_weights": "uniform"},
    )
    found = analysis.analyse(spark, s)
    modes = {g: {r.dosage for r in found.calls.where(f"gene = '{g}'").select("dosage").distinct().collect()} for g in ("G1", "G2", "G3")}
    assert modes == {"G1": {2}, "G2": {1, 2}, "G3": {1}}
    rows = found.variants.select("gene", "GT", "class").collect()
    assert {r["class"] for r in rows if r.gene == "G1"} == {"tumour"}
    assert {r["class"] for r in rows if r.gene != "G1"} == {None}
    assert all("|30)" in r.GT for r in rows)
    assert any(r.GT.startswith(("CASE_0", "CONTROL_0")) for r in rows)
    family = {r.sample_id for r in found.pedigree.collect()}
    assert family == {f"CASE_{k:03}" for k in range(1, 15)} | {f"CONTROL_{k:03}" for k in range(1, 17)}
    told = found.association
    assert {"n_samples", "linear_burden_effect", "skat_o_pvalue", "acat_o_qvalue"} <= set(told.columns)
    assert {r.n_samples for r in told.collect()} == {30}
    with pytest.raises(ValueError, match="no sample fields XX"):
        analysis.analyse(spark, analysis.Settings(vcf=i("a.vcf"), extra_sample_fields=["XX"]))


def test_settings_reach_the_plan():
    told = {
        "min_cases": 7, "max_case_control_ratio": 3.0, "min_case_carriers": 2, "correction_method": "bonferroni", "gene_burden_mode": "alleles", "confidence_interval_method": "score", "confidence_interval_alpha": 0.1,
        "continuity_correction": 0.25, "trait_type": "quantitative", "variant_weights": "cadd", "variant_weight_params": {"cadd_cap": 30.0}, "missing_site_threshold": 0.2, "missing_sample_threshold": 0.5, "firth_max_iter": 9,
        "skat_method": "Burden", "coast_weights": [1.0, 1.5, 4.0],
    }
    plan = config.plan(config.association(told))
    assert (plan.few_cases, plan.most_ratio, plan.least_carriers, plan.correction, plan.burden_mode) == (7, 3.0, 2, "bonferroni", "alleles")
    assert (plan.interval.method, plan.interval.alpha, plan.interval.continuity) == ("score", 0.1, 0.25)
    assert (plan.binary, plan.weights, plan.weight_params, plan.most_missing_site, plan.most_missing_sample) == (False, "cadd", {"cadd_cap": 30.0}, 0.2, 0.5)
    assert (plan.firth_steps, plan.skat_method, plan.series) == (9, "Burden", (1.0, 1.5, 4.0))
    bad = {"coast_weights": [1.0, 2.0], "confidence_interval_alpha": 2.0, "variant_weight_params": {"odd": 1}, "trait_type": "quantitative", "association_tests": ["fisher"]}
    assert len(config.association_faults(bad)) == 4
