"""Stores of typed fields: filters as on parsed records, row groups left out, a run over a store as over its VCF."""

import random

import pytest
from pyspark.sql import functions as F

from helicase.plans import analysis
from helicase.plans.filterlang import compile_filter, composed
from helicase.sources import typed, vcf
from test_analysis import HEAD, line

TOP = """##fileformat=VCFv4.2
##INFO=<ID=AF,Number=A,Type=Float,Description="Frequency">
##INFO=<ID=dbNSFP_gnomAD4.1_joint_AF,Number=A,Type=Float,Description="f">
##INFO=<ID=dbNSFP_gnomAD4.1_joint_AC,Number=A,Type=Integer,Description="c">
##INFO=<ID=dbNSFP_gnomAD4_1_joint_AC,Number=1,Type=Integer,Description="a name that differs by a sign">
##INFO=<ID=TAG,Number=1,Type=String,Description="text">
##INFO=<ID=DB,Number=0,Type=Flag,Description="flag">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA""".split("\n")


def lines_of(n=6000):
    rnd = random.Random(4)
    out = []
    for i in range(n):
        af = rnd.choice(["0.00001", "0.00005", "0.002", "0.03", "0.3", "0.5"]) if i % 40 else rnd.choice([".", "", "0", "x", "0.00001,0.4", "0.4,0.00001", "1e-5"])
        info = [f"AF={af}", f"dbNSFP_gnomAD4.1_joint_AF={af}"]
        if i % 7:
            info.append(f"dbNSFP_gnomAD4.1_joint_AC={rnd.choice(['1', '2', '30', '1,9', '.'])}")
        if i % 5:
            info.append(f"TAG={rnd.choice(['a', 'b', '.', 'a,b'])}")
        if i % 3 == 0:
            info.append("DB")
        noise = "".join(rnd.choice("ACGT") for _ in range(30))
        out.append("\t".join([rnd.choice("12X"), str(rnd.randrange(1, 10**7)), f"r{i}", "A", noise, rnd.choice([".", "5", "50.5"]), rnd.choice([".", "PASS", "q10"]), ";".join(info), "GT", "0/1"]))
    return out


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("typed") / "store")
    head = vcf.header_fields(spark.createDataFrame([(h,) for h in TOP], "value string"))
    records = vcf.parsed(spark.createDataFrame([(x,) for x in lines_of()], "value string"))
    typed.write_store(records, head, TOP, path, files=2, row_group=64 << 10)
    return path, head, records


FILTERS = [
    "AF < 0.01", "AF[0] < 0.01", "AF[*] < 0.01", "AF >= 0", "AF != 0.3", "na AF", "exists AF[0]", "na AF[0]", "0.01 > AF", "INFO/AF < 0.01", "TAG = 'a'", "TAG != 'a'", "TAG =~ '^a'",
    "na TAG", "exists DB", "na DB", "QUAL >= 20", "na QUAL", "FILTER = 'PASS'", "FILTER != 'PASS'", "(na FILTER) | (FILTER = 'PASS')", "POS < 5000000 & CHROM = '1'", "!(AF < 0.01)", "AF * 2 < 0.01",
    "dbNSFP_gnomAD4.1_joint_AC = 30", "dbNSFP_gnomAD4_1_joint_AC = 30", "AF < QUAL", "ID = 'r7'", composed(["rare"], None, "dbnsfp4"),
]


@pytest.mark.parametrize("text", FILTERS)
def test_filters_as_on_parsed_records(spark, store, text):
    path, head, records = store
    schema = analysis.filter_schema(head)
    text = text.replace("dbNSFP_gnomAD_exomes", "dbNSFP_gnomAD4.1_joint").replace("dbNSFP_gnomAD_genomes", "dbNSFP_gnomAD4.1_joint")
    expected = sorted(r.id for r in records.where(compile_filter(text, schema)).select("id").collect())
    rows = typed.read_store(spark, path).where(compile_filter(text, typed.stored_schema(schema, head)))
    assert sorted(r.id for r in rows.select("id").collect()) == expected


def scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_rarity_preset_leaves_out_row_groups(spark, store):
    path, head, _ = store
    schema = typed.stored_schema(analysis.filter_schema(head), head)
    rows = typed.read_store(spark, path)
    rare = compile_filter("(dbNSFP_gnomAD4.1_joint_AF[0] < 0.0001) & (AF[0] < 0.0001)", schema)
    found = rows.where(rare).select("id")
    plan = found._jdf.queryExecution().toString()
    assert "LessThan(first_" in plan and "info" not in plan.split("ReadSchema:")[1].split("\n")[0]
    every, read = rows.count(), scanned(found)
    assert found.count() <= read < every * 0.7
    assert scanned(rows.where(compile_filter("AF[0] > 0.9", schema)).select("id")) == 0


def test_columns(spark, store):
    path, _, records = store
    rows = typed.read_store(spark, path)
    assert {"number_AF", "first_AF", "list_AF", "has_AF", "text_TAG", "text_DB"} <= set(rows.columns)
    types = dict(rows.dtypes)
    assert types["list_AF"] == "array<double>" and types["text_DB"] == "boolean" and types["list_dbNSFP_gnomAD4_1_joint_AC"] == "array<bigint>"
    lines = lambda r: sorted(x.value for x in vcf.write_vcf_lines(r).collect())
    assert lines(typed.records_of(rows)) == lines(records)
    assert rows.where("id = 'r3'").select(F.sort_array(F.map_keys("info"))[0]).first()[0] is not None


def test_run_over_a_store(spark, tmp_path):
    text = HEAD + "".join(line(100 + 50 * i, 0.001 if i % 3 else 0.2, "HIGH", f"G{i % 2}", "0/1", "0/0", "0/1") for i in range(12))
    (tmp_path / "a.vcf").write_text(text)
    raw = vcf.lines(spark, str(tmp_path / "a.vcf"))
    head = [x for x in text.split("\n") if x.startswith("#")]
    typed.write_store(vcf.parsed(raw), vcf.header_fields(raw), head, str(tmp_path / "store"))
    chrom = text.strip().split("\n")[-1].split("\t")[0]
    (tmp_path / "genes.bed").write_text(f"{chrom}\t0\t420\tG1\n")
    kept = []
    for source in ("a.vcf", "store"):
        for more in ({}, {"genes": "G1", "gene_regions": str(tmp_path / "genes.bed")}, {"late_filter": True}):
            found = analysis.analyse(spark, analysis.Settings(vcf=str(tmp_path / source), filter="AF < 0.01", **more))
            kept.append((sorted(tuple(map(str, r)) for r in found.variants.collect()), sorted(map(str, found.calls.collect()))))
    assert kept[:3] == kept[3:] and kept[0][0] and len(kept[1][0]) < len(kept[0][0])
