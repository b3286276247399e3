"""Steps of a run lie in buckets of the variant: what follows takes their rows as they lie, in this session and in the next."""

import re

import pytest
from pyspark.sql import functions as F

from helicase.operators import annotate, inheritance
from helicase.plans import analysis
from helicase.plans.steps import Steps
from helicase.sources import tables
from helicase.sources.store import materialised
from test_analysis import HEAD, line


def exchanges(df):
    """Keys by which the plan deals rows anew."""
    return re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def plain_joins(spark):
    """Tables of a test are small enough to be broadcast; those of a run are not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_joins_and_sums_by_variant_deal_nothing_anew(spark, tmp_path, plain_joins):
    steps = Steps(spark, str(tmp_path / "it's work"), {"a": 1}, buckets=5)
    calls = steps.step("calls", lambda: spark.range(4000).select((F.col("id") % 700).alias("variant_id"), F.col("id").alias("sample_id"), F.lit(1).alias("dosage")), key="variant_id")
    rows = steps.step("fields", lambda: spark.range(700).select(F.col("id").alias("variant_id"), F.lit("G").alias("gene")), key="variant_id")
    joined = rows.join(calls.groupBy("variant_id").agg(F.sum("dosage").alias("n")), "variant_id", "left")
    assert joined.agg(F.sum("n")).first()[0] == 4000 and exchanges(joined) == []
    assert exchanges(calls.join(rows, "variant_id")) == []
    again = Steps(spark, str(tmp_path / "it's work"), {"a": 1}, buckets=5)
    # another session's catalogue knows no tables
    for name in ("calls", "fields"):
        spark.sql(f"DROP TABLE {again._called(name)}")
    found = again.step("calls", None, key="variant_id"), again.step("fields", None, key="variant_id")
    assert [s for _, s in again.done] == ["found", "found"]
    assert found[0].count() == 4000 and exchanges(found[0].join(found[1], "variant_id")) == []
    other = Steps(spark, str(tmp_path / "it's work"), {"a": 1}, buckets=3)
    made = other.step("calls", lambda: found[0].sparkSession.range(7).select(F.col("id").alias("variant_id")), key="variant_id")
    assert other.done == [("calls", "made")] and made.count() == 7


def test_the_run_deals_calls_by_variant_once(spark, tmp_path, plain_joins):
    text = HEAD + "".join(line(100 + 50 * i, 0.001, "HIGH", f"G{i % 2}", "0/1", "0/0", "0/1" if i % 3 else "1/1") for i in range(12))
    (tmp_path / "a.vcf").write_text(text)
    (tmp_path / "f.ped").write_text("F C F M 1 2\nF F 0 0 1 1\nF M 0 0 2 1\n")
    settings = analysis.Settings(vcf=str(tmp_path / "a.vcf"), pedigree=str(tmp_path / "f.ped"), work=str(tmp_path / "work"), buckets=3)
    found = analysis.analyse(spark, settings)
    rows, calls = (Steps(spark, str(tmp_path / "work"), buckets=3)._table(n, f"{tmp_path}/work/{n}", "variant_id") for n in ("fields", "calls"))
    packed = rows.select("variant_id", "gene").join(annotate.packed(calls), "variant_id", "left")
    assert not [k for k in exchanges(packed) if k.startswith("variant_id")]
    ped = tables.read_ped(spark, settings.pedigree).withColumn("affected", F.col("affected_status") == "2")
    fam = materialised(inheritance.family(ped, spark.createDataFrame([("C", 0), ("F", 1), ("M", 2)], "sample_id string, place int")), "family")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
    known = inheritance.trios(calls, fam)
    assert not [k for k in exchanges(known) if "variant_id" in k]
    assert found.variants.count() == 12 and set(r.state for r in found.steps.status().collect()) == {"made"}
    again = analysis.analyse(spark, settings)
    assert set(r.state for r in again.steps.status().collect()) == {"found"}
    assert sorted(map(str, again.variants.collect())) == sorted(map(str, found.variants.collect()))
