"""Single variants in small families, by the readable rules."""

import pytest

from helicase.operators import inheritance

SCHEMA = "sample_id string, father_id string, mother_id string, sex string, affected boolean, place int"
TRIO = [("c", "f", "m", "1", True, 0), ("f", "0", "0", "1", False, 1), ("m", "0", "0", "2", False, 2)]


def run(spark, pedigree, carriers, chrom="1"):
    fam = inheritance.family(spark.createDataFrame(pedigree, SCHEMA), spark.createDataFrame([(p[0], p[5]) for p in pedigree], "sample_id string, place int"))
    calls = spark.createDataFrame([(1, "G", s, d) for s, d in carriers.items()], "variant_id bigint, gene string, sample_id string, dosage int")
    variants = spark.createDataFrame([(1, chrom)], "variant_id bigint, chrom string")
    return calls, variants, fam


@pytest.mark.parametrize(
    ("carriers", "chrom", "affected", "expected"),
    [
        ({"c": 1}, "1", {}, ["de_novo"]),
        ({"c": 1, "f": None}, "1", {}, ["de_novo_candidate", "autosomal_dominant_possible"]),
        ({"c": 1, "f": 1}, "1", {"f"}, ["autosomal_dominant", "unknown"]),
        ({"c": 1, "f": 1}, "1", {}, ["autosomal_dominant_possible", "carrier"]),
        ({"c": 2, "f": 1, "m": 1}, "1", {}, ["autosomal_dominant_possible", "autosomal_recessive", "carrier"]),
        ({"c": 2, "f": 1, "m": None}, "1", {}, ["de_novo_candidate", "autosomal_dominant_possible", "autosomal_recessive_possible", "carrier"]),
        ({"c": 1, "m": 1}, "X", {}, ["autosomal_dominant_possible", "x_linked_recessive", "x_linked_dominant_possible", "carrier"]),
        ({"c": 1, "m": 1}, "X", {"m"}, ["autosomal_dominant", "x_linked_recessive", "x_linked_dominant", "unknown"]),
        ({"c": 1, "m": 1}, "MT", {}, ["autosomal_dominant_possible", "mitochondrial"]),
        ({"f": 1}, "1", {}, ["carrier"]),
    ],
)
def test_patterns(spark, carriers, chrom, affected, expected):
    pedigree = [(*p[:4], p[0] == "c" or p[0] in affected, p[5]) for p in TRIO]
    calls, variants, fam = run(spark, pedigree, carriers, chrom)
    found = inheritance.patterns(calls, variants, fam).first().patterns
    assert sorted(found) == sorted(expected)
    assert found[0] == expected[0]


def test_segregation_counts_absent_calls(spark):
    calls, variants, fam = run(spark, TRIO, {"c": 1})
    row = inheritance.segregation(calls, variants, fam).first()
    assert (row.seg_de_novo, row.conf_de_novo) == (True, 1.0)
    assert (row.seg_autosomal_dominant, row.conf_autosomal_dominant) == (True, 1.0)
    assert (row.seg_autosomal_recessive, row.conf_autosomal_recessive) == (False, 0.0)
    assert (row.seg_compound_heterozygous, row.conf_compound_heterozygous) == (True, 1.0)
    assert (row.seg_mitochondrial, row.conf_mitochondrial) == (True, 1.0)


def test_segregation_skips_missing(spark):
    calls, variants, fam = run(spark, TRIO, {"c": 1, "f": None})
    row = inheritance.segregation(calls, variants, fam).first()
    assert (row.seg_de_novo, row.conf_de_novo) == (True, 0.5)


def test_compound_heterozygous(spark):
    fam = run(spark, TRIO, {"c": 1})[2]
    data = [(1, "G", "c", 1), (1, "G", "f", 1), (2, "G", "c", 1), (2, "G", "m", 1), (3, "G", "c", 1), (3, "G", "f", 1), (4, "H", "c", 1)]
    calls = spark.createDataFrame(data, "variant_id bigint, gene string, sample_id string, dosage int")
    found = {r.variant_id: (r.type, r.partners) for r in inheritance.compound_hets(calls, fam).collect()}
    assert found == {1: ("compound_heterozygous", [2]), 2: ("compound_heterozygous", [1, 3]), 3: ("compound_heterozygous", [2])}


def test_priority_and_confidence(spark):
    df = spark.createDataFrame([(1, ["carrier", "autosomal_dominant"]), (2, ["de_novo"]), (3, [])], "variant_id bigint, patterns array<string>")
    found = {r.variant_id: (r.pattern, r.confidence) for r in inheritance.prioritised(df).collect()}
    assert found == {1: ("autosomal_dominant", 0.72), 2: ("de_novo", 1.0), 3: ("unknown", 0.0)}


def test_unlisted_samples_are_affected_founders(spark):
    fam = inheritance.family(spark.createDataFrame(TRIO[:1], SCHEMA), spark.createDataFrame([("c", 0), ("z", 1)], "sample_id string, place int"))
    rows = {r.sample_id: r for r in fam.collect()}
    assert rows["z"].affected
    assert not rows["c"].father_in


@pytest.mark.parametrize("chrom", ["1", "X", "MT"])
def test_columns_equal_plain_rules(spark, chrom):
    """Random families with missing calls, absent parents and single samples: every variant's patterns."""
    import random

    from helicase.functions.pedigree import MISSING, Child, patterns_of

    rnd = random.Random(ord(chrom[0]))
    people = [f"s{i}" for i in range(9)]
    parents = {"s0": ("s1", "s2"), "s3": ("s1", "0"), "s4": ("x", "s2"), "s5": ("s6", "s7")}
    ped = [("F", p, *parents.get(p, ("0", "0")), rnd.choice("012"), rnd.random() < 0.6) for p in people[:8]]
    fam = inheritance.family(spark.createDataFrame(ped, "family_id string, sample_id string, father_id string, mother_id string, sex string, affected boolean"), spark.createDataFrame([(p, i) for i, p in enumerate(people)], "sample_id string, place int"))
    by = {p[1]: p for p in ped} | {"s8": ("F", "s8", "0", "0", "0", True)}
    calls, expected = [], {}
    for v in range(250):
        d = {p: rnd.choice([0, 0, 1, 1, 2, MISSING]) for p in people}
        calls += [(v, "G", p, None if x == MISSING else x) for p, x in d.items() if x]
        kids = []
        for p in people:
            _, _, f, m, sex, affected = by[p]
            kids.append(Child(d[p], d.get(f), d.get(m), sex, affected, by[f][5] if f in by else False, by[m][5] if m in by else False))
        if any(k.dosage > 0 for k in kids):
            expected[v] = patterns_of(kids, chrom)
    df = spark.createDataFrame(calls, "variant_id int, gene string, sample_id string, dosage int")
    variants = spark.createDataFrame([(v, chrom) for v in range(250)], "variant_id int, chrom string")
    assert {r.variant_id: r.patterns for r in inheritance.patterns(df, variants, fam).collect()} == expected
