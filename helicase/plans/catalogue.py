"""Queries by name: each applies one operator of the engine to the mapped tables; SQL says the same for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.functions import genotype, text, weights
from helicase.operators import annotate, association, burden, correction, genetests, identifiers, inheritance, intervals, report, scoring, statistics
from helicase.plans import adapter as a
from helicase.plans.filterlang import Schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, base: bool = True) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL after the mapping's."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = a.SQL + sql if base else sql
        return f

    return add


def r6(c: Column | str, name: str | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = F.round(c.cast("double"), 6)
    return out.alias(name) if name else out


# filters


def variant_schema() -> Schema:
    return Schema(
        {"FILTER": F.col("filter"), "QUAL": F.col("cadd"), "CADD": F.col("cadd"), "AF": F.col("af"), "ID": F.col("p_name"), "EFFECT": F.col("effect")},
        {("ANN", "IMPACT"): F.array("impact", F.lit("MODIFIER")), ("dbNSFP_gnomAD_exomes_AF", None): F.array("af"), ("dbNSFP_gnomAD_exomes_AC", None): F.array("ac"), ("dbNSFP_gnomAD_genomes_AF", None): F.array(F.col("revel") / 100), ("dbNSFP_gnomAD_genomes_AC", None): F.array(F.when(F.col("variant_id") % 3 != 0, "1"))},
    )


@query("SELECT variant_id, gene, impact FROM variants WHERE impact IN ('HIGH', 'MODERATE') AND (af < 0.001 OR ac IS NULL) AND (revel / 100 < 0.001 OR variant_id % 3 = 0) AND filter = 'PASS' AND cadd >= 10")
def filter_preset_high_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.preset_filter(a.variants(spark, sf_dir), variant_schema(), ["coding", "1percent", "pass"], "CADD >= 10")
    return rows.select("variant_id", "gene", "impact")


ANNOTATED = """, annotated AS (SELECT *, variant_id AS k, CASE WHEN variant_id % 11 <> 0 THEN af END AS ex_af, ac::DOUBLE AS ex_ac, ((variant_id * 37) % 1000)::DOUBLE / 10000.0::DOUBLE AS ge_af, CASE WHEN variant_id % 6 <> 0 THEN (variant_id % 4)::DOUBLE END AS ge_ac,
 CASE variant_id % 5 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Benign' WHEN 2 THEN 'Conflicting_pathogenic' WHEN 3 THEN 'likely_pathogenic' ELSE '.' END AS sig1, CASE variant_id % 4 WHEN 1 THEN 'benign' WHEN 2 THEN 'Pathogenic' WHEN 3 THEN 'Conflicting' END AS sig2,
 (variant_id % 7 - 4)::DOUBLE AS spidex, (variant_id % 10)::DOUBLE / 10.0::DOUBLE AS ada, (variant_id % 8)::DOUBLE / 8.0::DOUBLE AS rf, variant_id % 9 = 0 AS lof, variant_id % 13 = 0 AS nmd,
 30 + variant_id % 50 AS dp0, 20 + variant_id % 60 AS dp1, (variant_id % 100)::DOUBLE / 100.0::DOUBLE AS af0, CASE WHEN variant_id % 8 <> 0 THEN (variant_id % 97)::DOUBLE / 100.0::DOUBLE END AS af1, variant_id % 3 = 0 AS het0, variant_id % 2 = 0 AS hom1, variant_id % 10 = 0 AS cosmic FROM variants)"""


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """variants with the annotation that the presets read: frequencies, significance, predictions, two samples' values."""
    k = F.col("variant_id")
    words = lambda n, *w: F.get(F.lit([*w]), (k % n).cast("int"))
    text_of = lambda c: c.cast("string")
    return a.variants(spark, sf_dir).withColumns({
        "ex_af": F.array(F.when(k % 11 != 0, text_of(F.col("af")))), "ex_ac": F.array("ac"), "ge_af": F.array(text_of((k * 37) % 1000 / 10000.0)), "ge_ac": F.array(F.when(k % 6 != 0, text_of(k % 4)).otherwise(".")),
        "sig1": words(5, "Pathogenic", "Benign", "Conflicting_pathogenic", "likely_pathogenic", "."), "sig2": F.when(k % 4 != 0, words(4, "", "benign", "Pathogenic", "Conflicting")),
        "spidex": k % 7 - 4.0, "ada": k % 10 / 10.0, "rf": k % 8 / 8.0, "lof": F.when(k % 9 == 0, F.array(F.lit("0.1"), F.lit("0.95"))).when(k % 9 == 1, F.array(F.lit("0.5"))),
        "nmd": F.when(k % 13 == 0, F.array(F.lit("0.91"))), "dp": F.array(text_of(30 + k % 50), text_of(20 + k % 60)), "gaf": F.array(text_of(k % 100 / 100.0), F.when(k % 8 != 0, text_of(k % 97 / 100.0)).otherwise(".")),
        "gts": F.array(F.when(k % 3 == 0, "0/1").otherwise("0/0"), F.when(k % 2 == 0, "1/1").otherwise("0/1")), "known": F.when(k % 10 == 0, "COSV1").when(k % 10 < 5, ".").otherwise("rs1"),
    })


def annotated_schema() -> Schema:
    scalars = {"FILTER": "filter", "ID": "known", "dbNSFP_clinvar_clnsig": "sig1", "ClinVar_CLNSIG": "sig2", "dbNSFP_REVEL_score": "revel", "dbNSFP_CADD_phred": "cadd", "splice_spidex_dpsi_zscore": "spidex", "splice_dbscSNV_ada_score": "ada", "splice_dbscSNV_rf_score": "rf"}
    freq = {("dbNSFP_gnomAD_exomes_AF", None): "ex_af", ("dbNSFP_gnomAD_exomes_AC", None): "ex_ac", ("dbNSFP_gnomAD_genomes_AF", None): "ge_af", ("dbNSFP_gnomAD_genomes_AC", None): "ge_ac", ("dbNSFP_gnomAD4.1_joint_AF", None): "ge_af", ("dbNSFP_gnomAD4.1_joint_AC", None): "ge_ac"}
    own = {("GEN", "DP"): "dp", ("GEN", "AF"): "gaf", ("GEN", "GT"): "gts", ("LOF", "PERC"): "lof", ("NMD", "PERC"): "nmd"}
    arrays = {k: F.col(c) for k, c in (freq | own).items()}
    arrays |= {("ANN", "IMPACT"): F.array("impact", F.lit("x")), ("AC", None): F.array(F.col("variant_id") % 1000), ("QUAL", None): F.array(F.col("cadd") * 5)}
    return Schema({k: F.col(c) for k, c in scalars.items()}, arrays)


def _preset_rules() -> dict[str, str]:
    """What each preset asks, in SQL over ANNOTATED."""
    below = lambda x: f"((coalesce(ex_af < {x}, FALSE) OR ex_ac IS NULL) AND (ge_af < {x} OR ge_ac IS NULL))"
    either = lambda x: f"(coalesce(ex_af < {x}, FALSE) OR ex_ac IS NULL OR ge_af < {x} OR ge_ac IS NULL)"
    few = "((ex_ac IS NULL OR ex_ac <= 2) AND (ge_ac IS NULL OR ge_ac <= 2))"
    bad = "(variant_id % 5 IN (0, 3) OR variant_id % 4 = 2)"
    splice = "(spidex <= -2 AND (ada >= 0.6 OR rf >= 0.6))"
    passed = "(filter IS NULL OR filter = 'PASS')"
    predicted = "(revel >= 0.9 OR cadd >= 30)"
    broken = "(lof OR nmd OR impact = 'HIGH')"
    deep, quiet, seen = "dp0 >= 20 AND dp1 >= 20", "coalesce(af0 < 0.03, TRUE)", "coalesce(af1 >= 0.05, FALSE)"
    return {
        "pass": "filter = 'PASS'", "not_artefact": "variant_id % 1000 <= 513 AND cadd * 5 >= 100", "not_benign": "variant_id % 5 <> 1 AND variant_id % 4 <> 1", "5percent_or_pathogenic": f"{either(0.05)} OR {bad}",
        "5percent": below(0.05), "1percent": below(0.001), "rare": below(0.0001), "super_rare": few, "pathogenic": bad, "coding": "impact IN ('HIGH', 'MODERATE')", "high": "impact = 'HIGH'", "moderate": "impact = 'MODERATE'",
        "moderate_and_high_prediction": f"impact = 'MODERATE' AND {predicted}", "high_splice_prediction": f"impact = 'MODERATE' AND {splice}", "low": "impact = 'LOW'", "high_or_moderate": "impact IN ('HIGH', 'MODERATE')",
        "high_or_moderate_or_low": "impact <> 'MODIFIER'", "high_or_moderate_or_high_splice_prediction": f"impact IN ('HIGH', 'MODERATE') OR {splice}", "high_or_moderate_or_high_splice_prediction_or_high_prediction": f"impact IN ('HIGH', 'MODERATE') OR {splice} OR {predicted}",
        "modifier": "impact = 'MODIFIER'", "high_or_lof_or_nmd": broken, "high_or_pathogenic": f"impact = 'HIGH' OR {bad}",
        "aif": f"({either(0.05)} OR {bad}) AND ({bad} OR {either(0.01)} AND ({splice} OR (impact = 'MODERATE' AND {predicted}) OR {broken}))",
        "mutect2_TvsN_pass": f"({few} OR cosmic) AND {passed} AND dp0 >= 50 AND coalesce(af1 < 0.03, TRUE) AND af0 >= 0.05", "mutect2_TvsN": f"({few} OR cosmic) AND (dp0 >= 50 OR dp1 >= 50) AND coalesce(af1 < 0.03, TRUE) AND af0 >= 0.05",
        "mutect2_To_pass": f"({few} OR cosmic) AND {passed} AND (dp0 >= 50 OR dp1 >= 50) AND af0 >= 0.05", "somatic": f"{few} AND {deep} AND {quiet} AND {seen}", "somatic_pass": f"{few} AND {passed} AND {deep} AND {quiet} AND {seen}",
        "somatic_strict": f"{few} AND {passed} AND dp0 >= 50 AND dp1 >= 50 AND coalesce(af0 < 0.01, TRUE) AND {seen}", "loh": f"het0 AND (hom1 OR coalesce(af1 >= 0.85, FALSE)) AND {deep}", "germline_shared": f"af0 >= 0.2 AND coalesce(af1 >= 0.2, FALSE) AND {deep}",
        "tumor_only": f"{few} AND {passed} AND dp1 >= 20 AND {seen}",
    }


@query(ANNOTATED + " SELECT variant_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _preset_rules().items()) + "], lambda x: x IS NOT NULL), ',') AS presets FROM annotated")
def filter_presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helicase.plans.filterlang import PRESETS, compile_filter, composed

    hit = [F.when(compile_filter(composed([name]), annotated_schema()), name) for name in PRESETS]
    return annotated(spark, sf_dir).select("variant_id", F.array_join(F.array_compact(F.array(*hit)), ",").alias("presets"))


@query(ANNOTATED + " SELECT variant_id, (ge_af < 0.05 OR ge_ac IS NULL) AND dp0 >= 40 AND dp1 >= 30 AND coalesce(af1 < 0.1, TRUE) AND af0 >= 0.2 AS kept FROM annotated")
def filter_profile_and_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other annotation release, and a pair of samples the other way round."""
    from helicase.plans.filterlang import PRESETS, compile_filter, composed

    known = PRESETS | {"own": "(GEN[{normal_idx}].DP >= {normal_dp_min}) & (GEN[{tumor_idx}].DP >= {tumor_dp_min}) & ((GEN[{normal_idx}].AF < {normal_af_max}) | (na GEN[{normal_idx}].AF)) & (GEN[{tumor_idx}].AF >= {tumor_af_min})"}
    pair = {"tumor_idx": 0, "normal_idx": 1, "tumor_dp_min": 40, "normal_dp_min": 30, "tumor_af_min": 0.2, "normal_af_max": 0.1}
    text = composed(["5percent", "own"], None, "dbnsfp5", known, pair)
    return annotated(spark, sf_dir).select("variant_id", compile_filter(text, annotated_schema()).alias("kept"))


@query("SELECT variant_id, impact FROM variants WHERE NOT (coalesce(filter, '') = 'q10') AND (regexp_matches(p_name, '^(red|blue)') OR (effect = 'stop_gained' AND af <= 0.01)) AND filter IS NOT NULL")
def filter_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helicase.plans.filterlang import compile_filter

    test = compile_filter("!(FILTER = 'q10') & ((ID =~ '^(red|blue)') | ((EFFECT has 'stop_gained') & (AF <= 0.01))) & (exists FILTER)", variant_schema())
    return a.variants(spark, sf_dir).where(test).select("variant_id", "impact")


@query("SELECT variant_id, CAST(event_count AS BIGINT) AS event_count FROM (SELECT user_id AS variant_id, count(*) AS event_count FROM events WHERE try_cast(json_extract_string(props, '$.k') AS DOUBLE) > 50 AND event_type <> 'error' GROUP BY user_id)")
def final_filter_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    rows = scoring.final_filter(rows, "k > 50 and event_type != 'error'")
    return rows.groupBy(F.col("user_id").alias("variant_id")).agg(F.count("*").alias("event_count"))


@query("""SELECT variant_id, gene, sample_id, CASE WHEN dosage = 2 THEN 'hom' ELSE 'comphet' END AS reason FROM (
  SELECT *, count(*) FILTER (WHERE dosage = 1) OVER (PARTITION BY gene, sample_id) AS hets FROM calls) WHERE dosage = 2 OR (dosage = 1 AND hets >= 2)""")
def genotype_filter_comphet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate.genotype_filter(a.calls(spark, sf_dir), F.array(F.lit("hom"), F.lit("comp_het")))
    return rows.select("variant_id", "gene", "sample_id", F.array_join("reasons", ",").alias("reason"))


@query("""SELECT variant_id, gene, sample_id, CASE WHEN substr(gene, 7, 1) = '1' THEN 'hom' WHEN substr(gene, 7, 1) = '2' THEN '' ELSE 'het' END AS reason FROM calls
 WHERE CASE WHEN substr(gene, 7, 1) = '1' THEN dosage = 2 WHEN substr(gene, 7, 1) = '2' THEN TRUE ELSE dosage = 1 END""")
def genotype_filter_by_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes with rules of their own, and others: two filters side by side, and genes that no rule touches."""
    calls = a.calls(spark, sf_dir)
    rules = calls.select("gene").distinct().select("gene", F.when(F.substring("gene", 7, 1) == "1", F.array(F.lit("hom"))).when(F.substring("gene", 7, 1) != "2", F.array(F.lit("het"))).alias("modes"))
    rows = annotate.modes_by_gene(calls, rules.where("modes IS NOT NULL"), [])
    return rows.select("variant_id", "gene", "sample_id", F.array_join("reasons", ",").alias("reason"))


@query(", n AS (SELECT count(*) FILTER (WHERE is_case) AS n1, count(*) FILTER (WHERE NOT is_case) AS n0 FROM samples), g AS (SELECT gene, count(DISTINCT c.sample_id) FILTER (WHERE is_case)::DOUBLE AS a, count(DISTINCT c.sample_id) FILTER (WHERE NOT is_case)::DOUBLE AS b FROM calls c JOIN samples s ON s.sample_id = c.sample_id GROUP BY gene),"
 " t AS (SELECT gene, CASE WHEN a = 0 OR b = 0 OR a = n1 OR b = n0 THEN 0.5 ELSE 0 END::DOUBLE AS h, a, b, n1 - a AS c, n0 - b AS d FROM g, n), u AS (SELECT gene, a + h AS a, (a + h) + (b + h) AS r, (a + h) + (c + h) AS k, a + b + c + d + 4 * h AS n, a + b > 0 AND c + d > 0 AS there FROM t),"
 " r AS (SELECT *, greatest(0, r + k - n) AS l1, a AS h1, a AS l2, least(r, k) AS h2, 0 AS it FROM u UNION ALL SELECT gene, a, r, k, n, there, CASE WHEN f1 > 1.959963984540054 THEN m1 ELSE l1 END, CASE WHEN f1 > 1.959963984540054 THEN h1 ELSE m1 END, CASE WHEN f2 > -1.959963984540054 THEN m2 ELSE l2 END, CASE WHEN f2 > -1.959963984540054 THEN h2 ELSE m2 END, it + 1 FROM ("
 "SELECT *, (a - m1) * sqrt(1 / m1 + 1 / (r - m1) + 1 / (k - m1) + 1 / (n - r - k + m1)) AS f1, (a - m2) * sqrt(1 / m2 + 1 / (r - m2) + 1 / (k - m2) + 1 / (n - r - k + m2)) AS f2 FROM (SELECT *, (l1 + h1) / 2 AS m1, (l2 + h2) / 2 AS m2 FROM r WHERE it < 60)))"
 " SELECT gene, CASE WHEN there THEN round((l1 + h1) / 2 * (n - r - k + (l1 + h1) / 2) / ((r - (l1 + h1) / 2) * (k - (l1 + h1) / 2)), 5) END AS lower, CASE WHEN there THEN round((l2 + h2) / 2 * (n - r - k + (l2 + h2) / 2) / ((r - (l2 + h2) / 2) * (k - (l2 + h2) / 2)), 5) END AS upper FROM r WHERE it = 60")
def score_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odds ratios' intervals from score tests."""
    rows = burden.fourfold(a.calls(spark, sf_dir), a.cohort(spark, sf_dir), "samples")
    _, low, high = burden.odds(F.col("a"), F.col("b"), F.col("c"), F.col("d"), burden.Interval("score"))
    return rows.select("gene", F.round(low, 5).alias("lower"), F.round(high, 5).alias("upper"))


KERNEL = """, n AS (SELECT avg(is_case::INT::DOUBLE) AS mu, count(*)::DOUBLE AS n FROM samples), s AS (SELECT sample_id, is_case::INT::DOUBLE - mu AS r, mu * (1 - mu) AS v FROM samples, n),
 c AS (SELECT gene, variant_id, c.sample_id, dosage::DOUBLE AS d, r, v FROM calls c JOIN s ON s.sample_id = c.sample_id)"""


@query(KERNEL + " SELECT x.gene, x.variant_id AS a, y.variant_id AS b, round(sum(x.d * y.d * x.v), 6) AS product, CASE WHEN x.variant_id = y.variant_id THEN round(sum(x.d * x.r), 6) END AS score FROM c x JOIN c y ON x.gene = y.gene AND x.sample_id = y.sample_id AND x.variant_id <= y.variant_id GROUP BY x.gene, x.variant_id, y.variant_id")
def kernel_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and products of variants, of every gene and every pair that a sample carries."""
    carried, cohort = _carried(spark, sf_dir)
    return genetests.kernel_sums(carried, cohort, _cohort_null(spark, cohort)).select("gene", "a", "b", r6("product", "product"), r6("score", "score"))


@query(KERNEL + ", u AS (SELECT gene, variant_id, sum(d * r) AS score FROM c GROUP BY gene, variant_id) SELECT gene, round(sum(score * score) / 2, 6) AS q, count(*)::BIGINT AS n_variants FROM u GROUP BY gene")
def skat_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKAT's Q of every gene with weights of one."""
    carried, cohort = _carried(spark, sf_dir)
    rows = genetests.kernel_sums(carried, cohort, _cohort_null(spark, cohort)).where("a = b")
    return rows.groupBy("gene").agg(r6(F.sum(F.col("score") * F.col("score")) / 2, "q"), F.count("*").alias("n_variants"))


def _carried(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, genetests.Cohort]:
    cohort = genetests.Cohort.of(a.cohort(spark, sf_dir).select("sample_id", F.col("is_case").cast("double").alias("y")))
    rows = a.calls(spark, sf_dir).withColumns({"weight": F.lit(1.0), "category": F.lit(0), "masked": F.lit(False)})
    return genetests.carriers(rows), cohort


def _cohort_null(spark: SparkSession, cohort: genetests.Cohort) -> DataFrame:
    import math

    share = cohort.n_case / cohort.n
    return spark.createDataFrame([(None, [math.log(share / (1 - share))], [cohort.n * share * (1 - share)], 1.0, 0)], "gene string, beta array<double>, info array<double>, variance double, n_masked int")


@query(", b AS (SELECT gene, sample_id, sum(dosage)::DOUBLE AS b FROM calls GROUP BY gene, sample_id), full_b AS (SELECT g.gene, s.s_acctbal::DOUBLE / 1000 AS y, coalesce(b.b, 0) AS b FROM (SELECT gene FROM calls GROUP BY gene HAVING sum(dosage) >= 5) g CROSS JOIN samples s LEFT JOIN b ON b.gene = g.gene AND b.sample_id = s.sample_id)"
 " SELECT gene, count(*)::BIGINT AS n_samples, CASE WHEN regr_sxx(y, b) > 0 THEN round(regr_slope(y, b) + 0.00000123, 5) END AS effect FROM full_b GROUP BY gene")
def quantitative_trait(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quantitative trait through the engine that a run uses."""
    who = a.samples(spark, sf_dir).select("sample_id", (F.col("s_acctbal").cast("double") / 1000).alias("value"))
    plan = association.Plan(binary=False, weights="uniform")
    return association.run_all(a.calls(spark, sf_dir), who, ["linear_burden"], plan=plan).select("gene", "n_samples", F.round(F.col("linear_burden_effect") + 0.00000123, 5).alias("effect"))  # off ties


# scalars and projections


@query("""SELECT variant_id, effect AS "EFFECT", impact AS "IMPACT", gene AS "GENE", (p_size)::VARCHAR AS "AA_POS", '500' AS "AA_LEN", CASE WHEN p_size % 5 = 0 THEN 'NA' ELSE 'p.Arg' || p_size || 'Trp' END AS "HGVS_P", 'NA' AS "ERRORS" FROM variants""")
def ann_subfields(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.variants(spark, sf_dir)
    hgvs = F.when(F.col("p_size") % 5 == 0, "").otherwise(F.concat(F.lit("p.Arg"), F.col("p_size").cast("string"), F.lit("Trp")))
    blank = F.lit("")
    parts = ["alt", "effect", "impact", "gene", blank, blank, blank, blank, blank, blank, hgvs, blank, blank, F.concat(F.col("p_size").cast("string"), F.lit("/500")), blank]
    ann = F.concat(F.concat_ws("|", *parts), F.lit(",A|x|y|z"))
    return v.withColumn("ANN", ann).select("variant_id", *(text.ann_subfield(F.col("ANN"), n).alias(n) for n in ("EFFECT", "IMPACT", "GENE", "AA_POS", "AA_LEN", "HGVS_P", "ERRORS")))


@query("SELECT variant_id, unnest(string_split(effect || ',' || p_type || ',' || p_brand, ',')) AS entry FROM variants")
def transcript_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helicase.sources.vcf import one_effect_per_row

    v = a.variants(spark, sf_dir).withColumn("info", F.create_map(F.lit("ANN"), F.concat_ws(",", "effect", "p_type", "p_brand"), F.lit("AC"), F.lit("1")))
    return one_effect_per_row(v).select("variant_id", F.element_at("info", F.lit("ANN")).alias("entry"))


PACKED = ", packed AS (SELECT variant_id, string_agg(sample_id || '(' || gt || ')', ';' ORDER BY sample_id) AS \"GT\" FROM calls GROUP BY variant_id) "


@query(PACKED + 'SELECT variant_id, "GT" FROM packed')
def pack_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.packed(a.all_calls(spark, sf_dir))


@query("SELECT variant_id, sample_id, gt FROM calls")
def unpack_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.unpacked(annotate.packed(a.all_calls(spark, sf_dir)))


@query("""SELECT variant_id, 'var_' || CASE WHEN n < 10000 THEN lpad(n::VARCHAR, 4, '0') ELSE n::VARCHAR END || '_' || substr(md5(chrom || pos || ref || alt), 1, 4) AS "VAR_ID"
  FROM (SELECT *, row_number() OVER (ORDER BY chrom, pos, ref, alt) AS n FROM variants)""")
def variant_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.variant_ids(a.variants(spark, sf_dir)).select("variant_id", "VAR_ID")


@query("SELECT variant_id, 'https://example.org/v/' || chrom || '-' || pos || '-' || ref || '-' || alt AS \"Browser\", '' AS \"Missing\" FROM variants")
def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = {"Missing": "https://example.org/{nothing}", "Browser": "https://example.org/v/{chrom}-{pos}-{ref}-{alt}"}
    return identifiers.links(a.variants(spark, sf_dir), templates).select("variant_id", "Browser", "Missing")


@query("""SELECT l_partkey AS variant_id, l_suppkey, CASE WHEN q > 48 THEN 'hom_alt' WHEN q > 44 THEN 'het' WHEN q > 40 THEN 'missing' ELSE 'ref' END AS kind,
  CASE WHEN q > 48 THEN 2 WHEN q > 44 THEN 1 WHEN q > 42 THEN NULL WHEN q > 40 THEN 1 ELSE 0 END AS dosage, CASE WHEN q > 48 THEN 2 WHEN q > 44 THEN 1 WHEN q > 40 THEN -1 ELSE 0 END AS code, q > 44 AND q <= 48 AS phased, q > 42 AND q <= 44 AS missing, q > 40 AND q <= 42 AS multi
  FROM (SELECT l_partkey, l_suppkey, max(l_quantity) AS q FROM lineitem GROUP BY ALL)""", base=False)
def genotype_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = a.table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.max("l_quantity").alias("q"))
    gt = F.when(F.col("q") > 48, "1/1").when(F.col("q") > 44, "1|0").when(F.col("q") > 42, "./1").when(F.col("q") > 40, "1/2").otherwise("0/0")
    rows = q.withColumn("gt", gt)
    g = F.col("gt")
    return rows.select(F.col("l_partkey").alias("variant_id"), "l_suppkey", genotype.genotype_type(g).alias("kind"), genotype.association_dosage(g).alias("dosage"), genotype.encoded(g).alias("code"), genotype.is_phased(g).alias("phased"), genotype.is_missing(g).alias("missing"), genotype.is_multi_allelic(g).alias("multi"))


@query("""SELECT l_orderkey, l_linenumber, c1 || '/' || c2 AS child, NOT ((c1 = f1 OR c1 = f2) AND (c2 = m1 OR c2 = m2) OR (c2 = f1 OR c2 = f2) AND (c1 = m1 OR c1 = m2)) = FALSE AS fits,
  (c1 + c2 > 0) AND f1 + f2 = 0 AND m1 + m2 = 0 AS de_novo FROM (
  SELECT l_orderkey, l_linenumber, l_partkey % 2 AS c1, l_suppkey % 2 AS c2, l_orderkey % 2 AS f1, (l_orderkey // 2) % 2 AS f2, l_linenumber % 2 AS m1, (l_linenumber // 2) % 2 AS m2 FROM lineitem)""", base=False)
def mendelian_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    bit = lambda c, by=1: (F.floor(F.col(c) / by) % 2).cast("string")
    gt = lambda p, q: F.concat(p, F.lit("/"), q)
    child, father, mother = gt(bit("l_partkey"), bit("l_suppkey")), gt(bit("l_orderkey"), bit("l_orderkey", 2)), gt(bit("l_linenumber"), bit("l_linenumber", 2))
    return a.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", child.alias("child"), genotype.is_mendelian_consistent(child, father, mother).alias("fits"), genotype.could_be_de_novo(child, father, mother).alias("de_novo"))


@query("""SELECT variant_id, CASE WHEN p_size % 9 < 6 THEN 'R' END AS ref_aa, CASE WHEN p_size % 9 < 6 THEN p_size END AS aa_pos, CASE p_size % 9 WHEN 0 THEN 'W' WHEN 1 THEN '*' WHEN 2 THEN 'H' WHEN 3 THEN '*' WHEN 4 THEN 'H' WHEN 5 THEN '*' END AS alt_aa FROM variants""")
def hgvs_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = ["p.Arg#Trp", "p.R#*", "p.(Arg#His)", "p.Arg#*", "p.(R#H)", "p.(Arg#Ter)", "p.Arg#fs", "p.Arg#Profs*45", "c.1A>G"]
    hgvs = F.replace(F.get(F.lit(forms), F.col("p_size") % 9), F.lit("#"), F.col("p_size").cast("string"))
    c = text.protein_change(F.col("h"))
    return a.variants(spark, sf_dir).withColumn("h", hgvs).select("variant_id", c["ref_aa"].alias("ref_aa"), c["aa_pos"].alias("aa_pos"), c["alt_aa"].alias("alt_aa"))


@query("SELECT sample_id, 'SAMPLE_' || lpad((row_number() OVER (ORDER BY sample_id))::VARCHAR, greatest(3, length((row_number() OVER (ORDER BY sample_id))::VARCHAR))::INT, '0') AS pseudonym FROM samples")
def pseudonym_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.sequential(a.samples(spark, sf_dir))


@query("SELECT sample_id, substr(upper(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')), 1, 10) || '_' || lpad((row_number() OVER (PARTITION BY substr(upper(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')), 1, 10) ORDER BY sample_id))::VARCHAR, 3, '0') AS pseudonym FROM samples JOIN nation ON n_nationkey = s_nationkey")
def pseudonym_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.samples(spark, sf_dir).join(a.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return identifiers.categorical(rows, "n_name")


@query("SELECT sample_id, chr((65 + i // 999)::INT) || lpad((i % 999 + 1)::VARCHAR, 3, '0') AS pseudonym FROM (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS i FROM samples)")
def pseudonym_anonymous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.anonymous(a.samples(spark, sf_dir))


@query(", n AS (SELECT sample_id, 'P' || (row_number() OVER (ORDER BY sample_id))::VARCHAR AS p FROM samples) SELECT 'FAM' || lpad((dense_rank() OVER (ORDER BY family_id))::VARCHAR, 3, '0') AS family_id, x.p AS sample_id, coalesce(y.p, father_id) AS father_id, coalesce(z.p, mother_id) AS mother_id FROM pedigree d JOIN n x ON x.sample_id = d.sample_id LEFT JOIN n y ON y.sample_id = d.father_id LEFT JOIN n z ON z.sample_id = d.mother_id")
def pseudonymised_pedigree(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = identifiers.custom(a.samples(spark, sf_dir), "P{index}")
    return identifiers.pseudonymised_pedigree(a.pedigree(spark, sf_dir), names).select("family_id", "sample_id", "father_id", "mother_id")


# joins and intervals

REGIONS = ", regions AS (SELECT (n_nationkey % 23)::VARCHAR AS chrom, n_nationkey * 3000 AS start, n_nationkey * 3000 + 40000 AS \"end\", n_name AS name FROM nation) "


def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("bigint")
    return a.table(spark, sf_dir, "nation").select((k % 23).cast("string").alias("chrom"), (k * 3000).alias("start"), (k * 3000 + 40000).alias("end"), F.col("n_name").alias("name"))


@query(REGIONS + "SELECT variant_id, string_agg('Region=' || name, ';' ORDER BY name) AS labels FROM variants v JOIN regions r ON v.chrom = r.chrom AND v.pos >= r.start AND v.pos < r.\"end\" GROUP BY variant_id")
def region_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate.region_labels(a.variants(spark, sf_dir), nation_regions(spark, sf_dir))
    return rows.select("variant_id", F.array_join("labels", ";").alias("labels"))


INTERVALS = ", iv AS (SELECT (o_custkey % 23)::VARCHAR AS chrom, o_orderkey * 10 AS start, o_orderkey * 10 + (o_custkey % 40) * 20 + 1 AS \"end\" FROM orders) "


def order_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return a.table(spark, sf_dir, "orders").select((c % 23).cast("string").alias("chrom"), (k * 10).alias("start"), (k * 10 + (c % 40) * 20 + 1).alias("end"))


MERGED = INTERVALS + """, l AS (SELECT *, CASE WHEN start > max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM iv),
 g AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM l) SELECT chrom, min(start) AS start, max("end") AS "end" FROM g GROUP BY chrom, island"""


@query(MERGED)
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.merged(order_intervals(spark, sf_dir))


@query(INTERVALS + REGIONS + 'SELECT i.chrom, greatest(i.start, r.start) AS start, least(i."end", r."end") AS "end" FROM iv i JOIN regions r ON i.chrom = r.chrom AND i.start < r."end" AND r.start < i."end"')
def interval_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.intersected(order_intervals(spark, sf_dir), nation_regions(spark, sf_dir))


@query(INTERVALS + 'SELECT chrom, greatest(start - 500, 0) AS start, "end" + 500 AS "end" FROM iv')
def interval_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.expanded(order_intervals(spark, sf_dir), 500)


@query(REGIONS + ', t AS (SELECT *, sum("end" - start) OVER () AS total, coalesce(sum("end" - start) OVER (ORDER BY chrom, start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM regions) SELECT name, least(before * 4 // total, 3)::INT AS chunk FROM t')
def interval_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.balanced(nation_regions(spark, sf_dir), 4).select("name", "chunk")


@query(""", lists AS (SELECT DISTINCT 'list' || (p_size % 3) AS list_name, CASE WHEN p_size < 12 THEN p_brand ELSE 'other' END AS gene FROM part), cells AS (SELECT variant_id, unnest([upper(p_brand), upper(p_type)]) AS gene FROM variants)
 SELECT variant_id, string_agg(DISTINCT 'InGeneList=' || list_name, ';' ORDER BY 'InGeneList=' || list_name) AS labels FROM cells c JOIN lists l ON upper(l.gene) = c.gene GROUP BY variant_id""")
def gene_list_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = a.table(spark, sf_dir, "part").select(F.concat(F.lit("list"), (F.col("p_size") % 3).cast("string")).alias("list_name"), F.when(F.col("p_size") < 12, F.col("p_brand")).otherwise("other").alias("gene")).distinct()
    v = a.variants(spark, sf_dir).select("variant_id", F.concat_ws(",", "p_brand", "p_type").alias("gene"))
    return annotate.gene_list_labels(v, lists).select("variant_id", F.array_join("labels", ";").alias("labels"))


@query(""", attrs AS (SELECT upper(p_brand) AS gene, max(p_size)::VARCHAR AS k, max(p_type) AS t FROM part GROUP BY upper(p_brand))
 SELECT variant_id, k AS largest, t AS kind FROM variants v LEFT JOIN attrs ON v.p_size % 2 = 0 AND attrs.gene = upper(v.p_brand)""")
def json_gene_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = a.table(spark, sf_dir, "part").groupBy(F.upper("p_brand").alias("gene")).agg(F.max("p_size").cast("string").alias("largest"), F.max("p_type").alias("kind"))
    raw = made.select("gene", F.to_json(F.struct("largest", "kind")).alias("j")).select("gene", F.from_json("j", "map<string,string>").alias("attributes"))
    v = a.variants(spark, sf_dir).select("variant_id", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("none").alias("gene"))
    return annotate.attribute_columns(v, raw, ["largest", "kind"]).select("variant_id", "largest", "kind")


@query(REGIONS + """, labels AS (SELECT variant_id, 'Region=' || name AS l FROM variants v JOIN regions r ON v.chrom = r.chrom AND v.pos >= r.start AND v.pos < r."end" UNION SELECT variant_id, 'InGeneList=small' FROM variants WHERE p_brand IN (SELECT CASE WHEN p_size < 3 THEN p_brand ELSE 'none' END FROM part)),
 c AS (SELECT variant_id, string_agg(l, ';' ORDER BY l) AS t FROM labels GROUP BY variant_id) SELECT v.variant_id, coalesce(t, '') AS "Custom_Annotation" FROM variants v LEFT JOIN c ON c.variant_id = v.variant_id""")
def custom_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.variants(spark, sf_dir).select("variant_id", "chrom", "pos", F.col("p_brand").alias("gene"))
    lists = a.table(spark, sf_dir, "part").select(F.lit("small").alias("list_name"), F.when(F.col("p_size") < 3, F.col("p_brand")).otherwise("none").alias("gene"))
    return annotate.custom_annotation(v, [annotate.region_labels(v, nation_regions(spark, sf_dir)), annotate.gene_list_labels(v, lists)]).select("variant_id", "Custom_Annotation")


LOOKUP = ", lookup AS (SELECT DISTINCT p_brand AS gene, p_size AS aa_pos, CASE WHEN p_partkey % 4 = 0 THEN 'R' ELSE 'K' END AS ref_aa, substr('ACDEFGHIKL', (p_partkey % 10 + 1)::INT, 1) AS alt_aa, CASE WHEN p_partkey % 3 = 0 THEN 'P' ELSE 'LP' END AS clnsig FROM part) "


def part_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    aa = F.substring(F.lit("ACDEFGHIKL"), (k % 10 + 1).cast("int"), F.lit(1))
    return a.table(spark, sf_dir, "part").select(F.col("p_brand").alias("gene"), F.col("p_size").alias("aa_pos"), F.when(k % 4 == 0, "R").otherwise("K").alias("ref_aa"), aa.alias("alt_aa"), F.when(k % 3 == 0, "P").otherwise("LP").alias("clnsig")).distinct()


@query(LOOKUP + """, hits AS (SELECT v.variant_id, l.alt_aa, l.clnsig, v.p_size FROM variants v JOIN lookup l ON l.gene = v.p_brand AND l.aa_pos = v.p_size AND l.ref_aa = 'R' AND l.alt_aa <> substr('ACDEFGHIKL', (v.variant_id % 10 + 1)::INT, 1)),
 g AS (SELECT variant_id, count(*) AS n, count(*) FILTER (WHERE clnsig = 'P') AS p, string_agg('p.R' || p_size || alt_aa || '(' || clnsig || ')', ';' ORDER BY 'p.R' || p_size || alt_aa || '(' || clnsig || ')') AS t FROM hits GROUP BY variant_id)
 SELECT v.variant_id, CASE WHEN p >= 2 THEN 'PM5_Strong' WHEN p = 1 THEN 'PM5' WHEN p = 0 THEN 'PM5_Supporting' ELSE '' END AS "PM5", coalesce(n, 0)::BIGINT AS "PM5_evidence_count", coalesce(t, '') AS "PM5_known_variants" FROM variants v LEFT JOIN g ON g.variant_id = v.variant_id""")
def pm5_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.variants(spark, sf_dir).select("variant_id", F.col("p_brand").alias("gene"), F.col("p_size").alias("aa_pos"), F.lit("R").alias("ref_aa"), F.substring(F.lit("ACDEFGHIKL"), (F.col("variant_id") % 10 + 1).cast("int"), F.lit(1)).alias("alt_aa"))
    return annotate.pm5(v, part_lookup(spark, sf_dir)).select("variant_id", "PM5", "PM5_evidence_count", "PM5_known_variants")


@query("""SELECT DISTINCT p_brand AS gene, p_size AS aa_pos, 'R' AS ref_aa, 'W' AS alt_aa, CASE p_partkey % 3 WHEN 0 THEN 'P' ELSE 'LP' END AS clnsig FROM part WHERE p_partkey % 3 < 2 AND p_size % 2 = 0""", base=False)
def pm5_lookup_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    raw = a.table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") % 2 == 0, "single nucleotide variant").otherwise("Deletion").alias("Type"), F.concat(F.lit("NM_1("), "p_brand", F.lit("):c.1A>G (p.Arg"), F.col("p_size").cast("string"), F.lit("Trp)")).alias("Name"),
        F.col("p_brand").alias("GeneSymbol"), F.when(k == 0, "Pathogenic").when(k == 1, "Likely pathogenic").otherwise("Conflicting pathogenic").alias("ClinicalSignificance"),
        F.lit("germline").alias("Origin"), F.lit("GRCh38").alias("Assembly"), F.lit("criteria provided, single submitter").alias("ReviewStatus"),
    )
    return annotate.pm5_lookup(raw).drop("review")


@query("SELECT sample_id, s_nationkey % 2 = 1 AS is_case FROM samples WHERE s_nationkey % 5 <> 0")
def cohort_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = F.when(F.col("s_nationkey") % 5 == 0, F.array(F.lit("other"))).when(F.col("s_nationkey") % 2 == 1, F.array(F.lit("kidney"), F.lit("other"))).otherwise(F.array(F.lit("healthy")))
    return burden.cohort_by_terms(a.samples(spark, sf_dir).select("sample_id", terms.alias("terms")), ["kidney"], ["healthy"])


@query("""SELECT variant_id, string_agg(c.sample_id || '(' || CASE WHEN s_nationkey % 3 = 0 THEN '' WHEN s_nationkey % 3 = 1 THEN 'HP:1' ELSE 'HP:1,HP:2' END || ')', ';' ORDER BY c.sample_id) AS phenotypes FROM calls c JOIN samples s ON s.sample_id = c.sample_id GROUP BY variant_id""")
def phenotype_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_nationkey") % 3
    terms = F.when(k == 1, F.array(F.lit("HP:1"))).when(k == 2, F.array(F.lit("HP:2"), F.lit("HP:1")))
    return annotate.phenotype_text(a.calls(spark, sf_dir), a.samples(spark, sf_dir).select("sample_id", terms.alias("terms")))


# statistics


@query("""SELECT 'Number of variants' AS metric, count(*)::BIGINT AS value FROM variants UNION ALL SELECT 'Number of genes', count(DISTINCT gene) FROM variants UNION ALL SELECT 'Number of samples', (SELECT count(*) FROM samples)
 UNION ALL SELECT 'Het counts', count(*) FILTER (WHERE dosage = 1) FROM calls UNION ALL SELECT 'Hom counts', count(*) FILTER (WHERE dosage = 2) FROM calls
 UNION ALL SELECT 'Effect_' || effect, count(*) FROM variants GROUP BY effect UNION ALL SELECT 'Impact_' || impact, count(*) FROM variants GROUP BY impact""")
def basic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.basic(a.table_of(a.variants(spark, sf_dir)), a.calls(spark, sf_dir), a.samples(spark, sf_dir).count())


COUNTS = """, counts AS (SELECT c.variant_id, any_value(gene) AS gene, count(*) FILTER (WHERE is_case)::BIGINT AS proband_variant_count, coalesce(sum(dosage) FILTER (WHERE is_case), 0)::BIGINT AS proband_allele_count, count(*) FILTER (WHERE is_case AND dosage = 2)::BIGINT AS proband_homozygous_count,
 count(*) FILTER (WHERE NOT is_case)::BIGINT AS control_variant_count, coalesce(sum(dosage) FILTER (WHERE NOT is_case), 0)::BIGINT AS control_allele_count, count(*) FILTER (WHERE NOT is_case AND dosage = 2)::BIGINT AS control_homozygous_count FROM calls c JOIN samples s ON s.sample_id = c.sample_id GROUP BY c.variant_id) """


@query(COUNTS + "SELECT * EXCLUDE (gene) FROM counts")
def case_control_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return burden.variant_counts(a.calls(spark, sf_dir), a.cohort(spark, sf_dir))


@query(COUNTS + 'SELECT gene AS "GENE", sum(proband_allele_count)::BIGINT AS proband_allele_count, sum(control_allele_count)::BIGINT AS control_allele_count, 0::BIGINT AS proband_count, 0::BIGINT AS control_count FROM counts GROUP BY gene')
def gene_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = a.calls(spark, sf_dir)
    counts = burden.variant_counts(calls, a.cohort(spark, sf_dir)).join(a.variants(spark, sf_dir).select("variant_id", F.col("gene").alias("GENE")), "variant_id")
    return statistics.by_gene(counts)


@query(COUNTS + ", n AS (SELECT count(*) FILTER (WHERE is_case) AS a, count(*) FILTER (WHERE NOT is_case) AS b FROM samples) SELECT gene, least(sum(proband_variant_count), any_value(a))::BIGINT AS proband_variant_count, least(sum(control_variant_count), any_value(b))::BIGINT AS control_variant_count, least(sum(proband_allele_count), 2 * any_value(a))::BIGINT AS proband_allele_count, least(sum(control_allele_count), 2 * any_value(b))::BIGINT AS control_allele_count, count(*)::BIGINT AS n_variants FROM counts, n GROUP BY gene")
def gene_burden_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    who = a.cohort(spark, sf_dir)
    counts = burden.variant_counts(a.calls(spark, sf_dir), who).join(a.variants(spark, sf_dir).select("variant_id", "gene"), "variant_id")
    return burden.legacy_gene_counts(counts, *burden.cohort_sizes(who))


def _pivot_sql(column: str, values: tuple[str, ...]) -> str:
    return f'SELECT gene AS "GENE", ' + ", ".join(f"count(*) FILTER (WHERE {column} = '{v}')::BIGINT AS \"{v}\"" for v in values) + " FROM variants GROUP BY gene"


IMPACTS = ("HIGH", "MODERATE", "LOW", "MODIFIER")
EFFECTS = ("stop_gained", "missense_variant", "synonymous_variant", "intron_variant")


@query(_pivot_sql("impact", IMPACTS))
def impact_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.pivot(a.table_of(a.variants(spark, sf_dir)), "IMPACT", list(IMPACTS))


@query(_pivot_sql("effect", EFFECTS))
def effect_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.pivot(a.table_of(a.variants(spark, sf_dir)), "EFFECT", list(EFFECTS))


@query(f', g AS (SELECT gene AS "GENE", count(*)::BIGINT AS n FROM variants GROUP BY gene), i AS ({_pivot_sql("impact", IMPACTS)} HAVING count(*) > 12) SELECT g."GENE", n, ' + ", ".join(f'coalesce("{v}", 0)::BIGINT AS "{v}"' for v in IMPACTS) + ' FROM g LEFT JOIN i ON i."GENE" = g."GENE"')
def stats_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.table_of(a.variants(spark, sf_dir))
    n = v.groupBy("GENE").agg(F.count("*").alias("n"))
    return statistics.merged(n, statistics.pivot(v, "IMPACT", list(IMPACTS)).join(n.where("n > 12").select("GENE"), "GENE", "left_semi"))


DATASET_STATS = [
    {"name": "total_variants", "expression": "len(df)"},
    {"name": "total_genes", "expression": "df['GENE'].nunique()", "required_columns": ["GENE"]},
    {"name": "high_impact", "expression": "(df['IMPACT'] == 'HIGH').sum()", "required_columns": ["IMPACT"]},
    {"name": "mean_af", "expression": "pd.to_numeric(df['AF'], errors='coerce').mean()", "required_columns": ["AF"]},
    {"name": "rare_high", "expression": "len(df[(df['IMPACT'] == 'HIGH') & (pd.to_numeric(df['AF'], errors='coerce') < 0.01)])"},
    {"name": "share_stop", "expression": "float(df['EFFECT'].str.contains('STOP', case=False, na=False).mean())"},
    {"name": "skipped", "expression": "df['absent'].mean()", "required_columns": ["absent"]},
    {"name": "columns", "expression": "len([c for c in df.columns if c.startswith('p_')])"},
]


@query("""SELECT metric, round(value, 6) AS value FROM (SELECT 'total_variants' AS metric, count(*)::DOUBLE AS value FROM variants UNION ALL SELECT 'total_genes', count(DISTINCT gene) FROM variants UNION ALL SELECT 'high_impact', count(*) FILTER (WHERE impact = 'HIGH') FROM variants
 UNION ALL SELECT 'mean_af', avg(af) FROM variants UNION ALL SELECT 'rare_high', count(*) FILTER (WHERE impact = 'HIGH' AND af < 0.01) FROM variants UNION ALL SELECT 'share_stop', avg((effect LIKE 'stop%')::INT) FROM variants UNION ALL SELECT 'columns', 2)""")
def config_dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.dataset(a.table_of(a.variants(spark, sf_dir)), DATASET_STATS).select("metric", r6("value", "value"))


@query('SELECT gene AS "GENE", count(*)::DOUBLE AS n, round(max(cadd), 6) AS top_cadd, round(avg((impact = \'HIGH\')::INT), 6) AS high_share, round(stddev_samp(af), 6) AS af_sd FROM variants GROUP BY gene')
def config_gene_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = [{"name": "n", "expression": "size()"}, {"name": "top_cadd", "expression": "pd.to_numeric(group_df['CADD'], errors='coerce').max()"}, {"name": "high_share", "expression": "(group_df['IMPACT'] == 'HIGH').mean()"}, {"name": "af_sd", "expression": "pd.to_numeric(group_df['AF'], errors='coerce').std()"}]
    rows = statistics.per_gene(a.table_of(a.variants(spark, sf_dir)), stats)
    return rows.select("GENE", "n", r6("top_cadd", "top_cadd"), r6("high_share", "high_share"), r6("af_sd", "af_sd"))


@query('SELECT p_type, ' + ", ".join(f"coalesce(count(*) FILTER (WHERE impact = '{v}'), 0)::DOUBLE AS \"{v}\"" for v in IMPACTS) + " FROM variants GROUP BY p_type")
def config_grouped_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.grouped(a.table_of(a.variants(spark, sf_dir)), {"name": "n", "expression": "size()", "groupby": ["p_type", "IMPACT"], "output_format": "pivot"})


@query("SELECT gene, count(*)::BIGINT AS variant_count, count(DISTINCT sample_id)::BIGINT AS sample_count FROM calls GROUP BY gene")
def cohort_gene_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.cohort_genes(a.calls(spark, sf_dir))


@query("SELECT variant_id, sample_id, (count(*) OVER (PARTITION BY variant_id))::BIGINT AS \"Variant_Count\" FROM calls")
def cohort_variant_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.occurrence_counts(a.calls(spark, sf_dir), ["variant_id"]).select("variant_id", "sample_id", "Variant_Count")


@query('SELECT gene AS "GENE", count(*)::BIGINT AS n FROM variants GROUP BY gene ORDER BY n DESC, gene LIMIT 10')
def report_top_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_genes(a.table_of(a.variants(spark, sf_dir)))


@query("SELECT chrom, min(pos) AS start, max(pos) AS \"end\" FROM variants GROUP BY chrom")
def vcf_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helicase.sources.vcf import chromosome_spans

    return chromosome_spans(a.variants(spark, sf_dir))


# burden and association

GENES = """, best AS (SELECT gene, sample_id, max(dosage) AS d FROM calls GROUP BY gene, sample_id),
 g AS (SELECT gene, count(*) FILTER (WHERE is_case) AS cc, count(*) FILTER (WHERE NOT is_case) AS kc, coalesce(sum(d) FILTER (WHERE is_case), 0) AS ca, coalesce(sum(d) FILTER (WHERE NOT is_case), 0) AS ka FROM best b JOIN samples s ON s.sample_id = b.sample_id GROUP BY gene),
 nv AS (SELECT gene, count(DISTINCT variant_id) AS n_variants FROM calls GROUP BY gene), sz AS (SELECT count(*) FILTER (WHERE is_case) AS n1, count(*) FILTER (WHERE NOT is_case) AS n0 FROM samples)"""


def _burden_sql(times: int, case: str, control: str, name: str) -> str:
    return GENES + f""", t AS (SELECT g.gene, {case} AS a, {control} AS b, {times} * n1 - {case} AS c, {times} * n0 - {control} AS d, n1, n0, n_variants FROM g, sz, nv WHERE nv.gene = g.gene),
 k AS (SELECT *, unnest(range(greatest(0, a + b + a + c - (a + b + c + d))::BIGINT, (least(a + b, a + c) + 1)::BIGINT)) AS k FROM t),
 lp AS (SELECT *, lgamma(a + b + 1.0) + lgamma(c + d + 1.0) + lgamma(a + c + 1.0) + lgamma(b + d + 1.0) - lgamma(a + b + c + d + 1.0) - lgamma(k + 1.0) - lgamma(a + b - k + 1.0) - lgamma(a + c - k + 1.0) - lgamma(d - a + k + 1.0) AS lp FROM k),
 seen AS (SELECT gene, lp AS s FROM lp WHERE k = a), p AS (SELECT lp.gene, least(1.0, sum(exp(lp)) FILTER (WHERE lp <= s + 1e-7)) AS p FROM lp JOIN seen ON seen.gene = lp.gene GROUP BY lp.gene),
 r AS (SELECT gene, p, row_number() OVER (ORDER BY p) AS i, count(*) OVER () AS m FROM p), q AS (SELECT gene, least(1.0, min(p * m / i) OVER (ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS q FROM r),
 o AS (SELECT *, CASE WHEN a = 0 OR b = 0 OR c = 0 OR d = 0 THEN 0.5 ELSE 0 END AS h FROM t)
 SELECT o.gene AS "GENE", n1::BIGINT AS proband_count, n0::BIGINT AS control_count, a::BIGINT AS proband_{name}, b::BIGINT AS control_{name}, round(p, 6) AS raw_p_value, round(q, 6) AS corrected_p_value,
  round(CASE WHEN b * c > 0 THEN a::DOUBLE * d / (b * c) WHEN a * d > 0 THEN 'inf'::DOUBLE ELSE 'nan'::DOUBLE END, 6) AS odds_ratio,
  CASE WHEN a + b > 0 AND c + d > 0 THEN round(exp(ln((a + h) * (d + h) / ((b + h) * (c + h))) - 1.959963984540054 * sqrt(1 / (a + h) + 1 / (b + h) + 1 / (c + h) + 1 / (d + h))), 6) END AS or_ci_lower,
  CASE WHEN a + b > 0 AND c + d > 0 THEN round(exp(ln((a + h) * (d + h) / ((b + h) * (c + h))) + 1.959963984540054 * sqrt(1 / (a + h) + 1 / (b + h) + 1 / (c + h) + 1 / (d + h))), 6) END AS or_ci_upper, n_variants::BIGINT AS n_qualifying_variants
 FROM o JOIN p ON p.gene = o.gene JOIN q ON q.gene = o.gene"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(r6(c, c) if k == "double" else F.col(c) for c, k in df.dtypes))


@query(_burden_sql(1, "cc", "kc", "carriers"))
def gene_burden_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(burden.gene_burden(a.calls(spark, sf_dir), a.cohort(spark, sf_dir), "samples"))


@query(_burden_sql(2, "ca", "ka", "alleles"))
def gene_burden_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(burden.gene_burden(a.calls(spark, sf_dir), a.cohort(spark, sf_dir), "alleles"))


@query(_burden_sql(1, "cc", "kc", "carriers"))
def gene_burden_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from packed cells."""
    cells = annotate.unpacked(annotate.packed(a.calls(spark, sf_dir)))
    rows = cells.withColumn("dosage", genotype.association_dosage(F.col("gt"))).join(a.variants(spark, sf_dir).select("variant_id", "gene"), "variant_id")
    return _rounded(burden.gene_burden(rows, a.cohort(spark, sf_dir), "samples"))


TESTS = ", tests AS (SELECT p_partkey AS id, p_partkey::VARCHAR AS gene, ((p_partkey * 7919) % 10007 + 1)::DOUBLE / 20014.0::DOUBLE AS p, 1.0::DOUBLE + p_size % 3 AS w FROM part) "


def part_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return a.table(spark, sf_dir, "part").select(k.alias("id"), k.cast("string").alias("gene"), (((k * 7919) % 10007 + 1).cast("double") / 20014.0).alias("p"), (F.lit(1.0) + F.col("p_size") % 3).alias("weight"))


def _bh_sql(p: str) -> str:
    return f"least(1.0, min({p} * (SELECT count(*) FROM tests) / i) OVER (ORDER BY {p}, id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"


@query(TESTS + f", r AS (SELECT *, row_number() OVER (ORDER BY p, id) AS i FROM tests) SELECT id, round({_bh_sql('p')}, 6) AS q FROM r")
def bh_fdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correction.benjamini_hochberg(part_tests(spark, sf_dir)).select("id", r6("q", "q"))


@query(TESTS + "SELECT id, round(least(1.0, p * (count(*) OVER ())), 6) AS q FROM tests")
def bonferroni(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correction.bonferroni(part_tests(spark, sf_dir)).select("id", r6("q", "q"))


@query(TESTS + f", n AS (SELECT *, w / avg(w) OVER () AS fw FROM tests), s AS (SELECT id, fw, least(1.0, p / fw) AS wp FROM n), r AS (SELECT *, row_number() OVER (ORDER BY wp, id) AS i FROM s) SELECT id, round(fw, 6) AS fdr_weight, round({_bh_sql('wp')}, 6) AS q FROM r")
def weighted_bh(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = part_tests(spark, sf_dir)
    return correction.weighted(t.select("id", "gene", "p"), t.select("gene", "weight")).select("id", r6("fdr_weight", "fdr_weight"), r6("q", "q"))


@query(TESTS + "SELECT id, round(CASE WHEN id % 5 = 0 THEN p ELSE 0.5 - atan((tan((0.5 - p) * pi()) + tan((0.5 - p * p) * pi())) / 2) / pi() END, 6) AS combined FROM tests")
def acat_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.when(F.col("id") % 5 != 0, F.col("p") * F.col("p"))
    return part_tests(spark, sf_dir).select("id", r6(correction.cauchy([F.col("p"), second, F.lit(1.0)]), "combined"))


@query(TESTS + "SELECT id, round(-log10((row_number() OVER (ORDER BY p, id))::DOUBLE / ((count(*) OVER ()) + 1)), 6) AS expected_log10, round(-log10(p), 6) AS observed_log10 FROM tests")
def qq_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correction.qq(part_tests(spark, sf_dir), ties=["id"]).select("id", r6("expected_log10", "expected_log10"), r6("observed_log10", "observed_log10"))


#: The normal distribution function above zero, by its series.
PHI = "(0.5 + exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 90), lambda j: exp((2 * j + 1) * ln({z}) - (lgamma(2.0 * j + 2) - j * ln(2) - lgamma(j + 1.0))))))"


@query(TESTS + f""", mids AS (SELECT p FROM (SELECT p, row_number() OVER (ORDER BY p) AS i, count(*) OVER () AS n FROM tests) WHERE i IN ((n + 1) // 2, n // 2 + 1)),
 r AS (SELECT p, 1.0::DOUBLE AS z, 0 AS it FROM mids UNION ALL SELECT p, z - ({PHI.format(z="z")} - (1 - p / 2)) / (exp(-z * z / 2) / sqrt(2 * pi())), it + 1 FROM r WHERE it < 30)
 SELECT 'made' AS test, round(avg(z * z) / 0.4549364231195724, 6) AS lambda_gc FROM r WHERE it = 30""")
def lambda_gc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return association.lambda_gc(part_tests(spark, sf_dir).withColumn("test", F.lit("made")), "p").select("test", r6("lambda_gc", "lambda_gc"))


MISSING = ", n AS (SELECT count(*) AS n FROM samples), mc AS (SELECT variant_id, gene, sample_id, CASE WHEN (variant_id * 31 + substr(sample_id, 2)::BIGINT) % 11 = 0 THEN NULL ELSE dosage END AS dosage FROM all_calls) "


def missing_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.all_calls(spark, sf_dir)
    gone = (F.col("variant_id") * 31 + F.substring("sample_id", 2, 20).cast("bigint")) % 11 == 0
    return rows.select("variant_id", "gene", "sample_id", F.when(~gone, F.col("dosage")).alias("dosage"))


@query(MISSING + ", f AS (SELECT variant_id, coalesce(sum(dosage), 0)::DOUBLE / nullif(2 * ((SELECT n FROM n) - count(*) FILTER (WHERE dosage IS NULL)), 0) AS maf FROM mc GROUP BY variant_id) SELECT mc.variant_id, sample_id, round(maf, 6) AS maf, round(coalesce(dosage::DOUBLE, round(2 * maf)), 6) AS dosage FROM mc JOIN f ON f.variant_id = mc.variant_id")
def maf_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = association.imputed(missing_calls(spark, sf_dir), a.samples(spark, sf_dir).count())
    return rows.select("variant_id", "sample_id", r6("maf", "maf"), r6("dosage", "dosage"))


@query(MISSING + "SELECT variant_id, count(*)::BIGINT AS n FROM mc WHERE variant_id NOT IN (SELECT variant_id FROM mc GROUP BY variant_id HAVING count(*) FILTER (WHERE dosage IS NULL)::DOUBLE / (SELECT n FROM n) > 0.03) GROUP BY variant_id")
def missingness_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = association.site_filter(missing_calls(spark, sf_dir), a.samples(spark, sf_dir).count(), 0.03)
    return rows.groupBy("variant_id").agg(F.count("*").alias("n"))


@query(MISSING + ", v AS (SELECT gene, count(DISTINCT variant_id) AS n FROM mc GROUP BY gene), m AS (SELECT gene, sample_id, count(DISTINCT variant_id) AS m FROM mc WHERE dosage IS NULL GROUP BY gene, sample_id) SELECT m.gene, sample_id FROM m JOIN v ON v.gene = m.gene WHERE m.m::DOUBLE / v.n > 0.05")
def sample_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return association.masked_samples(missing_calls(spark, sf_dir), 0.05)


@query("SELECT gene, sum(dosage)::BIGINT AS mac FROM calls GROUP BY gene HAVING sum(dosage) >= 30")
def mac_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return association.enough_alleles(a.calls(spark, sf_dir), 30)


@query("SELECT variant_id, round(25 * power(1 - greatest(af, 1e-8), 24), 6) AS weight FROM variants")
def beta_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.variants(spark, sf_dir).select("variant_id", r6(weights.by_spec("beta:1,25", F.col("af")), "weight"))


@query("SELECT variant_id, round(25 * power(1 - greatest(af, 1e-8), 24) * least(cadd / 40, 1), 6) AS cadd, round(25 * power(1 - greatest(af, 1e-8), 24) * revel, 6) AS revel FROM variants")
def cadd_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.variants(spark, sf_dir).select("variant_id", r6(weights.cadd(F.col("af"), F.col("cadd")), "cadd"), r6(weights.revel(F.col("af"), F.col("revel")), "revel"))


CATEGORY = "CASE WHEN impact = 'HIGH' AND effect = 'stop_gained' THEN 3 WHEN effect = 'missense_variant' AND (sift = 'deleterious' OR polyphen <> 'benign') THEN 2 WHEN effect = 'missense_variant' AND sift = 'tolerated' AND polyphen = 'benign' THEN 1 ELSE 0 END"


@query(f"SELECT variant_id, {CATEGORY} AS category FROM variants")
def coast_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = a.variants(spark, sf_dir)
    return v.select("variant_id", association.coast_category(F.col("effect"), F.col("impact"), F.col("sift"), F.col("polyphen")).alias("category"))


@query(f", cat AS (SELECT variant_id, {CATEGORY} AS category FROM variants) SELECT gene, sample_id, sum(dosage) FILTER (WHERE category = 1)::BIGINT AS bmv, sum(dosage) FILTER (WHERE category = 2)::BIGINT AS dmv, sum(dosage) FILTER (WHERE category = 3)::BIGINT AS ptv, greatest(coalesce(sum(dosage) FILTER (WHERE category = 1), 0), 2 * coalesce(sum(dosage) FILTER (WHERE category = 2), 0), 3 * coalesce(sum(dosage) FILTER (WHERE category = 3), 0))::BIGINT AS top FROM calls c JOIN cat ON cat.variant_id = c.variant_id WHERE category > 0 GROUP BY gene, sample_id")
def coast_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = coast_classify(spark, sf_dir)
    sums = {n: F.sum(F.when(F.col("category") == k, F.col("dosage"))) for k, n in ((1, "bmv"), (2, "dmv"), (3, "ptv"))}
    top = F.greatest(*(F.coalesce(s, F.lit(0)) * k for k, s in enumerate(sums.values(), 1)))
    return a.calls(spark, sf_dir).join(cat, "variant_id").where("category > 0").groupBy("gene", "sample_id").agg(*(s.alias(n) for n, s in sums.items()), top.alias("top"))


def association_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.calls(spark, sf_dir).join(coast_classify(spark, sf_dir), "variant_id")


def _association(tests: list[str], quantitative: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if quantitative:
            who = a.samples(spark, sf_dir).select("sample_id", F.col("s_acctbal").alias("y"))
            cohort = genetests.Cohort.of(who, binary=False)
            rows = association.imputed(association_inputs(spark, sf_dir), cohort.n).withColumn("weight", F.lit(1.0))
            return _rounded(association.test_genes(rows, cohort, tests)).drop("warnings", "status")
        return _rounded(association.run_all(association_inputs(spark, sf_dir), a.cohort(spark, sf_dir), tests, plan=association.Plan(least_cases=1)))

    return run


LINEAR = """, b AS (SELECT gene, sample_id, sum(dosage)::DOUBLE AS b FROM calls GROUP BY gene, sample_id), full_b AS (SELECT g.gene, s.s_acctbal AS y, coalesce(b.b, 0) AS b FROM (SELECT DISTINCT gene FROM calls) g CROSS JOIN samples s LEFT JOIN b ON b.gene = g.gene AND b.sample_id = s.sample_id)
 SELECT gene, round(regr_slope(y, b) + 0.0000123, 2) AS effect FROM full_b GROUP BY gene"""


@query(LINEAR)
def linear_burden(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _association(["linear_burden"], True)(spark, sf_dir)
    return rows.select("gene", F.round(F.col("effect") + 0.0000123, 2).alias("effect"))  # off ties: balances have two decimals


LOGISTIC = f""", n AS (SELECT count(*) FILTER (WHERE is_case) AS n1, count(*) FILTER (WHERE NOT is_case) AS n0 FROM samples), w AS (SELECT variant_id, 25 * power(1 - greatest(sum(dosage)::DOUBLE / (2 * (n1 + n0)), 1e-8), 24) AS w FROM all_calls, n GROUP BY variant_id, n1, n0),
 b AS (SELECT gene, sample_id, sum(dosage * w) AS b FROM calls c JOIN w ON w.variant_id = c.variant_id GROUP BY gene, sample_id), g AS (SELECT gene FROM calls GROUP BY gene HAVING sum(dosage) >= 5),
 k AS (SELECT gene FROM b JOIN samples s ON s.sample_id = b.sample_id, n GROUP BY gene, n1, n0 HAVING count(*) FILTER (WHERE is_case) BETWEEN 1 AND n1 - 1 AND count(*) FILTER (WHERE NOT is_case) BETWEEN 1 AND n0 - 1),
 f AS (SELECT g.gene, list(coalesce(b.b, 0) ORDER BY s.sample_id) AS bs, list(is_case::INT::DOUBLE ORDER BY s.sample_id) AS ys FROM g JOIN k ON k.gene = g.gene CROSS JOIN samples s LEFT JOIN b ON b.gene = g.gene AND b.sample_id = s.sample_id GROUP BY g.gene),
 r AS (SELECT gene, bs, ys, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS se, 0 AS it FROM f
  UNION ALL SELECT gene, bs, ys, b0 + (w2 * s0 - w1 * s1) / (w0 * w2 - w1 * w1), b1 + (w0 * s1 - w1 * s0) / (w0 * w2 - w1 * w1), sqrt(w0 / (w0 * w2 - w1 * w1)), it + 1 FROM (
   SELECT *, list_sum(list_transform(range(1, len(bs) + 1), lambda i: ys[i] - mu[i])) AS s0, list_sum(list_transform(range(1, len(bs) + 1), lambda i: bs[i] * (ys[i] - mu[i]))) AS s1, list_sum(list_transform(range(1, len(bs) + 1), lambda i: mu[i] * (1 - mu[i]))) AS w0,
    list_sum(list_transform(range(1, len(bs) + 1), lambda i: bs[i] * mu[i] * (1 - mu[i]))) AS w1, list_sum(list_transform(range(1, len(bs) + 1), lambda i: bs[i] * bs[i] * mu[i] * (1 - mu[i]))) AS w2
   FROM (SELECT *, list_transform(bs, lambda x: 1 / (1 + exp(-(b0 + b1 * x)))) AS mu FROM r WHERE it < 25)))
 SELECT gene, round(b1, 4) AS effect, round(2 * (1 - {PHI.format(z="greatest(abs(b1 / se), 1e-9)")}), 5) AS p_value FROM r WHERE it = 25 AND se < 100"""


@query(LOGISTIC)
def logistic_burden_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effects and p-values of genes that cases and controls both carry and both lack, so that the plain fit exists."""
    calls, who = a.calls(spark, sf_dir), a.cohort(spark, sf_dir)
    n1, n0 = burden.cohort_sizes(who)
    mixed = burden.gene_counts(calls, who).where(f"case_carriers BETWEEN 1 AND {n1 - 1} AND control_carriers BETWEEN 1 AND {n0 - 1}").select("gene")
    rows = association.run_all(calls, who, ["logistic_burden"], plan=association.Plan(least_cases=1)).where("NOT contains(warnings, 'FIRTH')").join(mixed, "gene", "left_semi")
    return rows.select("gene", F.round("logistic_burden_effect", 4).alias("effect"), F.round("logistic_burden_pvalue", 5).alias("p_value"))


QUERIES["linear_burden_full"] = _association(["linear_burden"], True)
QUERIES["logistic_burden"] = _association(["logistic_burden"])
QUERIES["skat"] = _association(["skat"])
QUERIES["skato"] = _association(["skato"])
QUERIES["coast"] = _association(["coast"])
QUERIES["association_engine"] = _association(["fisher", "logistic_burden", "skat", "acat_v"])


# inheritance


def fam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inheritance.family(a.pedigree(spark, sf_dir), a.samples(spark, sf_dir))


FAMILY = """, fam AS (SELECT p.*, f.sample_id IS NOT NULL AS fin, m.sample_id IS NOT NULL AS min_, coalesce(f.affected, FALSE) AS fhit, coalesce(m.affected, FALSE) AS mhit FROM pedigree p LEFT JOIN pedigree f ON f.sample_id = p.father_id LEFT JOIN pedigree m ON m.sample_id = p.mother_id),
 trio AS (SELECT c.variant_id, fam.sample_id, c.dosage AS c, CASE WHEN fin THEN coalesce(cf.dosage, 0) END AS f, CASE WHEN min_ THEN coalesce(cm.dosage, 0) END AS m, sex, affected, fin, min_, fhit, mhit, place, v.chrom
  FROM calls c JOIN fam ON fam.sample_id = c.sample_id JOIN variants v ON v.variant_id = c.variant_id LEFT JOIN calls cf ON cf.variant_id = c.variant_id AND cf.sample_id = father_id LEFT JOIN calls cm ON cm.variant_id = c.variant_id AND cm.sample_id = mother_id),
 flags AS (SELECT *, coalesce(f > 0, FALSE) AS fh, coalesce(m > 0, FALSE) AS mh, chrom = 'X' AS x FROM trio),
 xld AS (SELECT *, affected AND x AND ((sex = '2' AND fh AND fhit) OR (mh AND mhit)) AS clear FROM flags),
 told AS (SELECT *, list_filter([
   CASE WHEN fin AND min_ AND f = 0 AND m = 0 THEN 'de_novo' END,
   CASE WHEN affected AND ((fh AND fhit) OR (mh AND mhit)) THEN 'autosomal_dominant' WHEN affected AND (fh OR mh) THEN 'autosomal_dominant_possible' END,
   CASE WHEN affected AND c = 2 AND fh AND mh THEN 'autosomal_recessive' END,
   CASE WHEN x AND affected AND sex = '1' AND min_ AND mh AND NOT fh THEN 'x_linked_recessive' WHEN x AND affected AND sex = '2' AND c = 2 AND fh AND mh THEN 'x_linked_recessive'
        WHEN x AND affected AND sex = '1' AND NOT min_ THEN 'x_linked_recessive_possible' WHEN x AND affected AND sex = '2' AND c = 2 AND (NOT fin OR NOT min_) THEN 'x_linked_recessive_possible' END,
   CASE WHEN clear THEN 'x_linked_dominant' WHEN x AND affected AND NOT max(clear) OVER (PARTITION BY variant_id ORDER BY place ROWS UNBOUNDED PRECEDING) THEN 'x_linked_dominant_possible' END], lambda z: z IS NOT NULL) AS found FROM xld),
 each_ AS (SELECT variant_id, place, unnest(CASE WHEN len(found) > 0 THEN found WHEN affected THEN ['unknown'] ELSE ['carrier'] END) AS pattern, generate_subscripts(CASE WHEN len(found) > 0 THEN found ELSE ['x'] END, 1) AS i FROM told),
 firsts AS (SELECT variant_id, pattern, min(place * 100 + i) AS ord FROM each_ GROUP BY variant_id, pattern),
 pats AS (SELECT variant_id, list(pattern ORDER BY ord) AS patterns FROM firsts GROUP BY variant_id)"""


@query(FAMILY + " SELECT variant_id, array_to_string(patterns, ',') AS patterns FROM pats")
def inheritance_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inheritance.patterns(a.calls(spark, sf_dir), a.variants(spark, sf_dir), fam(spark, sf_dir))
    return rows.select("variant_id", F.array_join("patterns", ",").alias("patterns"))


PAIRS = FAMILY + """, het AS (SELECT c.gene, t.*, count(*) OVER (PARTITION BY c.gene, t.sample_id) AS n FROM trio t JOIN calls c ON c.variant_id = t.variant_id AND c.sample_id = t.sample_id WHERE c.dosage = 1),
 o AS (SELECT gene, sample_id, variant_id, affected, coalesce(f > 0, FALSE) AS fo, coalesce(m > 0, FALSE) AS mo, fin, min_ FROM het WHERE n > 1),
 pairs AS (SELECT x.gene, x.sample_id, x.variant_id, CASE WHEN x.fin AND x.min_ THEN 'compound_heterozygous' WHEN x.fin OR x.min_ THEN 'compound_heterozygous_possible_missing_parents' ELSE 'compound_heterozygous_possible_no_pedigree' END AS type, y.variant_id AS partner
  FROM o x JOIN o y ON y.gene = x.gene AND y.sample_id = x.sample_id AND y.variant_id <> x.variant_id
  WHERE CASE WHEN x.fin AND x.min_ THEN (y.fo <> y.mo) AND (x.fo = x.mo OR x.fo <> y.fo) WHEN x.fin THEN x.fo <> y.fo WHEN x.min_ THEN x.mo <> y.mo ELSE x.affected END)"""


@query(PAIRS + " SELECT gene, sample_id, variant_id, type, string_agg(partner::VARCHAR, ',' ORDER BY partner) AS partners FROM pairs GROUP BY gene, sample_id, variant_id, type")
def comp_het_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inheritance.compound_hets(a.calls(spark, sf_dir), fam(spark, sf_dir))
    return rows.select("gene", "sample_id", "variant_id", "type", F.array_join(F.transform("partners", lambda p: p.cast("string")), ",").alias("partners"))


SEG = """, roles AS (SELECT variant_id, fam.sample_id AS child FROM calls c JOIN fam ON c.sample_id IN (fam.sample_id, CASE WHEN fin THEN father_id END, CASE WHEN min_ THEN mother_id END) GROUP BY ALL),
 every AS (SELECT v.variant_id, fam.sample_id, sex, affected, fin, min_, coalesce(cc.dosage, 0) AS c, CASE WHEN fin THEN coalesce(cf.dosage, 0) END AS f, CASE WHEN min_ THEN coalesce(cm.dosage, 0) END AS m
  FROM variants v CROSS JOIN fam LEFT JOIN calls cc ON cc.variant_id = v.variant_id AND cc.sample_id = fam.sample_id LEFT JOIN calls cf ON cf.variant_id = v.variant_id AND cf.sample_id = father_id LEFT JOIN calls cm ON cm.variant_id = v.variant_id AND cm.sample_id = mother_id),
 n AS (SELECT variant_id, count(*) FILTER (WHERE fin AND min_) AS dc, count(*) FILTER (WHERE fin AND min_ AND c > 0 AND (f > 0 OR m > 0)) AS db, count(*) FILTER (WHERE affected) AS na, count(*) FILTER (WHERE NOT affected) AS nu, count(*) FILTER (WHERE affected AND c > 0) AS aw, count(*) FILTER (WHERE NOT affected AND c > 0) AS uw,
  count(*) FILTER (WHERE affected AND c = 2) AS ah, count(*) FILTER (WHERE affected AND c = 1) AS a1, count(*) FILTER (WHERE affected AND fin AND min_) AS nt, count(*) FILTER (WHERE affected AND fin AND min_ AND NOT (f > 0 AND m > 0)) AS ab, count(*) AS n,
  count(*) FILTER (WHERE (sex = '1' AND affected <> (c > 0)) OR (sex = '2' AND affected AND c <> 2)) AS xr, count(*) FILTER (WHERE affected AND c = 0) AS xd,
  count(*) FILTER (WHERE min_) + count(*) FILTER (WHERE fin) AS mc, count(*) FILTER (WHERE min_ AND m > 0 AND c = 0) + count(*) FILTER (WHERE fin AND f > 0 AND c > 0 AND NOT coalesce(m > 0, FALSE)) AS mb FROM every GROUP BY variant_id),
 seg AS (SELECT variant_id, db = 0 AS s_dn, CASE WHEN dc = 0 THEN 0.5 ELSE 1.0 - db::DOUBLE / dc END AS k_dn,
  CASE WHEN na = 0 THEN FALSE WHEN aw = na AND uw = 0 THEN TRUE ELSE aw::DOUBLE / na > 0.8 AND uw::DOUBLE / (nu + 1) < 0.2 END AS s_ad, CASE WHEN na = 0 THEN 0.0 WHEN aw = na AND uw = 0 THEN 1.0 ELSE (aw::DOUBLE / na + CASE WHEN nu > 0 THEN (nu - uw)::DOUBLE / nu ELSE 1.0 END) / 2 END AS k_ad,
  na + nt > 0 AND na - ah + ab = 0 AS s_ar, CASE WHEN na + nt = 0 THEN 0.0 ELSE 1.0 - (na - ah + ab)::DOUBLE / (na + nt) END AS k_ar, na > 0 AND a1 = na AS s_ch, CASE WHEN na = 0 THEN 0.0 ELSE a1::DOUBLE / na END AS k_ch,
  xr < n * 0.2 AS s_xr, 1.0 - xr::DOUBLE / n AS k_xr, xd < n * 0.2 AS s_xd, 1.0 - xd::DOUBLE / n AS k_xd, mb = 0 AS s_mt, CASE WHEN mc = 0 THEN 0.5 ELSE 1.0 - mb::DOUBLE / mc END AS k_mt FROM n)"""


@query(FAMILY + SEG + " SELECT variant_id, s_dn AS seg_de_novo, round(k_dn, 6) AS conf_de_novo, s_ad AS seg_autosomal_dominant, round(k_ad, 6) AS conf_autosomal_dominant, s_ar AS seg_autosomal_recessive, round(k_ar, 6) AS conf_autosomal_recessive, s_ch AS seg_compound_heterozygous, round(k_ch, 6) AS conf_compound_heterozygous, s_xr AS seg_x_linked_recessive, round(k_xr, 6) AS conf_x_linked_recessive, s_xd AS seg_x_linked_dominant, round(k_xd, 6) AS conf_x_linked_dominant, s_mt AS seg_mitochondrial, round(k_mt, 6) AS conf_mitochondrial FROM seg")
def segregation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(inheritance.segregation(a.calls(spark, sf_dir), a.variants(spark, sf_dir), fam(spark, sf_dir)))


RANK = ", rank(pattern, score) AS (VALUES " + ", ".join(f"('{k}', {v})" for k, v in inheritance.PRIORITY.items()) + ") "
PRIORITISED = PAIRS + SEG + RANK + """, allp AS (SELECT variant_id, pattern, ord FROM firsts UNION ALL SELECT variant_id, type, 1000000000 + row_number() OVER (PARTITION BY variant_id ORDER BY type) FROM (SELECT DISTINCT variant_id, type FROM pairs)),
 scored AS (SELECT a.variant_id, a.pattern, a.ord, coalesce(r.score, 0) AS score, CASE a.pattern WHEN 'de_novo' THEN s_dn AND k_dn > 0.5 WHEN 'autosomal_dominant' THEN s_ad AND k_ad > 0.5 WHEN 'autosomal_recessive' THEN s_ar AND k_ar > 0.5 WHEN 'compound_heterozygous' THEN s_ch AND k_ch > 0.5 WHEN 'x_linked_recessive' THEN s_xr AND k_xr > 0.5 WHEN 'x_linked_dominant' THEN s_xd AND k_xd > 0.5 WHEN 'mitochondrial' THEN s_mt AND k_mt > 0.5 ELSE FALSE END AS good
  FROM allp a JOIN seg s ON s.variant_id = a.variant_id LEFT JOIN rank r ON r.pattern = a.pattern),
 kept AS (SELECT * FROM (SELECT *, bool_or(good) OVER (PARTITION BY variant_id) AS any_good FROM scored) WHERE good OR NOT any_good),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY score DESC, ord) AS i, count(*) OVER (PARTITION BY variant_id) AS n, lead(score) OVER (PARTITION BY variant_id ORDER BY score DESC, ord) AS second FROM kept),
 best AS (SELECT variant_id, pattern, CASE WHEN n = 1 THEN least(score / 100.0, 1.0) ELSE round(least(((score - second) / 50.0) * (score / 100.0), 1.0), 2) END AS confidence FROM ranked WHERE i = 1)"""


@query(PRIORITISED + " SELECT v.variant_id, coalesce(pattern, 'unknown') AS pattern, round(coalesce(confidence, 0.0)::DOUBLE, 4) AS confidence FROM variants v LEFT JOIN best b ON b.variant_id = v.variant_id")
def inheritance_prioritised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inheritance.analysed(a.calls(spark, sf_dir), a.variants(spark, sf_dir), fam(spark, sf_dir))
    return rows.select("variant_id", "pattern", F.round("confidence", 4).alias("confidence"))


SCORE_MODEL = {
    "variables": {"AF": "af|default:0.0", "CADD": "cadd|default:0.0", "IMPACT": "impact|default:''", "EFFECT": "effect"},
    "output_scores": ["raw", "score"],
    "formulas": [
        {"severe": "(impact == 'HIGH') | effect.str.contains('missense')"},
        {"raw": "severe * 2.5 + (cadd / 40) - (af > 0.02) * 1.5"},
        {"score": "1 / (1 + 2.718281828459045 ** (-raw))"},
    ],
}


@query(", r AS (SELECT variant_id, (CASE WHEN impact = 'HIGH' OR effect LIKE '%missense%' THEN 1 ELSE 0 END) * 2.5 + cadd / 40 - (CASE WHEN af > 0.02 THEN 1 ELSE 0 END) * 1.5 AS raw FROM variants) SELECT variant_id, round(raw::DOUBLE, 6) AS raw, round(1 / (1 + exp(-raw)), 6) AS score FROM r")
def simple_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.apply_scoring(a.table_of(a.variants(spark, sf_dir)), SCORE_MODEL).select("variant_id", r6("raw", "raw"), r6("score", "score"))


INHERITANCE_MODEL = {
    "variables": {"pattern": "pattern", "confidence": "confidence"},
    "output_scores": ["inheritance_score"],
    "formulas": [
        {"base": "(pattern == 'de_novo') * 0.95 + pattern.isin(['homozygous', 'compound_heterozygous', 'autosomal_recessive']) * 0.8 + (pattern == 'x_linked_recessive') * 0.7 + (pattern == 'autosomal_dominant') * 0.4 + (pattern == 'unknown') * 0.1"},
        {"penalty": "(~pattern.isin(['de_novo', 'unknown']) & (confidence < 0.5)) * 0.2"},
        {"inheritance_score": "base * (1 - penalty)"},
    ],
}


@query(PRIORITISED + """, p AS (SELECT v.variant_id, coalesce(pattern, 'unknown') AS pattern, coalesce(confidence, 0.0)::DOUBLE AS confidence FROM variants v LEFT JOIN best b ON b.variant_id = v.variant_id)
 SELECT variant_id, round((CASE WHEN pattern = 'de_novo' THEN 0.95 WHEN pattern IN ('homozygous', 'compound_heterozygous', 'autosomal_recessive') THEN 0.8 WHEN pattern = 'x_linked_recessive' THEN 0.7 WHEN pattern = 'autosomal_dominant' THEN 0.4 WHEN pattern = 'unknown' THEN 0.1 ELSE 0 END * (1 - CASE WHEN pattern NOT IN ('de_novo', 'unknown') AND confidence < 0.5 THEN 0.2 ELSE 0 END))::DOUBLE, 6) AS inheritance_score FROM p""")
def inheritance_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inheritance.analysed(a.calls(spark, sf_dir), a.variants(spark, sf_dir), fam(spark, sf_dir))
    return scoring.apply_scoring(rows.select("variant_id", "pattern", "confidence"), INHERITANCE_MODEL).select("variant_id", r6("inheritance_score", "inheritance_score"))
