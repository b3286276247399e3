"""The whole analysis as one chain of DataFrames: from a VCF to annotated, scored, filtered variants and gene tables.

Records and calls are filtered, written once (as steps that a later run finds again) and read by everything after them;
the rest is lazy and runs when a sink asks for it.
"""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.functions import genotype, text
from helicase.operators import annotate, association, burden, identifiers, inheritance, report, scoring, statistics
from helicase.plans import config
from helicase.plans.filterlang import PRESETS, PROFILE_FIELDS, PROFILE_HIDDEN, PROFILES, Schema, compile_filter, composed, profiles
from helicase.plans.steps import Steps
from helicase.sources import sheets, sinks, tables, typed, vcf
from helicase.sources.store import materialised, put_text, shared_dir

log = logging.getLogger(__name__)


@dataclass
class Settings:
    """What a run does; paths may be anything that Spark reads."""

    vcf: str
    genes: str = "all"
    gene_regions: str | None = None
    gene_coordinates: str | None = None
    capture_regions: str | None = None
    expand: int = 0
    prefilter: str | None = None
    presets: list[str] = field(default_factory=list)
    filter: str | None = None
    profile: str = "dbnsfp4"
    pair: dict = field(default_factory=dict)
    late_filter: bool = False
    final_filter: str | None = None
    fields: list[str] = field(default_factory=lambda: ["CHROM", "POS", "REF", "ALT", "FILTER", "ANN[0].GENE", "ANN[0].EFFECT", "ANN[0].IMPACT", "ANN[0].HGVS_P"])
    profile_fields: bool = False
    transcripts: str | None = None
    genotype_modes: list[str] = field(default_factory=list)
    genotype_rules: str | None = None
    extra_sample_fields: list[str] = field(default_factory=list)
    extra_sample_delimiter: str = ":"
    pedigree: str | None = None
    inheritance_mode: str = "full"
    phenotypes: str | None = None
    sample_column: str = "sample_id"
    value_column: str = "term"
    trait_column: str | None = None
    case_terms: list[str] = field(default_factory=list)
    control_terms: list[str] = field(default_factory=list)
    case_samples: str | None = None
    control_samples: str | None = None
    remove_from_samples: str | None = None
    annotate_regions: list[str] = field(default_factory=list)
    annotate_gene_lists: list[str] = field(default_factory=list)
    gene_json: list[str] = field(default_factory=list)
    gene_json_mapping: str | None = None
    gene_json_columns: bool = False
    pm5_lookup: str | None = None
    scoring_model: str | None = None
    statistics: str | None = None
    burden_mode: str | None = None
    correction: str = "fdr"
    association: dict = field(default_factory=dict)
    reads: str | None = None
    pseudonyms: str | None = None
    pseudonym_pattern: str = ""
    pseudonym_category: str = "cohort"
    pseudonym_pedigree: bool = False
    links: dict[str, str] = field(default_factory=dict)
    work: str | None = None
    restart: str | None = None
    #: Buckets of the steps, which lie by variant; none: spark.sql.shuffle.partitions.
    buckets: int | None = None


def load_settings(path: str) -> tuple[dict[str, str], dict[str, dict[str, str]], dict[str, str]]:
    """presets, fragments by profile and links of a JSON configuration, on top of the built-in ones; its association
    settings are checked."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    config.association(raw.get("association", {}))
    fragments = {n: p.get("fragments", {}) for n, p in raw.get("field_profiles", {}).items()}
    return PRESETS | raw.get("presets", {}), PROFILES | fragments, raw.get("links", {})


def _parts(cells: Column, at: str, place: Column) -> Column:
    """Of each cell the part at that place; null for a dot."""
    return F.transform(cells, lambda c: F.nullif(F.get(F.split(c, at), place), F.lit(".")))


def filter_schema(header: DataFrame) -> Schema:
    """Fields of a VCF as its header names them: INFO scalars and lists, annotation subfields, per-sample values."""
    info = lambda k: F.element_at("info", F.lit(k))
    found = Schema({n.upper(): F.col(n) for n in ("chrom", "pos", "id", "ref", "alt", "qual", "filter")}, {})
    for r in header.collect():
        if r.source == "INFO":
            found.scalars[r.id] = info(r.id)
            found.arrays[r.id, None] = F.split(info(r.id), ",")
            if r.id in ("ANN", "EFF"):
                for i, name in enumerate(text.ANN_FIELDS):
                    found.arrays[r.id, name] = _parts(F.split(info(r.id), ","), "[|]", F.lit(i))
            if r.id in ("LOF", "NMD"):
                found.arrays[r.id, "PERC"] = F.transform(F.split(info(r.id), ","), lambda e: F.regexp_extract(e, r"([\d.]+)\)?$", 1))
        else:
            place = (F.array_position(F.split("format", ":"), r.id) - 1).cast("int")
            found.arrays["GEN", r.id] = _parts(F.col("samples"), ":", F.when(place >= 0, place))
    return found


@dataclass
class Result:
    variants: DataFrame
    calls: DataFrame
    statistics: DataFrame | None = None
    burden: DataFrame | None = None
    association: DataFrame | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    pseudonyms: DataFrame | None = None
    pedigree: DataFrame | None = None
    jobs: DataFrame | None = None
    steps: Steps | None = None


def _regions(spark: SparkSession, s: Settings) -> DataFrame | None:
    """Where records are looked for: the genes' intervals, cut with what was captured."""
    from helicase.operators import intervals

    wanted, found = tables.normalised_genes(s.genes), None
    if s.gene_coordinates:
        found = tables.gene_regions(tables.read_gene_coordinates(spark, s.gene_coordinates), wanted, s.expand)
    elif s.gene_regions:
        rows = tables.read_bed(spark, s.gene_regions)
        rows = rows if wanted == ["all"] else rows.where(F.col("name").isin(wanted))
        found = intervals.merged(intervals.expanded(rows.select("chrom", "start", "end"), s.expand))
    if s.capture_regions:
        captured = tables.read_bed(spark, s.capture_regions).select("chrom", "start", "end")
        found = captured if found is None else intervals.intersected(found, captured)
        if found.isEmpty():
            raise ValueError("no gene lies in the captured regions")
    return found


def _who(spark: SparkSession, s: Settings, people: DataFrame, terms: DataFrame | None) -> DataFrame | None:
    """Cases and controls: by files of samples, else by terms."""
    listed = lambda p: tables.read_lines(spark, p).withColumnRenamed("value", "sample_id") if p else None
    if s.case_samples or s.control_samples:
        return burden.cohort(people, listed(s.case_samples), listed(s.control_samples))
    if terms is None or not (s.case_terms or s.control_terms):
        return None
    return burden.cohort_by_terms(people.select("sample_id").join(terms, "sample_id", "left"), s.case_terms, s.control_terms)


def _tested(spark: SparkSession, s: Settings, calls: DataFrame, variants: DataFrame, who: DataFrame) -> DataFrame | None:
    """The association table; None, with a warning, where there are too few cases."""
    a = config.association({k: v for k, v in s.association.items()})
    tests = association.test_names(a.association_tests or ["fisher" if a.trait_type == "binary" else "linear_burden"])
    if a.trait_type == "quantitative":
        # numbers of the phenotype table; without such a column cases count one and controls zero
        told_value = tables.read_numbers(spark, s.phenotypes, s.sample_column, s.trait_column) if s.trait_column else who.select("sample_id", F.col("is_case").cast("double").alias("value"))
        who = who.select("sample_id").join(told_value, "sample_id")
    association.backend(a.skat_backend)
    names = {c.lower(): c for c in variants.columns}
    score = lambda *found: next((F.col(f"`{names[n]}`") for n in found if n in names), None)
    told = [F.col("variant_id")]
    told += [c.alias(n) for n, c in (("cadd", score("cadd", "dbnsfp_cadd_phred")), ("revel", score("revel", "dbnsfp_revel_score"))) if c is not None]
    if "coast" in tests and a.coast_classification:
        model = tables.read_scoring_model(a.coast_classification)
        made = model.get("output_scores") or [name for formula in model["formulas"] for name in formula]
        if len(made) != 1:
            raise ValueError(f"the classification names {len(made)} outputs, not one: output_scores tells which")
        variants = scoring.apply_scoring(variants, model)
        told.append(F.coalesce(F.col(made[0]).cast("int"), F.lit(0)).alias("category"))
    elif "coast" in tests:
        effect, impact = score("effect"), score("impact")
        if effect is None or impact is None:
            raise ValueError("coast needs the fields of effect and impact")
        told.append(association.coast_category(effect, impact, score("dbnsfp_sift_pred", "sift"), score("dbnsfp_polyphen2_hdiv_pred", "polyphen")).alias("category"))
    rows = calls.join(variants.select(*told), "variant_id") if len(told) > 1 else calls
    samples = [r.sample_id for r in who.select("sample_id").orderBy("sample_id").collect()]
    covariates = tables.read_covariates(spark, a.covariate_file, samples, categorical=a.categorical_covariates) if a.covariate_file else None
    if covariates is not None and a.covariate_columns:
        covariates = covariates.select("sample_id", *[c for c in covariates.columns if any(c == n or c.startswith(f"{n}_") for n in a.covariate_columns)])
    components = tables.read_components(spark, a.pca_file, a.pca_components) if a.pca_file else association.principal_components(calls, who, a.pca_components) if a.pca_tool else None
    weights = tables.read_gene_weights(spark, a.gene_prior_weights, a.gene_prior_weight_column) if a.gene_prior_weights else None
    try:
        return association.run_all(rows, who, tests, covariates, components, weights, config.plan(a))
    except burden.TooFewCases as e:
        log.warning("no association: %s", e)
        return None


def analyse(spark: SparkSession, s: Settings, presets: dict[str, str] | None = None) -> Result:
    stored = typed.is_store(spark, s.vcf)
    raw = typed.header_lines(spark, s.vcf) if stored else vcf.lines(spark, s.vcf)
    samples, header = vcf.sample_names(raw), vcf.header_fields(raw)
    plain_schema = filter_schema(header)
    schema = typed.stored_schema(plain_schema, header) if stored else plain_schema
    wanted = text.with_fields(" ".join(s.fields), PROFILE_FIELDS[s.profile] if s.profile_fields else []).split()
    if absent := vcf.missing_fields(header, wanted):
        log.warning("fields that the header does not name: %s", ", ".join(absent))
    steps = Steps(spark, s.work or shared_dir(spark, "steps"), {k: v for k, v in asdict(s).items() if k in ("vcf", "genes", "gene_regions", "gene_coordinates", "capture_regions", "expand", "prefilter", "presets", "filter", "profile", "pair", "late_filter", "extra_sample_fields")} | {"known": presets}, restart=s.restart, buckets=s.buckets)

    def filtered() -> DataFrame:
        regions = _regions(spark, s)
        if stored and regions is not None:
            records = vcf.scan_regions(spark, s.vcf, regions)
        elif stored:
            records = typed.read_store(spark, s.vcf)
        else:
            records = vcf.parsed(vcf.region_lines(spark, s.vcf, regions))
            records = vcf.overlapping(records, regions) if regions is not None else records
        if s.prefilter:
            records = records.where(compile_filter(s.prefilter, schema))
        if (s.presets or s.filter) and not s.late_filter:
            records = records.where(compile_filter(composed(s.presets, s.filter, s.profile, presets, s.pair), schema))
        records = typed.records_of(records) if stored else records
        key = genotype.variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"))
        return records.withColumns({"variant_id": key, "gene": text.ann_subfield(F.element_at("info", F.lit("ANN")), "GENE")})

    base = steps.step("records", filtered)
    if (s.presets or s.filter) and s.late_filter:
        base = base.where(compile_filter(composed(s.presets, s.filter, s.profile, presets, s.pair), plain_schema))
    calls = steps.step("calls", lambda: vcf.calls(base, samples, extra=s.extra_sample_fields).withColumnRenamed("variant_key", "variant_id"), key="variant_id")
    if absent := [n for n in s.extra_sample_fields if header.where((F.col("source") == "FORMAT") & (F.col("id") == n)).isEmpty()]:
        raise ValueError(f"no sample fields {', '.join(absent)} in the header")
    if s.genotype_modes or s.genotype_rules:
        if s.genotype_rules:
            calls = annotate.modes_by_gene(calls, tables.read_genotype_rules(spark, s.genotype_rules), s.genotype_modes).drop("reasons")
        else:
            calls = annotate.genotype_filter(calls, F.array(*map(F.lit, s.genotype_modes))).drop("reasons")
        base = base.join(calls.select("variant_id").distinct(), "variant_id", "left_semi")
    own = ("variant_id", "chrom", "pos", "ref", "alt", "gene")
    # names are case-insensitive: what the fixed columns already hold is not extracted again
    extracted = [f for f in wanted if f.lower() not in own and f != "ANN[0].GENE"]
    if s.transcripts and "ANN[0].FEATUREID" not in extracted:
        extracted.append("ANN[0].FEATUREID")

    def extract() -> DataFrame:
        rows = annotate.first_rows(vcf.fields(base, extracted, samples, own))
        rows = rows.withColumnsRenamed({f"ANN_0__{n}": n for n in ("EFFECT", "IMPACT", "HGVS_P", "HGVS_C", "FEATUREID")})
        if s.transcripts:
            rows = annotate.of_transcripts(rows, [r.value for r in tables.read_lines(spark, s.transcripts).collect()])
        return rows.join(annotate.packed(calls, delimiter=s.extra_sample_delimiter), "variant_id", "left")

    every = {k: v for k, v in asdict(s).items() if k not in ("work", "restart")}
    fields_only = {k: every[k] for k in ("fields", "profile_fields", "transcripts", "genotype_modes", "genotype_rules", "extra_sample_delimiter", "late_filter")}
    # every annotation is made from this table by itself and joined to it once, so the plan grows with their number
    plain = steps.step("fields", extract, fields_only, key="variant_id")
    people = spark.createDataFrame([(n, i) for i, n in enumerate(samples)], "sample_id string, place int")
    terms = None
    if s.phenotypes:
        terms = tables.read_phenotypes(spark, s.phenotypes, s.sample_column, s.value_column)
        if s.remove_from_samples:
            terms = burden.by_shortened_ids(people, terms, s.remove_from_samples)
    who = _who(spark, s, people, terms)
    jobs = annotate.report_jobs(plain, calls, tables.read_reads(spark, s.reads)) if s.reads else None

    def annotated() -> DataFrame:
        parts: list[DataFrame] = []
        labels = [annotate.region_labels(plain, tables.read_bed(spark, p, labelled=True)) for p in s.annotate_regions]
        labels += [annotate.gene_list_labels(plain, tables.read_gene_list(spark, p)) for p in s.annotate_gene_lists]
        mapping = json.loads(s.gene_json_mapping or "{}")
        attributes = [tables.read_gene_json(spark, p, mapping["identifier"], mapping.get("dataFields", [])) for p in s.gene_json]
        key = plain.select("variant_id")
        if s.gene_json_columns and attributes:
            parts.append(annotate.attribute_columns(plain.select("variant_id", "gene"), annotate.merged_attributes(attributes), mapping.get("dataFields", [])).drop("gene"))
        else:
            labels += [annotate.attribute_labels(plain, a) for a in attributes]
        if labels:
            parts.append(annotate.custom_annotation(key, labels))
        if s.pm5_lookup:
            change = text.protein_change(F.col("HGVS_P"))
            told = plain.select("variant_id", "gene", change["ref_aa"].alias("ref_aa"), change["aa_pos"].alias("aa_pos"), change["alt_aa"].alias("alt_aa"))
            parts.append(annotate.pm5(told, tables.read_pm5_lookup(spark, s.pm5_lookup)).select("variant_id", "PM5", "PM5_evidence_count", "PM5_known_variants"))
        if s.pedigree:
            ped = tables.read_ped(spark, s.pedigree).withColumn("affected", F.col("affected_status") == "2")
            # as a table of known size, so that the engine broadcasts it where it is small, and calls stay in their buckets
            fam = materialised(inheritance.family(ped, people), "family")
            found = inheritance.analysed(calls, plain.select("variant_id", "chrom"), fam, detailed=s.inheritance_mode == "full")
            parts.append(inheritance.as_columns(found, s.inheritance_mode))
        if terms is not None:
            parts.append(annotate.phenotype_text(calls, terms))
        if who is not None:
            parts.append(burden.variant_counts(calls, who))
        rows = plain
        for part in parts:
            rows = rows.join(part, "variant_id", "left")
        if jobs is not None:
            rows = annotate.with_reports(rows, jobs)
        if s.scoring_model:
            rows = scoring.apply_scoring(rows, tables.read_scoring_model(s.scoring_model))
        return scoring.final_filter(rows, s.final_filter) if s.final_filter else rows

    variants = steps.step("annotated", annotated, every, key="variant_id")
    variants = identifiers.links(identifiers.variant_ids(variants), s.links)
    stats, made = None, {}
    if s.statistics:
        asked = None
        if s.statistics != "default":
            with open(s.statistics, encoding="utf-8") as f:
                asked = json.load(f)
        upper = {"gene": "GENE", "chrom": "CHROM", "pos": "POS", "ref": "REF", "alt": "ALT"}
        made = statistics.configured(variants.withColumnsRenamed({k: v for k, v in upper.items() if v not in variants.columns}), asked)
        stats = made["dataset"]
    table = burden.gene_burden(calls, who, s.burden_mode, s.correction) if s.burden_mode and who is not None else None
    tested = _tested(spark, s, calls, variants, who) if s.association and who is not None else None
    names = None
    if s.pseudonyms:
        ways = {"sequential": identifiers.sequential, "anonymous": identifiers.anonymous, "custom": lambda p: identifiers.custom(p, s.pseudonym_pattern)}
        if s.pseudonyms not in (*ways, "categorical"):
            raise ValueError(f"no pseudonyms {s.pseudonyms}: {', '.join(ways)}, categorical are known")
        if s.pseudonyms == "categorical":
            names = identifiers.categorical(_categories(people, s.pseudonym_category, who, terms), "category")
        else:
            names = ways[s.pseudonyms](people)
        told = ["GT", "phenotypes", "Inheritance_Details", "Inheritance_Samples", "links"]
        variants = identifiers.pseudonymised_text(variants, [c for c in told if c in variants.columns], names)
        calls = identifiers.pseudonymised_calls(calls, names)
    family = None
    if s.pseudonym_pedigree:
        if names is None or not s.pedigree:
            raise ValueError("a pedigree under pseudonyms needs pseudonyms and a pedigree")
        family = identifiers.pseudonymised_pedigree(tables.read_ped(spark, s.pedigree), names)
    return Result(variants, calls, stats, table, tested, made, names, family, jobs, steps)


def _categories(people: DataFrame, by: str, who: DataFrame | None, terms: DataFrame | None) -> DataFrame:
    """sample_id, category: case or control (cohort), or the sample's first term; null where there is none."""
    if by == "cohort":
        found = who.select("sample_id", F.when(F.col("is_case"), "case").otherwise("control").alias("category")) if who is not None else None
    elif by == "term":
        found = terms.select("sample_id", F.get("terms", F.lit(0)).alias("category")) if terms is not None else None
    else:
        raise ValueError(f"no categories by {by}: cohort and term are known")
    if found is None:
        raise ValueError(f"nothing tells the samples' {by}")
    return people.select("sample_id").join(found, "sample_id", "left")


def write(found: Result, s: Settings, out: str, formats: list[str]) -> None:
    """The tables as folders, and what the formats ask for: tsv (one file), xlsx, html, json, archive."""
    spark = found.variants.sparkSession
    base = text.short_name(text.output_name(s.vcf, s.genes))
    names = config.workspace(out, base)
    sinks.write_tsv(found.variants, f"{out}/variants")
    parts = {"statistics": found.statistics, "gene_burden": found.burden, "association": found.association}
    parts |= {f"statistics_{n}": t for n, t in found.tables.items() if n != "dataset"}
    for name, part in parts.items():
        if part is not None:
            sinks.write_tsv(part, f"{out}/{name}")
    if found.jobs is not None:
        sinks.write_tsv(found.jobs, f"{out}/report_jobs")
    if found.pseudonyms is not None:
        sinks.write_pseudonyms(found.pseudonyms, f"{out}/pseudonyms.tsv", s.pseudonyms, s.pseudonym_pattern)
    if found.pedigree is not None:
        sinks.write_tsv(found.pedigree, f"{out}/pedigree")
    told = {"vcf": s.vcf, "filter": s.filter or "", "presets": " ".join(s.presets), "profile": s.profile}
    sinks.write_metadata(spark, out, told)
    shown = found.variants.withColumnsRenamed({"gene": "GENE"})
    if "tsv" in formats:
        sinks.write_one_tsv(found.variants, f"{names['variants']}.tsv.gz")
    if "xlsx" in formats:
        extra = {"Metadata": spark.createDataFrame(list(told.items()), "Parameter string, Value string")}
        extra |= {n: p for n, p in (("Statistics", found.statistics), ("Gene Burden", found.burden), ("Association", found.association)) if p is not None}
        sheets.write_workbook(spark, {"Results": found.variants, **extra}, f"{names['variants']}.xlsx")
    if {"json", "html"} & {*formats} and "IMPACT" in shown.columns:
        summary = report.summary(shown, found.calls)
        if "json" in formats:
            sinks.write_report_json(found.variants, summary, f"{out}/report")
        if "html" in formats:
            sheets.write_page(spark, found.variants, summary.first().asDict(recursive=True), f"{out}/report/index.html", PROFILE_HIDDEN[s.profile])
    if found.association is not None and (folder := s.association.get("diagnostics_output")):
        tests = [c.removesuffix("_pvalue") for c in found.association.columns if c.endswith("_pvalue")]
        pairs = ", ".join(f"'{t}', {t}_pvalue" for t in tests)
        long = found.association.selectExpr("gene", "warnings", f"stack({len(tests)}, {pairs}) AS (test, p_value)")
        first = found.association.select("n_cases", "n_controls").first()
        association.write_diagnostics(long, folder, cohort=tuple(first) if first else (0, 0))
    if found.steps is not None:
        put_text(spark, f"{out}/steps.tsv", "".join(f"{n}\t{state}\n" for n, state in found.steps.done))
    if "archive" in formats:
        sinks.write_archive(spark, out, names["archive"])


def main(argv: list[str] | None = None) -> None:
    """python -m helicase.plans.analysis --vcf x.vcf.gz --out folder ..."""
    from helicase.session import session

    p = argparse.ArgumentParser(description="Variant analysis on Spark")
    p.add_argument("--vcf")
    p.add_argument("--out")
    p.add_argument("--config", help="JSON with presets, field_profiles, links and association")
    p.add_argument("--list-profiles", action="store_true", help="tell the annotation releases and end")
    p.add_argument("--list-fields", action="store_true", help="tell the VCF's fields and end")
    p.add_argument("--formats", nargs="*", default=[], choices=["tsv", "xlsx", "html", "json", "archive"])
    single = (
        "genes", "gene-regions", "gene-coordinates", "capture-regions", "prefilter", "filter", "profile", "final-filter", "transcripts", "pedigree", "inheritance-mode", "phenotypes", "sample-column", "value-column", "trait-column",
        "case-samples", "control-samples", "remove-from-samples", "gene-json-mapping", "pm5-lookup", "scoring-model", "statistics", "burden-mode", "correction", "reads", "pseudonyms", "pseudonym-pattern", "pseudonym-category", "genotype-rules", "extra-sample-delimiter", "work", "restart",
    )
    for name in single:
        p.add_argument(f"--{name}")
    for name in ("presets", "case-terms", "control-terms", "annotate-regions", "annotate-gene-lists", "gene-json", "fields", "genotype-modes", "extra-sample-fields"):
        p.add_argument(f"--{name}", nargs="*")
    for name in ("late-filter", "profile-fields", "gene-json-columns", "pseudonym-pedigree"):
        p.add_argument(f"--{name}", action="store_true", default=None)
    p.add_argument("--expand", type=int)
    p.add_argument("--buckets", type=int)
    pair = {"tumor-sample-index": ("tumor_idx", int), "normal-sample-index": ("normal_idx", int), "tumor-dp-min": ("tumor_dp_min", int), "normal-dp-min": ("normal_dp_min", int), "tumor-af-min": ("tumor_af_min", float), "normal-af-max": ("normal_af_max", float)}
    for name, (key, kind) in pair.items():
        p.add_argument(f"--{name}", type=kind, dest=f"pair_{key}")
    own = {"association-tests": None, "covariate-file": str, "covariate-columns": None, "variant-weights": str, "pca-file": str, "pca-tool": str, "pca-components": int, "gene-prior-weights": str, "diagnostics-output": str, "missing-site-threshold": float, "missing-sample-threshold": float}
    for name, kind in own.items():
        p.add_argument(f"--{name}", dest=f"test_{name.replace('-', '_')}", **({"nargs": "*"} if kind is None else {"type": kind}))
    args = {k: v for k, v in vars(p.parse_args(argv)).items() if v is not None}
    spark = session()
    if args.pop("list_profiles"):
        print("\n".join(f"{x['name']}: {x['description']}" for x in profiles()))
        return
    if "vcf" not in args:
        p.error("--vcf is needed")
    if args.pop("list_fields"):
        print(vcf.told_fields(vcf.header_fields(vcf.lines(spark, args["vcf"]))))
        return
    if "out" not in args:
        p.error("--out is needed")
    out, path, presets, formats = args.pop("out"), args.pop("config", None), None, args.pop("formats")
    if path:
        with open(path, encoding="utf-8") as f:
            args["association"] = json.load(f).get("association", {})
        presets, fragments, args["links"] = load_settings(path)
        PROFILES.update(fragments)
        for n in fragments:
            PROFILE_FIELDS.setdefault(n, [])
            PROFILE_HIDDEN.setdefault(n, [])
    args["pair"] = {k.removeprefix("pair_"): args.pop(k) for k in [k for k in args if k.startswith("pair_")]}
    tests = {k.removeprefix("test_"): args.pop(k) for k in [k for k in args if k.startswith("test_")]}
    args["association"] = args.get("association", {}) | tests
    s = Settings(**args)
    faults = config.input_faults(spark, s.vcf, s.phenotypes, s.sample_column, s.value_column, [s.pedigree, s.pm5_lookup, s.transcripts, s.reads], s.fields)
    faults += config.annotation_faults(spark, s.annotate_regions, s.annotate_gene_lists, s.gene_json, s.gene_json_mapping)
    faults += config.association_faults(s.association)
    if faults:
        raise SystemExit("\n".join(faults))
    write(analyse(spark, s, presets), s, out, formats)


if __name__ == "__main__":
    main()
