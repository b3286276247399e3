"""What a run may be told, checked before it starts: every fault is named at once."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

from helicase.functions.weights import PARAMETERS, parse_spec
from helicase.operators import association as tests
from helicase.operators.burden import Interval
from helicase.sources.store import exists


# Names and defaults of the settings.
@dataclass
class Association:
    """How genes are tested."""

    association_tests: list[str] | None = None
    correction_method: str = "fdr"
    gene_burden_mode: str = "samples"
    confidence_interval_method: str = "normal_approx"
    confidence_interval_alpha: float = 0.05
    continuity_correction: float = 0.5
    covariate_file: str | None = None
    covariate_columns: list[str] | None = None
    categorical_covariates: list[str] | None = None
    trait_type: str = "binary"
    variant_weights: str = "beta:1,25"
    variant_weight_params: dict | None = None
    missing_site_threshold: float = 0.10
    missing_sample_threshold: float = 0.80
    firth_max_iter: int = 25
    skat_backend: str = "python"
    skat_method: str = "SKAT"
    min_cases: int = 200
    max_case_control_ratio: float = 20.0
    min_case_carriers: int = 10
    diagnostics_output: str | None = None
    pca_file: str | None = None
    pca_tool: str | None = None
    pca_components: int = 10
    coast_weights: list[float] | None = None
    coast_backend: str = "python"
    coast_classification: str | None = None
    gene_prior_weights: str | None = None
    gene_prior_weight_column: str = "weight"


#: Values that some settings are limited to.
CHOICES = {
    "correction_method": ("fdr", "bonferroni"), "trait_type": ("binary", "quantitative"), "gene_burden_mode": ("samples", "alleles"), "confidence_interval_method": ("normal_approx", "score"), "skat_method": ("SKAT", "Burden", "SKATO"),
    "skat_backend": ("python", "auto"), "coast_backend": ("python", "auto"),
}


def _fits(value: object, kind: str) -> bool:
    kinds = [k.strip() for k in kind.split("|")]
    if value is None:
        return "None" in kinds
    if isinstance(value, bool):
        return False
    if "list[str]" in kinds and isinstance(value, list):
        return all(isinstance(x, str) for x in value)
    if "list[float]" in kinds and isinstance(value, list):
        return all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in value)
    return ("str" in kinds and isinstance(value, str)) or ("int" in kinds and isinstance(value, int)) or ("float" in kinds and isinstance(value, (int, float))) or ("dict" in kinds and isinstance(value, dict))


def association_faults(values: dict) -> list[str]:
    """Unknown names, wrong kinds of value, values that are none of those allowed."""
    known = {f.name: str(f.type) for f in fields(Association)}
    out = [f"unknown setting {k}" for k in sorted(set(values) - set(known))]
    for k, kind in known.items():
        if k not in values:
            continue
        if not _fits(values[k], kind):
            out.append(f"{k} is not of kind {kind}: {values[k]!r}")
        elif k in CHOICES and values[k] not in CHOICES[k]:
            out.append(f"{k} is none of {', '.join(CHOICES[k])}: {values[k]!r}")
    if isinstance(values.get("variant_weights"), str):
        try:
            parse_spec(values["variant_weights"])
        except ValueError as e:
            out.append(str(e))
    for k in ("confidence_interval_alpha", "missing_site_threshold", "missing_sample_threshold"):
        if isinstance(values.get(k), (int, float)) and not 0 < values[k] <= 1:
            out.append(f"{k} is not between 0 and 1: {values[k]!r}")
    if isinstance(values.get("coast_weights"), list) and (len(values["coast_weights"]) != 3 or not all(isinstance(w, (int, float)) and w > 0 for w in values["coast_weights"])):
        out.append(f"coast_weights are not three positive numbers: {values['coast_weights']!r}")
    if isinstance(values.get("variant_weight_params"), dict):
        out += [f"unknown parameter of weights: {k}" for k in sorted(set(values["variant_weight_params"]) - {*PARAMETERS})]
    if values.get("trait_type") == "quantitative" and {"fisher", "logistic_burden"} & {*(values.get("association_tests") or [])}:
        out.append("a quantitative trait needs other tests than fisher and logistic_burden")
    return out


def association(values: dict) -> Association:
    """The settings; ValueError names every fault."""
    if faults := association_faults(values):
        raise ValueError("association settings: " + "; ".join(faults))
    return Association(**values)


def plan(a: Association) -> tests.Plan:
    """What run_all is told."""
    return tests.Plan(
        weights=a.variant_weights, weight_params=a.variant_weight_params or {}, correction=a.correction_method, binary=a.trait_type == "binary", few_cases=a.min_cases, most_ratio=a.max_case_control_ratio,
        least_carriers=a.min_case_carriers, most_missing_site=a.missing_site_threshold, most_missing_sample=a.missing_sample_threshold, burden_mode=a.gene_burden_mode,
        interval=Interval(a.confidence_interval_method, a.confidence_interval_alpha, a.continuity_correction), series=tuple(a.coast_weights or (1.0, 2.0, 3.0)), skat_method=a.skat_method, firth_steps=a.firth_max_iter,
    )


def annotation_faults(spark: SparkSession, regions: list[str] = (), gene_lists: list[str] = (), gene_json: list[str] = (), mapping: str | None = None) -> list[str]:
    """Files that are not there, and a mapping of gene JSON that is absent, needless or not usable."""
    out = [f"no such file: {p}" for p in [*regions, *gene_lists, *gene_json] if not exists(spark, p)]
    if gene_json and not mapping:
        out.append("gene JSON needs a mapping")
    if mapping and not gene_json:
        out.append("a mapping without gene JSON")
    if mapping:
        try:
            told = json.loads(mapping)
            if not isinstance(told, dict) or "identifier" not in told:
                out.append("the mapping of gene JSON is an object with an identifier")
        except json.JSONDecodeError as e:
            out.append(f"the mapping of gene JSON is no JSON: {e}")
    return out


def input_faults(spark: SparkSession, vcf: str, phenotypes: str | None = None, sample_column: str | None = None, value_column: str | None = None, files: list[str] = (), fields_wanted: list[str] | None = None) -> list[str]:
    """What is wrong with the files and parameters of a run."""
    out = []
    if not any(c in vcf for c in "*?[{") and not exists(spark, vcf):
        out.append(f"no such VCF: {vcf}")
    elif spark.read.text(vcf).limit(1).count() == 0:
        out.append(f"empty VCF: {vcf}")
    if fields_wanted is not None and not fields_wanted:
        out.append("no fields to extract")
    if phenotypes:
        if not exists(spark, phenotypes):
            out.append(f"no such file: {phenotypes}")
        else:
            sep = "," if phenotypes.removesuffix(".gz").endswith(".csv") else "\t"
            head = spark.read.text(phenotypes).limit(2).collect()
            names = head[0].value.split(sep) if head else []
            out += [f"no column {c} in {phenotypes}" for c in (sample_column, value_column) if c not in names]
            if len(head) < 2:
                out.append(f"no rows in {phenotypes}")
    return out + [f"no such file: {p}" for p in files if p and not exists(spark, p)]


def workspace(out: str, base: str) -> dict[str, str]:
    """Where a run's files go: tables, steps, diagnostics and the archive beside the folder."""
    root = out.rstrip("/")
    return {"out": root, "steps": f"{root}/steps", "diagnostics": f"{root}/diagnostics", "variants": f"{root}/{base}.variants", "archive": f"{os.path.dirname(root) or '.'}/{base}.tar.gz"}
