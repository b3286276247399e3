"""Variant weights as Columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE = 1e-8


def beta_maf(maf: Column, a: float = 1.0, b: float = 25.0) -> Column:
    """Density of beta(a, b) at the minor allele frequency, kept off 0 and 1."""
    m = F.greatest(F.lit(EDGE), F.least(maf, F.lit(1 - EDGE)))
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))
    return F.lit(scale) * F.pow(m, F.lit(a - 1.0)) * F.pow(F.lit(1.0) - m, F.lit(b - 1.0))


def uniform() -> Column:
    return F.lit(1.0)


def cadd(maf: Column, phred: Column, cap: float = 40.0, a: float = 1.0, b: float = 25.0) -> Column:
    return beta_maf(maf, a, b) * F.coalesce(F.least(phred.try_cast("double") / cap, F.lit(1.0)), F.lit(1.0))


def revel(maf: Column, score: Column, a: float = 1.0, b: float = 25.0) -> Column:
    return beta_maf(maf, a, b) * F.coalesce(score.try_cast("double"), F.lit(1.0))


def combined(maf: Column, phred: Column | None, score: Column | None, cap: float = 40.0) -> Column:
    """CADD where there is a column for it, else REVEL, else the frequency alone."""
    return cadd(maf, phred, cap) if phred is not None else revel(maf, score) if score is not None else beta_maf(maf)


def parse_spec(spec: str) -> tuple[str, float, float]:
    """("beta", a, b) from beta:a,b; other names have the default shape."""
    name, _, rest = spec.partition(":")
    if name not in ("beta", "uniform", "cadd", "revel", "combined"):
        raise ValueError(f"no such weights: {spec}")
    a, b = (float(x) for x in rest.split(",")) if rest else (1.0, 25.0)
    return name, a, b


#: What the parameters of weights may be.
PARAMETERS = ("cadd_cap",)


def by_spec(spec: str, maf: Column, phred: Column | None = None, score: Column | None = None, cadd_cap: float = 40.0) -> Column:
    """Weights by their specification; cadd and revel without a column of scores raise, combined takes what there is."""
    name, a, b = parse_spec(spec)
    if (name == "cadd" and phred is None) or (name == "revel" and score is None):
        raise ValueError(f"weights {spec} need a column of {name} scores")
    if name == "uniform":
        return uniform()
    if name == "cadd":
        return cadd(maf, phred, cadd_cap, a, b)
    if name == "revel":
        return revel(maf, score, a, b)
    if name == "combined":
        return combined(maf, phred, score, cadd_cap)
    return beta_maf(maf, a, b)
