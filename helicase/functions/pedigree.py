"""Inheritance rules for one variant in plain Python: what the Column rules of operators/inheritance.py must say."""

from __future__ import annotations

from dataclasses import dataclass

from helicase.model import CHROM_MT, CHROM_X

MISSING = -1


@dataclass(frozen=True)
class Child:
    """A sample and its parents' dosages: MISSING without a call, None for a parent who is not among the samples."""

    dosage: int
    father: int | None
    mother: int | None
    sex: str = "0"
    affected: bool = True
    father_affected: bool = False
    mother_affected: bool = False


def _has(dosage: int | None) -> bool:
    return dosage is not None and dosage > 0


def recessive(k: Child) -> str | None:
    if not (k.affected and k.dosage == 2):
        return None
    if _has(k.father) and _has(k.mother):
        return "autosomal_recessive"
    parents = (k.father, k.mother)
    return "autosomal_recessive_possible" if MISSING in parents and all(_has(p) or p == MISSING for p in parents) else None


def dominant(k: Child) -> str | None:
    if not k.affected:
        return None
    if (_has(k.father) and k.father_affected) or (_has(k.mother) and k.mother_affected):
        return "autosomal_dominant"
    return "autosomal_dominant_possible" if _has(k.father) or _has(k.mother) or MISSING in (k.father, k.mother) else None


def x_recessive(k: Child) -> str | None:
    if not k.affected:
        return None
    if k.sex == "1":
        if k.mother is None:
            return "x_linked_recessive_possible"
        if _has(k.father) or k.mother == 0:
            return None
        return "x_linked_recessive" if _has(k.mother) else "x_linked_recessive_possible"
    if k.sex == "2" and k.dosage == 2:
        if _has(k.father) and _has(k.mother):
            return "x_linked_recessive"
        return "x_linked_recessive_possible" if any(p is None or p == MISSING for p in (k.father, k.mother)) else None
    return None


def x_dominant(k: Child) -> bool:
    """Whether it is clear; else an affected carrier may still have it."""
    return k.affected and ((k.sex == "2" and _has(k.father) and k.father_affected) or (_has(k.mother) and k.mother_affected))


def patterns_of(children: list[Child], chrom: str) -> list[str]:
    """All patterns of a variant, its samples in order, each once; a possible dominant X pattern is told only while no sample
    so far showed a clear one."""
    out: list[str] = []
    clear = False
    for k in children:
        if k.dosage <= 0:
            continue
        found: list[str | None] = []
        if k.father is not None and k.mother is not None:
            if k.father == 0 and k.mother == 0:
                found.append("de_novo")
            elif k.affected and MISSING in (k.father, k.mother):
                found.append("de_novo_candidate")
        found += [dominant(k), recessive(k)]
        if chrom in CHROM_X:
            found.append(x_recessive(k))
            clear = clear or x_dominant(k)
            found.append("x_linked_dominant" if x_dominant(k) else "x_linked_dominant_possible" if k.affected and not clear else None)
        if chrom in CHROM_MT and (k.mother is None or _has(k.mother)):
            found.append("mitochondrial")
        told = [f for f in found if f] or ["unknown" if k.affected else "carrier"]
        out += [f for f in told if f not in out]
    return out
