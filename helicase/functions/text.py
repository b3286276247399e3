"""Text scalars: annotation subfields, protein changes, names, links."""

from __future__ import annotations

import hashlib
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Positions of the subfields of an ANN entry.
ANN_FIELDS = ("ALLELE", "EFFECT", "IMPACT", "GENE", "GENEID", "FEATURE", "FEATUREID", "BIOTYPE", "RANK", "HGVS_C", "HGVS_P", "CDNA", "CDS", "AA", "DISTANCE", "ERRORS")
# Three-letter to one-letter amino acids.
AMINO = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I", "Leu": "L",
    "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V", "Ter": "*", "Sec": "U", "Pyl": "O",
}
# Effects that count as protein truncating.
PTV_EFFECTS = ("stop_gained", "frameshift_variant", "splice_acceptor_variant", "splice_donor_variant")


def blank_as_null(c: Column) -> Column:
    """Null for the spellings of a missing cell."""
    return F.when(~c.isin(".", "", "NA", "./."), c)


def or_na(c: Column) -> Column:
    return F.coalesce(c, F.lit("NA"))


def ann_subfield(ann: Column, name: str) -> Column:
    """A subfield of the first ANN entry; AA_POS and AA_LEN are the halves of AA; NA if there is none."""
    part = "AA" if name in ("AA_POS", "AA_LEN") else name
    value = F.get(F.split(F.get(F.split(ann, ","), F.lit(0)), "[|]"), F.lit(ANN_FIELDS.index(part)))
    if name != part:
        value = F.get(F.split(value, "/"), F.lit(int(name == "AA_LEN")))
    return or_na(blank_as_null(value))


def nmd_subfield(nmd: Column, position: int = 0) -> Column:
    return or_na(blank_as_null(F.get(F.split(F.get(F.split(nmd, ","), F.lit(0)), "[|]"), F.lit(position))))


def amino(aa: Column) -> Column:
    """One-letter code; what is not a known three-letter code stays."""
    table = F.create_map(*[F.lit(x) for kv in AMINO.items() for x in kv])
    return F.coalesce(F.element_at(table, aa), aa)


def protein_change(hgvs: Column) -> Column:
    """struct<ref_aa, aa_pos, alt_aa> of a substitution or stop, in parentheses or not; null fields for anything else,
    frameshifts too."""
    three, one = r"p\.\(?([A-Z][a-z]{2})(\d+)([A-Z][a-z]{2}|\*)(?![a-z])", r"p\.\(?([A-Z])(\d+)([A-Z*])(?![a-z])"
    is_three, is_one = hgvs.rlike(three), hgvs.rlike(one)

    def part(i: int) -> Column:
        return F.when(is_three, F.regexp_extract(hgvs, three, i)).when(is_one, F.regexp_extract(hgvs, one, i))

    return F.struct(amino(part(1)).alias("ref_aa"), part(2).try_cast("int").alias("aa_pos"), amino(part(3)).alias("alt_aa"))


def genes_of(cell: Column) -> Column:
    """Upper-case genes of a cell, split at the first of , ; | & that it has."""
    c = F.upper(cell)
    parts = F.when(c.contains(","), F.split(c, ",")).when(c.contains(";"), F.split(c, ";")).when(c.contains("|"), F.split(c, "[|]")).otherwise(F.split(c, "&"))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def ensembl_gene(c: Column) -> Column:
    return F.regexp_extract(c, r"(ENSG\d+)", 1)


def review_stars(status: Column) -> Column:
    s = F.lower(status)
    return (
        F.when(s.contains("practice guideline"), 4).when(s.contains("reviewed by expert panel"), 3)
        .when(s.contains("multiple submitters") & s.contains("no conflicts"), 2)
        .when(s.contains("criteria provided"), 1).otherwise(0)
    )


def simple_significance(c: Column) -> Column:
    """P for pathogenic (alone or with likely), LP for likely pathogenic."""
    return F.when(F.lower(c).startswith("likely pathogenic"), "LP").when(F.lower(c).contains("pathogenic"), "P")


def leading_effect(effect: Column) -> Column:
    """Of &-joined effects the first truncating one, else missense, else the first."""
    parts = F.split(effect, "&")
    truncating = F.get(F.filter(parts, lambda x: x.isin(*PTV_EFFECTS)), F.lit(0))
    return F.coalesce(truncating, F.when(F.array_contains(parts, "missense_variant"), F.lit("missense_variant")), F.get(parts, F.lit(0)))


def link(template: str, columns: list[str]) -> Column:
    """A template's {COLUMN} replaced by values; empty if it names a column that is not there or is null."""
    pieces = re.split(r"\{(\w+)\}", template)
    if any(name not in columns for name in pieces[1::2]):
        return F.lit("")
    parts = [F.col(p).cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces)]
    return F.coalesce(F.concat(*parts), F.lit(""))


def metadata_field(c: Column) -> Column:
    return F.trim(F.translate(c, "\t\n\r", "   "))


# names, on the driver


def identifier(name: str) -> str:
    clean = re.sub(r"[^a-zA-Z0-9_]", "_", name)
    return f"col_{clean}" if clean[:1].isdigit() else clean


def identifiers(names: list[str]) -> dict[str, str]:
    """Column names as identifiers; equal ones get _2, _3 and so on."""
    out, seen = {}, {}
    for name in names:
        clean = identifier(name)
        seen[clean] = seen.get(clean, 0) + 1
        out[name] = clean if seen[clean] == 1 else f"{clean}_{seen[clean]}"
    return out


# Prefixes of extracted fields and what stands for them in a report's header.
HEADER_PREFIXES = (("ANN[*].", ""), ("ANN[0].", ""), ("GEN[*].", ""), ("GEN[0].", ""), ("NMD[*].", "NMD_"), ("NMD[0].", "NMD_"), ("LOF[*].", "LOF_"), ("LOF[0].", "LOF_"))
# Short names of the extracted columns that everything downstream expects.
ALIASES = {f"ANN_0__{n}": n for n in ("GENE", "EFFECT", "IMPACT", "HGVS_C", "HGVS_P", "FEATUREID")}


def header_name(name: str) -> str:
    """GEN[3].DP -> DP_3, ANN[0].X and GEN[*].X -> X, NMD[0].X -> NMD_X, LOF[*].X -> LOF_X."""
    name = re.sub(r"GEN\[(\d+)\]\.(\w+)", r"\2_\1", name)
    for prefix, short in HEADER_PREFIXES:
        name = name.replace(prefix, short)
    return name


def with_fields(fields: str, extra: list[str]) -> str:
    """A field list separated by blanks with those appended that it lacks."""
    out = fields.split()
    out += [f for f in dict.fromkeys(extra) if f not in out]
    return " ".join(out)


# What makes a column's name that of numbers.
NUMERIC_NAMES = re.compile(r"(^|_)(AF|AC|AD|DP|GQ)(_|$)|score|phred|frequency", re.I)


def numeric_names(names: list[str]) -> list[str]:
    """Columns that hold numbers by their names."""
    return [n for n in names if NUMERIC_NAMES.search(n)]


def annotation_name(stem: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^a-zA-Z0-9_]", "_", stem)).strip("_")


def list_name(path: str) -> str:
    """A column name for a gene list file: without its extensions, letters, digits and single _; never empty or numeric."""
    base = path.rsplit("/", 1)[-1]
    first = base.rsplit(".", 1)[0] if "." in base.lstrip(".") else base
    stem = re.sub(r"(\.(txt|list|tsv|csv|genes|gene))+$", "", first, flags=re.I) or first
    clean = re.sub(r"_+", "_", re.sub(r"[^\w]", "_", stem)).strip("_") or "unnamed_list"
    return f"list_{clean}" if clean[0].isdigit() else clean


def short_name(base: str, most: int = 50) -> str:
    """A file name that is safe everywhere; long ones are cut and end in a hash."""
    clean = re.sub(r"[^A-Za-z0-9._-]", "_", base)
    return clean if len(clean) <= most else f"{clean[: most - 9]}_{hashlib.md5(base.encode()).hexdigest()[:8]}"


def output_name(vcf: str, genes: str) -> str:
    stem = re.sub(r"\.(vcf|bcf)(\.gz|\.bgz)?$", "", vcf.rsplit("/", 1)[-1])
    listed = sorted(set(genes.replace(",", " ").split()))
    return f"{stem}.{listed[0]}" if len(listed) == 1 else f"{stem}.{hashlib.md5(' '.join(listed).encode()).hexdigest()[:8]}"


def joined(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)
