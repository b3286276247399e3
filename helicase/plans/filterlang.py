"""Filter expressions of variant tools, compiled to a Column.

One Pratt parser serves two dialects.  ``snpsift``: = != < <= > >= =~ !~ has in & | ! na exists, indexes [0] [*] [ANY]
[n], functions isHom isHet isRef isVariant.  ``bcf``: == = != < <= > >= ~ !~ && || & | ! with arithmetic.

A Schema says where fields are: plain columns, arrays (ANN[ANY].X: any element; ANN[2].X: that one), per-sample arrays
(GEN[i].X).  A comparison with a number casts its field, a failed cast or a null makes the comparison false; an array
without an index, or with * or ANY, holds if any element does.  A syntax error raises, it never passes rows.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from helicase.functions import genotype

TOKEN = re.compile(
    r"""\s*(?:(?P<number>(?:\d+\.\d*|\.\d+|\d+)(?:[eE][-+]?\d+)?)(?![\w.])|(?P<text>'[^']*'|"[^"]*")"""
    r"""|(?P<name>[A-Za-z_][\w.+:/]*(?:\[[^\]]*\](?:\.[\w.]+)?)?)|(?P<op>&&|\|\||=~|!~|==|!=|<=|>=|[-+*/%()<>=!&|~,]))"""
)
INDEXED = re.compile(r"([\w.+:/]+)\[([^\]]*)\](?:\.([\w.]+))?$")
COMPARE = {"=", "==", "!=", "<", "<=", ">", ">=", "=~", "!~", "~", "has", "in"}
BINDING = {"|": 1, "||": 1, "&": 2, "&&": 2, **dict.fromkeys(COMPARE, 4), "+": 5, "-": 5, "*": 6, "/": 6, "%": 6}


class FilterSyntaxError(ValueError):
    pass


@dataclass
class Schema:
    """scalars: columns by field name; arrays: array columns by (base, field), as ("ANN", "IMPACT") or ("GEN", "AF")."""

    scalars: dict[str, Column] = field(default_factory=dict)
    arrays: dict[tuple[str, str | None], Column] = field(default_factory=dict)
    #: Stored columns by the name as an expression has it: as numbers, whether there is a value, as text.  Comparisons with
    #: them are such as files' statistics can answer.
    numbers: dict[str, Column] = field(default_factory=dict)
    presence: dict[str, Column] = field(default_factory=dict)
    texts: dict[str, Column] = field(default_factory=dict)

    def resolve(self, name: str) -> tuple[Column, bool]:
        """The field's Column, and whether it has many values."""
        if m := INDEXED.match(name):
            base, index, part = m.groups()
            found = self.arrays.get((base, part))
            if found is None and part is None and base in self.scalars:
                return self.scalars[base], False
            if found is None and (plain := self.scalars.get(part or base)) is not None and base in ("ANN", "EFF", "NMD", "LOF"):
                return plain, False
            if found is None:
                raise FilterSyntaxError(f"no field {name}")
            if index in ("*", "ANY", "ALL", ""):
                return found, True
            if not index.isdigit():
                raise FilterSyntaxError(f"bad index in {name}")
            return F.get(found, F.lit(int(index))), False
        if name in self.scalars:
            return self.scalars[name], False
        if (name, None) in self.arrays:
            return self.arrays[name, None], True
        head, _, tail = name.rpartition("/")
        if head in ("INFO", "FORMAT", "FMT") or not head:
            tail = tail or name
            if tail in self.scalars:
                return self.scalars[tail], False
            if ("GEN", tail) in self.arrays:
                return self.arrays["GEN", tail], True
        raise FilterSyntaxError(f"no field {name}")


def tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m or m.end() == at:
            raise FilterSyntaxError(f"cannot read {text[at:at + 20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return [*out, ("end", "")]


class Parser:
    """Trees: ("field", name), ("number", x), ("text", s), ("not", e), ("na", f), ("exists", f), ("call", f, args), (op, a, b)."""

    def __init__(self, text: str) -> None:
        self.tokens, self.at = tokens(text), 0

    def next(self) -> tuple[str, str]:
        self.at += 1
        return self.tokens[self.at - 1]

    def expect(self, op: str) -> None:
        if self.next() != ("op", op):
            raise FilterSyntaxError(f"expected {op!r}")

    def whole(self) -> tuple:
        tree = self.expression(0)
        if self.tokens[self.at][0] != "end":
            raise FilterSyntaxError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def expression(self, least: int) -> tuple:
        left = self.prefix()
        while True:
            kind, value = self.tokens[self.at]
            bound = BINDING.get(value) if kind == "op" or (kind == "name" and value in ("has", "in")) else None
            if bound is None or bound <= least:
                return left
            self.at += 1
            left = (value, left, self.expression(bound))

    def prefix(self) -> tuple:
        kind, value = self.next()
        if (kind, value) == ("op", "("):
            inner = self.expression(0)
            self.expect(")")
            return inner
        if kind == "op" and value == "!":
            return ("not", self.expression(3))
        if kind == "op" and value == "-":
            return ("-", ("number", 0.0), self.expression(6))
        if kind == "number":
            return ("number", float(value))
        if kind == "text":
            return ("text", value[1:-1])
        if kind == "name" and value in ("na", "exists"):
            return (value, self.prefix())
        if kind == "name":
            if self.tokens[self.at] == ("op", "("):
                self.at += 1
                args = [self.expression(0)]
                while self.tokens[self.at] == ("op", ","):
                    self.at += 1
                    args.append(self.expression(0))
                self.expect(")")
                return ("call", value, args)
            return ("field", value)
        raise FilterSyntaxError(f"unexpected {value or 'end'!r}")


CALLS: dict[str, Callable[[Column], Column]] = {"isHom": lambda g: genotype.is_hom_alt(g) | genotype.is_ref(g), "isHet": genotype.is_het, "isRef": genotype.is_ref, "isVariant": genotype.is_variant}


COMPARED: dict[str, Callable[[Column, Column], Column]] = {"=": operator.eq, "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


class Compiler:
    def __init__(self, schema: Schema) -> None:
        self.schema = schema

    def present(self, c: Column, many: bool) -> Column:
        if many:
            return F.coalesce(F.exists(c, lambda x: x.isNotNull() & ~x.cast("string").isin(".", "", "NA")), F.lit(False))
        return c.isNotNull() & ~c.cast("string").isin(".", "", "NA")

    def value(self, tree: tuple) -> tuple[Column, bool, str]:
        """Column, whether it has many values, and number, text or field."""
        kind = tree[0]
        if kind == "field":
            return *self.schema.resolve(tree[1]), "field"
        if kind in ("number", "text"):
            return F.lit(tree[1]), False, kind
        if kind in ("+", "-", "*", "/", "%"):
            a, b = (self.value(t)[0].try_cast("double") for t in tree[1:])
            out = {"+": a + b, "-": a - b, "*": a * b, "/": a / F.nullif(b, F.lit(0.0)), "%": a % F.nullif(b, F.lit(0.0))}[kind]
            return out, False, "number"
        raise FilterSyntaxError(f"{kind} is not a value")

    def compare(self, op: str, left: tuple, right: tuple) -> Column:
        if left[0] in ("number", "text") and right[0] == "field" and op not in ("has", "in", "=~", "!~", "~"):
            left, right, op = right, left, {"<": ">", "<=": ">=", ">": "<", ">=": "<="}.get(op, op)
        stored = self.schema.numbers if right[0] == "number" else self.schema.texts if right[0] == "text" and op in ("=", "==", "!=") else {}
        if left[0] == "field" and op in COMPARED and left[1] in stored:
            return stored[left[1]].isNotNull() & COMPARED[op](stored[left[1]], F.lit(right[1]))
        a, many, _ = self.value(left)
        b, _, kind = self.value(right)

        def one(x: Column) -> Column:
            if op in ("=~", "~", "!~"):
                hit = x.cast("string").rlike(right[1]) if kind == "text" else x.cast("string").rlike(b)
                return ~hit if op == "!~" else hit
            if op in ("has", "in"):
                return F.array_contains(F.split(x.cast("string"), "[&,;|]"), b.cast("string")) | (x.cast("string") == b.cast("string"))
            p, q = (x.try_cast("double"), b.try_cast("double")) if kind == "number" else (x.cast("string"), b.cast("string"))
            return COMPARED[op](p, q)

        return F.coalesce(F.exists(a, one) if many else one(a), F.lit(False))

    def test(self, tree: tuple) -> Column:
        kind = tree[0]
        if kind in ("&", "&&"):
            return self.test(tree[1]) & self.test(tree[2])
        if kind in ("|", "||"):
            return self.test(tree[1]) | self.test(tree[2])
        if kind == "not":
            return ~self.test(tree[1])
        if kind in ("na", "exists"):
            if tree[1][0] == "field" and (there := self.schema.presence.get(tree[1][1])) is not None:
                return there if kind == "exists" else ~there
            c, many, _ = self.value(tree[1])
            return self.present(c, many) if kind == "exists" else ~self.present(c, many)
        if kind == "call":
            if tree[1] not in CALLS or len(tree[2]) != 1:
                raise FilterSyntaxError(f"no function {tree[1]}")
            c, many, _ = self.value(tree[2][0])
            return F.coalesce(F.exists(c, CALLS[tree[1]]) if many else CALLS[tree[1]](c), F.lit(False))
        if kind in COMPARE:
            return self.compare(kind, tree[1], tree[2])
        if kind == "field":
            c, many, _ = self.value(tree)
            return self.present(c, many)
        raise FilterSyntaxError(f"{kind} is not a condition")


def compile_filter(text: str, schema: Schema) -> Column:
    """The boolean Column of an expression of either dialect."""
    return Compiler(schema).test(Parser(text).whole())


# presets

# Fragments by annotation release, the fields that each release adds, and those of them hidden in reports.
PROFILES = {
    "dbnsfp4": {
        "gnomad_af_below": "((dbNSFP_gnomAD_exomes_AF[0] < {0}) | (na dbNSFP_gnomAD_exomes_AC[0])) & ((dbNSFP_gnomAD_genomes_AF[0] < {0}) | (na dbNSFP_gnomAD_genomes_AC[0]))",
        "gnomad_af_below_or": "(dbNSFP_gnomAD_exomes_AF[0] < {0}) | (na dbNSFP_gnomAD_exomes_AC[0]) | (dbNSFP_gnomAD_genomes_AF[0] < {0}) | (na dbNSFP_gnomAD_genomes_AC[0])",
        "gnomad_ac_atmost": "((dbNSFP_gnomAD_exomes_AC[0] <= {0}) | (na dbNSFP_gnomAD_exomes_AC[0])) & ((dbNSFP_gnomAD_genomes_AC[0] <= {0}) | (na dbNSFP_gnomAD_genomes_AC[0]))",
    },
    "dbnsfp5": {
        "gnomad_af_below": "((dbNSFP_gnomAD4.1_joint_AF[0] < {0}) | (na dbNSFP_gnomAD4.1_joint_AC[0]))",
        "gnomad_af_below_or": "(dbNSFP_gnomAD4.1_joint_AF[0] < {0}) | (na dbNSFP_gnomAD4.1_joint_AC[0])",
        "gnomad_ac_atmost": "((dbNSFP_gnomAD4.1_joint_AC[0] <= {0}) | (na dbNSFP_gnomAD4.1_joint_AC[0]))",
    },
}
PROFILE_FIELDS = {
    "dbnsfp4": ["dbNSFP_gnomAD_exomes_AC", "dbNSFP_gnomAD_genomes_AC", "dbNSFP_gnomAD_exomes_AF", "dbNSFP_gnomAD_genomes_AF", "dbNSFP_hg19_chr", "dbNSFP_hg19_pos_1_based_"],
    "dbnsfp5": ["dbNSFP_gnomAD4.1_joint_AC", "dbNSFP_gnomAD4.1_joint_AF", "dbNSFP_hg19_chr", "dbNSFP_hg19_pos_1_based_"],
}
PROFILE_HIDDEN = {
    "dbnsfp4": ["dbNSFP_gnomAD_exomes_AC", "dbNSFP_gnomAD_genomes_AC"],
    "dbnsfp5": ["dbNSFP_gnomAD4.1_joint_AC"],
}
PROFILE_TOLD = {"dbnsfp4": "dbNSFP v4.x (gnomAD v3/v4.0, separate exome+genome)", "dbnsfp5": "dbNSFP v5.x (gnomAD v4.1, joint exome+genome)"}
# Named filters (parentheses are balanced in moderate_and_high_prediction, high_or_lof_or_nmd and
# high_or_pathogenic, where one lacked or was too many).
PRESETS = {
    "pass": "(FILTER = 'PASS')",
    "not_artefact": "((AC[ANY] <= 513) & (QUAL[ANY] >= 100))",
    "not_benign": "(!(dbNSFP_clinvar_clnsig =~ '[Bb]enign') & !(ClinVar_CLNSIG =~ '[Bb]enign'))",
    "5percent_or_pathogenic": "(({{gnomad_af_below_or:0.05}}) | (((dbNSFP_clinvar_clnsig =~ '[Pp]athogenic') & !(dbNSFP_clinvar_clnsig =~ '[Cc]onflicting')) | ((ClinVar_CLNSIG =~ '[Pp]athogenic') & !(ClinVar_CLNSIG =~ '[Cc]onflicting'))))",
    "5percent": "({{gnomad_af_below:0.05}})",
    "1percent": "({{gnomad_af_below:0.001}})",
    "rare": "({{gnomad_af_below:0.0001}})",
    "super_rare": "({{gnomad_ac_atmost:2}})",
    "pathogenic": "(((dbNSFP_clinvar_clnsig =~ '[Pp]athogenic') & !(dbNSFP_clinvar_clnsig =~ '[Cc]onflicting')) | ((ClinVar_CLNSIG =~ '[Pp]athogenic') & !(ClinVar_CLNSIG =~ '[Cc]onflicting')))",
    "coding": "((ANN[ANY].IMPACT has 'HIGH') | (ANN[ANY].IMPACT has 'MODERATE'))",
    "high": "((ANN[ANY].IMPACT has 'HIGH'))",
    "moderate": "((ANN[ANY].IMPACT has 'MODERATE'))",
    "moderate_and_high_prediction": "(((ANN[ANY].IMPACT has 'MODERATE')) & ((dbNSFP_REVEL_score >= 0.9) | (dbNSFP_CADD_phred >= 30)))",
    "high_splice_prediction": "(((ANN[ANY].IMPACT has 'MODERATE')) & ((splice_spidex_dpsi_zscore <= -2.0 ) & ((splice_dbscSNV_ada_score >= 0.6 ) | (splice_dbscSNV_rf_score >= 0.6 ))))",
    "low": "((ANN[ANY].IMPACT has 'LOW'))",
    "high_or_moderate": "((ANN[ANY].IMPACT has 'HIGH') | (ANN[ANY].IMPACT has 'MODERATE'))",
    "high_or_moderate_or_low": "((ANN[ANY].IMPACT has 'HIGH') | (ANN[ANY].IMPACT has 'MODERATE') | (ANN[ANY].IMPACT has 'LOW'))",
    "high_or_moderate_or_high_splice_prediction": "(((ANN[ANY].IMPACT has 'HIGH') | (ANN[ANY].IMPACT has 'MODERATE')) | ((splice_spidex_dpsi_zscore <= -2.0 ) & ((splice_dbscSNV_ada_score >= 0.6 ) | (splice_dbscSNV_rf_score >= 0.6 ))))",
    "high_or_moderate_or_high_splice_prediction_or_high_prediction": "(((ANN[ANY].IMPACT has 'HIGH') | (ANN[ANY].IMPACT has 'MODERATE')) | ((splice_spidex_dpsi_zscore <= -2.0 ) & ((splice_dbscSNV_ada_score >= 0.6 ) | (splice_dbscSNV_rf_score >= 0.6 ))) | ((dbNSFP_REVEL_score >= 0.9) | (dbNSFP_CADD_phred >= 30)))",
    "modifier": "((ANN[ANY].IMPACT has 'MODIFIER'))",
    "high_or_lof_or_nmd": "(((exists LOF[*].PERC) & (LOF[*].PERC > 0.9)) | ((exists NMD[*].PERC) & (NMD[*].PERC > 0.9)) | (ANN[ANY].IMPACT has 'HIGH'))",
    "high_or_pathogenic": "(((ANN[ANY].IMPACT has 'HIGH') | (((dbNSFP_clinvar_clnsig =~ '[Pp]athogenic') & !(dbNSFP_clinvar_clnsig =~ '[Cc]onflicting')) | ((ClinVar_CLNSIG =~ '[Pp]athogenic') & !(ClinVar_CLNSIG =~ '[Cc]onflicting')))))",
    "aif": "((({{gnomad_af_below_or:0.05}}) | (((dbNSFP_clinvar_clnsig =~ '[Pp]athogenic') & !(dbNSFP_clinvar_clnsig =~ '[Cc]onflicting')) | ((ClinVar_CLNSIG =~ '[Pp]athogenic') & !(ClinVar_CLNSIG =~ '[Cc]onflicting')))) & ((((dbNSFP_clinvar_clnsig =~ '[Pp]athogenic') & !(dbNSFP_clinvar_clnsig =~ '[Cc]onflicting')) | ((ClinVar_CLNSIG =~ '[Pp]athogenic') & !(ClinVar_CLNSIG =~ '[Cc]onflicting'))) | (({{gnomad_af_below_or:0.01}}) & ((splice_spidex_dpsi_zscore <= -2.0 ) & (( splice_dbscSNV_ada_score >= 0.6 ) | ( splice_dbscSNV_rf_score >= 0.6 )))) | (({{gnomad_af_below_or:0.01}}) & ((ANN[ANY].IMPACT has 'MODERATE') & ((dbNSFP_REVEL_score >= 0.9) | (dbNSFP_CADD_phred >= 30)))) | (({{gnomad_af_below_or:0.01}}) & (((exists LOF[*].PERC) & (LOF[*].PERC > 0.9)) | ((exists NMD[*].PERC) & (NMD[*].PERC > 0.9)) | (ANN[ANY].IMPACT has 'HIGH')))))",
    "mutect2_TvsN_pass": "((({{gnomad_ac_atmost:2}}) | ((exists ID) & ( ID =~ 'COS' ))) & (( na FILTER ) | (FILTER = 'PASS')) & ( GEN[0].DP >= 50 ) & ((GEN[1].AF < 0.03) | (na GEN[1].AF)) & ( GEN[0].AF >= 0.05 ))",
    "mutect2_TvsN": "((({{gnomad_ac_atmost:2}}) | ((exists ID) & ( ID =~ 'COS' ))) & ( GEN[*].DP >= 50 ) & ((GEN[1].AF < 0.03) | (na GEN[1].AF)) & ( GEN[0].AF >= 0.05 ))",
    "mutect2_To_pass": "((({{gnomad_ac_atmost:2}}) | ((exists ID) & ( ID =~ 'COS' ))) & (( na FILTER ) | (FILTER = 'PASS')) & ( GEN[*].DP >= 50 ) & ( GEN[0].AF >= 0.05 ))",
    "somatic": "({{gnomad_ac_atmost:2}}) & (GEN[{normal_idx}].DP >= {normal_dp_min}) & (GEN[{tumor_idx}].DP >= {tumor_dp_min}) & ((GEN[{normal_idx}].AF < {normal_af_max}) | (na GEN[{normal_idx}].AF)) & (GEN[{tumor_idx}].AF >= {tumor_af_min})",
    "somatic_pass": "({{gnomad_ac_atmost:2}}) & ((na FILTER) | (FILTER = 'PASS')) & (GEN[{normal_idx}].DP >= {normal_dp_min}) & (GEN[{tumor_idx}].DP >= {tumor_dp_min}) & ((GEN[{normal_idx}].AF < {normal_af_max}) | (na GEN[{normal_idx}].AF)) & (GEN[{tumor_idx}].AF >= {tumor_af_min})",
    "somatic_strict": "({{gnomad_ac_atmost:2}}) & ((na FILTER) | (FILTER = 'PASS')) & (GEN[{normal_idx}].DP >= 50) & (GEN[{tumor_idx}].DP >= 50) & ((GEN[{normal_idx}].AF < 0.01) | (na GEN[{normal_idx}].AF)) & (GEN[{tumor_idx}].AF >= 0.05)",
    "loh": "(GEN[{normal_idx}].GT = '0/1') & ((GEN[{tumor_idx}].GT = '1/1') | (GEN[{tumor_idx}].AF >= 0.85)) & (GEN[{tumor_idx}].DP >= {tumor_dp_min}) & (GEN[{normal_idx}].DP >= {normal_dp_min})",
    "germline_shared": "((GEN[{normal_idx}].AF >= 0.20) & (GEN[{tumor_idx}].AF >= 0.20)) & (GEN[{normal_idx}].DP >= {normal_dp_min}) & (GEN[{tumor_idx}].DP >= {tumor_dp_min})",
    "tumor_only": "({{gnomad_ac_atmost:2}}) & ((na FILTER) | (FILTER = 'PASS')) & (GEN[{tumor_idx}].DP >= {tumor_dp_min}) & (GEN[{tumor_idx}].AF >= {tumor_af_min})",
}
# Defaults of the templates of paired samples.
PAIR = {"tumor_idx": 1, "normal_idx": 0, "tumor_dp_min": 20, "normal_dp_min": 20, "tumor_af_min": 0.05, "normal_af_max": 0.03}
MACRO = re.compile(r"\{\{(\w+):([^}]*)\}\}")


def expanded(text: str, fragments: dict[str, str], pair: dict | None = None) -> str:
    """Macros {{name:parameter}} replaced by fragments, then templates such as {tumor_idx}; unknown names raise."""

    def fragment(m: re.Match) -> str:
        if m[1] not in fragments:
            raise ValueError(f"no fragment {m[1]}")
        return fragments[m[1]].replace("{0}", m[2])

    text = MACRO.sub(fragment, text)
    values = {k: str(v) for k, v in (PAIR | (pair or {})).items()}
    return re.sub(r"\{(\w+)\}", lambda m: values.get(m[1], m[0]), text)


def composed(presets: list[str], own: str | None = None, profile: str = "dbnsfp4", known: dict[str, str] | None = None, pair: dict | None = None) -> str:
    """Presets, each in parentheses, and the user's own filter, all required."""
    known = PRESETS if known is None else known
    missing = [p for p in presets if p not in known]
    if missing:
        raise ValueError(f"no preset {', '.join(missing)}")
    parts = [f"({known[p]})" for p in presets] + ([f"({own})"] if own else [])
    return expanded(" & ".join(parts), PROFILES[profile], pair)


def profiles() -> list[dict[str, str]]:
    """name and description of the known profiles, by name."""
    return [{"name": n, "description": PROFILE_TOLD[n]} for n in sorted(PROFILES)]


def table_filter(df, text: str):
    """Rows of a table of text columns that meet an expression over its columns; a syntax error or unknown column raises."""
    return df.where(compile_filter(text, Schema({c: F.col(f"`{c}`") for c in df.columns})))
