"""Scores and filters by configuration: formulas in order, later ones seeing earlier results; final filters; presets."""

from __future__ import annotations

import ast

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helicase.plans.filterlang import Schema, compile_filter, composed
from helicase.plans.pyexpr import BOOL, NUMBER, Rows, Value, named


def apply_scoring(df: DataFrame, model: dict) -> DataFrame:
    """df with the model's output scores.

    variables maps columns to names, "name|default:x" with what a missing column or value counts as.  A default that
    is no number is a text.  A formula that cannot be compiled raises.
    """
    names: dict[str, Value] = dict(named(df))
    for column, spec in model["variables"].items():
        name, _, default = spec.partition("|default:")
        number: object = None
        if default:
            try:
                number = ast.literal_eval(default)
            except (ValueError, SyntaxError):
                number = default
        fill = F.lit(number)
        if column not in df.columns:
            names[name] = Value(fill if default else F.lit(0.0), NUMBER if isinstance(number, (int, float)) or not default else "text")
        elif isinstance(number, (int, float)):
            names[name] = Value(F.coalesce(F.col(f"`{column}`").try_cast("double"), fill.cast("double")), NUMBER)
        elif default:
            names[name] = Value(F.coalesce(F.col(f"`{column}`").cast("string"), fill), "text")
        else:
            names[name] = names[column]
    out, kept = df, model.get("output_scores")
    made = []
    for formula in model["formulas"]:
        for name, text in formula.items():
            v = Rows(names).compile(text)
            column = v.column.cast("int") if v.kind == BOOL and kept and name in kept else v.column
            hidden = f"_score_{name}"
            out = out.withColumn(hidden, column)
            names[name] = Value(F.col(hidden), v.kind if not (v.kind == BOOL and kept and name in kept) else NUMBER)
            made.append(name)
    wanted = [n for n in made if not kept or n in kept]
    return out.select(*df.columns, *(F.col(f"_score_{n}").alias(n) for n in dict.fromkeys(wanted)))


def needs_inheritance(model: dict) -> bool:
    """Whether a model reads inheritance columns."""
    text = " ".join(t for f in model["formulas"] for t in f.values())
    used = {n.id for n in ast.walk(ast.parse(f"({text.replace(chr(10), ' ')})", mode="eval")) if isinstance(n, ast.Name)} if len(model["formulas"]) == 1 else set(text.replace("(", " ").replace(")", " ").replace(".", " ").split())
    return any(c.startswith("Inheritance_") and s.partition("|")[0] in used for c, s in model["variables"].items())


def final_filter(df: DataFrame, expression: str) -> DataFrame:
    """Rows that a pandas-style query keeps; columns compared with numbers are cast, others keep their type."""
    v = Rows(named(df)).compile(expression)
    return df.where(v.column if v.kind == BOOL else F.coalesce(v.column.try_cast("boolean"), F.lit(False)))


def preset_filter(df: DataFrame, schema: Schema, presets: list[str], own: str | None = None, profile: str = "dbnsfp4") -> DataFrame:
    return df.where(compile_filter(composed(presets, own, profile), schema))
