"""Python expressions of scores, final filters and statistics, compiled to Columns by their syntax trees.

Row expressions follow pandas: a comparison with a missing value is false (!= is true), booleans are 0 and 1 in
arithmetic.  Aggregate expressions know df and group_df, columns by df['X'] or df.X, masks df[mask], the reductions
sum mean max min std median nunique count, len(), size(), and pd.to_numeric(..., errors='coerce').  Nothing is
evaluated as Python; what is not listed here raises ExpressionError.
"""

from __future__ import annotations

import ast
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

BOOL, NUMBER, TEXT, ANY = "bool", "number", "text", "any"


class ExpressionError(ValueError):
    pass


@dataclass
class Value:
    column: Column
    kind: str = ANY


@dataclass
class Frame:
    mask: Column | None = None


@dataclass
class Series:
    value: Value
    mask: Column | None = None


def number(v: Value) -> Column:
    return v.column.cast("int") if v.kind == BOOL else v.column if v.kind == NUMBER else v.column.try_cast("double")


def truth(v: Value) -> Column:
    if v.kind == BOOL:
        return v.column
    return F.coalesce(number(v) != 0, F.lit(False))


def compared(op: ast.cmpop, a: Value, b: Value) -> Column:
    if NUMBER in (a.kind, b.kind) or BOOL in (a.kind, b.kind):
        x, y = number(a).cast("double"), number(b).cast("double")
    else:
        x, y = (a.column.cast("string"), b.column.cast("string")) if TEXT in (a.kind, b.kind) else (a.column, b.column)
    table = {ast.Eq: lambda: x == y, ast.NotEq: lambda: x != y, ast.Lt: lambda: x < y, ast.LtE: lambda: x <= y, ast.Gt: lambda: x > y, ast.GtE: lambda: x >= y}
    if type(op) not in table:
        raise ExpressionError("no such comparison")
    return F.coalesce(table[type(op)](), F.lit(isinstance(op, ast.NotEq)))


def constant(node: ast.AST) -> object:
    try:
        return ast.literal_eval(node)
    except ValueError:
        raise ExpressionError("a constant is needed") from None


MATH = {"log": F.ln, "log10": F.log10, "log2": F.log2, "exp": F.exp, "sqrt": F.sqrt, "abs": F.abs, "floor": F.floor, "ceil": F.ceil}


class Rows:
    """Compiles row expressions over the given columns (name: Column and kind)."""

    def __init__(self, names: dict[str, Value]) -> None:
        self.names = names

    def compile(self, text: str) -> Value:
        text = re.sub(r"`([^`]+)`", lambda m: f"__quoted__[{m[1]!r}]", text)
        try:
            tree = ast.parse(text.strip(), mode="eval")
        except SyntaxError as e:
            raise ExpressionError(str(e)) from None
        return self.visit(tree.body)

    def visit(self, node: ast.AST) -> Value:
        found = getattr(self, f"on_{type(node).__name__.lower()}", None)
        if found is None:
            raise ExpressionError(f"{type(node).__name__} is not allowed")
        return found(node)

    def on_name(self, node: ast.Name) -> Value:
        if node.id not in self.names:
            raise ExpressionError(f"no column {node.id}")
        return self.names[node.id]

    def on_subscript(self, node: ast.Subscript) -> Value:
        if isinstance(node.value, ast.Name) and node.value.id == "__quoted__":
            return self.on_name(ast.Name(str(constant(node.slice))))
        raise ExpressionError("an index is not allowed here")

    def on_constant(self, node: ast.Constant) -> Value:
        kind = BOOL if isinstance(node.value, bool) else NUMBER if isinstance(node.value, (int, float)) else TEXT
        return Value(F.lit(node.value), kind)

    def on_unaryop(self, node: ast.UnaryOp) -> Value:
        v = self.visit(node.operand)
        if isinstance(node.op, (ast.Invert, ast.Not)):
            return Value(~truth(v), BOOL)
        return Value(-number(v) if isinstance(node.op, ast.USub) else number(v), NUMBER)

    def on_boolop(self, node: ast.BoolOp) -> Value:
        parts = [truth(self.visit(v)) for v in node.values]
        out = parts[0]
        for p in parts[1:]:
            out = out & p if isinstance(node.op, ast.And) else out | p
        return Value(out, BOOL)

    def on_binop(self, node: ast.BinOp) -> Value:
        a, b = self.visit(node.left), self.visit(node.right)
        if isinstance(node.op, (ast.BitAnd, ast.BitOr, ast.BitXor)):
            x, y = truth(a), truth(b)
            return Value(x & y if isinstance(node.op, ast.BitAnd) else x | y if isinstance(node.op, ast.BitOr) else x != y, BOOL)
        if isinstance(node.op, ast.Add) and TEXT in (a.kind, b.kind):
            return Value(F.concat(a.column.cast("string"), b.column.cast("string")), TEXT)
        x, y = number(a).cast("double"), number(b).cast("double")
        table = {
            ast.Add: lambda: x + y, ast.Sub: lambda: x - y, ast.Mult: lambda: x * y, ast.Div: lambda: x / F.nullif(y, F.lit(0.0)),
            ast.FloorDiv: lambda: F.floor(x / F.nullif(y, F.lit(0.0))), ast.Mod: lambda: F.pmod(x, F.nullif(y, F.lit(0.0))), ast.Pow: lambda: F.pow(x, y),
        }
        if type(node.op) not in table:
            raise ExpressionError("no such operator")
        return Value(table[type(node.op)](), NUMBER)

    def on_compare(self, node: ast.Compare) -> Value:
        left, out = self.visit(node.left), None
        for op, right in zip(node.ops, node.comparators, strict=True):
            if isinstance(op, (ast.In, ast.NotIn)):
                hit = F.coalesce(left.column.isin(*constant(right)), F.lit(False))
                hit = ~hit if isinstance(op, ast.NotIn) else hit
            else:
                value = self.visit(right)
                hit = compared(op, left, value)
                left = value
            out = hit if out is None else out & hit
        return Value(out, BOOL)

    def on_ifexp(self, node: ast.IfExp) -> Value:
        a, b = self.visit(node.body), self.visit(node.orelse)
        return Value(F.when(truth(self.visit(node.test)), a.column).otherwise(b.column), a.kind)

    def on_call(self, node: ast.Call) -> Value:
        f, args, named = node.func, node.args, {k.arg: constant(k.value) for k in node.keywords}
        if isinstance(f, ast.Name) and f.id in ("abs", "min", "max"):
            parts = [number(self.visit(a)) for a in args]
            return Value(F.abs(parts[0]) if f.id == "abs" else F.least(*parts) if f.id == "min" else F.greatest(*parts), NUMBER)
        if not isinstance(f, ast.Attribute):
            raise ExpressionError("no such function")
        if isinstance(f.value, ast.Name) and f.value.id == "np":
            if f.attr == "where":
                a, b = self.visit(args[1]), self.visit(args[2])
                return Value(F.when(truth(self.visit(args[0])), a.column).otherwise(b.column), a.kind)
            parts = [number(self.visit(a)).cast("double") for a in args]
            if f.attr in ("minimum", "maximum"):
                return Value((F.least if f.attr == "minimum" else F.greatest)(*parts), NUMBER)
            if f.attr in MATH:
                return Value(MATH[f.attr](parts[0]), NUMBER)
            raise ExpressionError(f"no such function np.{f.attr}")
        if isinstance(f.value, ast.Name) and f.value.id == "pd" and f.attr == "to_numeric":
            return Value(number(self.visit(args[0])).cast("double"), NUMBER)
        if isinstance(f.value, ast.Attribute) and f.value.attr == "str":
            return self.text_method(self.visit(f.value.value), f.attr, args, named)
        v = self.visit(f.value)
        if f.attr == "isin":
            return Value(F.coalesce(v.column.isin(*constant(args[0])), F.lit(False)), BOOL)
        if f.attr in ("isna", "isnull"):
            return Value(v.column.isNull(), BOOL)
        if f.attr in ("notna", "notnull"):
            return Value(v.column.isNotNull(), BOOL)
        if f.attr == "fillna":
            other = self.visit(args[0])
            return Value(F.coalesce(v.column if v.kind != ANY or other.kind != NUMBER else number(v), other.column), other.kind if v.kind == ANY else v.kind)
        if f.attr == "astype":
            to = str(constant(args[0])) if isinstance(args[0], ast.Constant) else getattr(args[0], "id", "")
            if to in ("float", "float64"):
                return Value(number(v).cast("double"), NUMBER)
            if to in ("int", "int64"):
                return Value(number(v).cast("bigint"), NUMBER)
            if to in ("str", "string", "object"):
                return Value(v.column.cast("string"), TEXT)
            if to == "bool":
                return Value(truth(v), BOOL)
        if f.attr == "clip":
            out = number(v)
            low, high = (constant(a) for a in (*args, *[ast.Constant(None)] * 2)[:2])
            low, high = named.get("lower", low), named.get("upper", high)
            out = F.greatest(out, F.lit(low)) if low is not None else out
            return Value(F.least(out, F.lit(high)) if high is not None else out, NUMBER)
        if f.attr == "abs":
            return Value(F.abs(number(v)), NUMBER)
        raise ExpressionError(f"no such method {f.attr}")

    def text_method(self, v: Value, name: str, args: list, named: dict) -> Value:
        c = v.column.cast("string")
        if name == "contains":
            pattern = str(constant(args[0]))
            pattern = pattern if named.get("regex", True) else re.escape(pattern)
            hit = c.rlike(pattern if named.get("case", True) else f"(?i){pattern}")
            return Value(F.coalesce(hit, F.lit(bool(named.get("na", False)))), BOOL)
        if name in ("startswith", "endswith"):
            return Value(F.coalesce(getattr(c, name)(constant(args[0])), F.lit(False)), BOOL)
        if name == "extract":
            pattern = str(constant(args[0]))
            return Value(F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1)), TEXT)
        if name in ("lower", "upper", "strip", "len"):
            return Value({"lower": F.lower, "upper": F.upper, "strip": F.trim, "len": F.length}[name](c), NUMBER if name == "len" else TEXT)
        if name == "replace":
            a, b = str(constant(args[0])), str(constant(args[1]))
            return Value(F.regexp_replace(c, a, b) if named.get("regex", False) else F.replace(c, F.lit(a), F.lit(b)), TEXT)
        raise ExpressionError(f"no such text method {name}")


class Aggregates(Rows):
    """Compiles statistics to aggregate Columns."""

    def compile_stat(self, text: str) -> Column:
        try:
            tree = ast.parse(text.strip(), mode="eval").body
        except SyntaxError as e:
            raise ExpressionError(str(e)) from None
        out = self.scalar(tree)
        return out

    def frame(self, node: ast.AST) -> Frame | None:
        if isinstance(node, ast.Name) and node.id in ("df", "group_df"):
            return Frame()
        if isinstance(node, ast.Subscript) and (inner := self.frame(node.value)) is not None and not isinstance(node.slice, ast.Constant):
            mask = truth(self.series(node.slice).value)
            return Frame(mask if inner.mask is None else inner.mask & mask)
        return None

    def series(self, node: ast.AST) -> Series:
        if isinstance(node, ast.Subscript):
            if (frame := self.frame(node.value)) is not None and isinstance(node.slice, ast.Constant):
                return Series(self.on_name(ast.Name(str(node.slice.value))), frame.mask)
            inner = self.series(node.value)
            mask = truth(self.series(node.slice).value)
            return Series(inner.value, mask if inner.mask is None else inner.mask & mask)
        if isinstance(node, ast.Attribute) and (frame := self.frame(node.value)) is not None:
            return Series(self.on_name(ast.Name(node.attr)), frame.mask)
        return Series(Rows.visit(self, node))

    def visit(self, node: ast.AST) -> Value:
        if isinstance(node, (ast.Subscript, ast.Attribute)):
            found = self.series(node)
            if found.mask is not None:
                return Value(F.when(found.mask, found.value.column), found.value.kind)
            return found.value
        return super().visit(node)

    def reduced(self, s: Series, how: str) -> Column:
        v = s.value
        c = number(v) if how not in ("nunique", "count") else v.column
        if s.mask is not None:
            c = F.when(s.mask, c)
        table = {"sum": lambda: F.coalesce(F.sum(c), F.lit(0)), "mean": lambda: F.avg(c), "max": lambda: F.max(c), "min": lambda: F.min(c), "std": lambda: F.stddev_samp(c), "median": lambda: F.median(c), "nunique": lambda: F.count_distinct(c), "count": lambda: F.count(c)}
        return table[how]()

    def scalar(self, node: ast.AST) -> Column:
        if isinstance(node, ast.Constant):
            return F.lit(node.value)
        if isinstance(node, ast.BinOp):
            a, b = self.scalar(node.left).cast("double"), self.scalar(node.right).cast("double")
            table = {ast.Add: lambda: a + b, ast.Sub: lambda: a - b, ast.Mult: lambda: a * b, ast.Div: lambda: a / F.nullif(b, F.lit(0.0)), ast.Pow: lambda: F.pow(a, b)}
            if type(node.op) in table:
                return table[type(node.op)]()
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -self.scalar(node.operand)
        if isinstance(node, ast.IfExp):
            test = node.test
            if isinstance(test, ast.Compare) and len(test.ops) == 1:
                hit = compared(test.ops[0], Value(self.scalar(test.left), NUMBER), Value(self.scalar(test.comparators[0]), NUMBER))
                return F.when(hit, self.scalar(node.body)).otherwise(self.scalar(node.orelse))
        if isinstance(node, ast.Call):
            f = node.func
            if isinstance(f, ast.Name) and f.id in ("float", "int"):
                return self.scalar(node.args[0]).cast("double" if f.id == "float" else "bigint")
            if isinstance(f, ast.Name) and f.id == "size" and not node.args:
                return F.count(F.lit(1))
            if isinstance(f, ast.Name) and f.id == "len":
                if (frame := self.frame(node.args[0])) is not None:
                    return F.count(F.lit(1)) if frame.mask is None else F.count_if(frame.mask)
                if isinstance(node.args[0], ast.ListComp):
                    return F.lit(self.matching_columns(node.args[0]))
                s = self.series(node.args[0])
                return F.count(F.lit(1)) if s.mask is None else F.count_if(s.mask)
            if isinstance(f, ast.Attribute) and f.attr == "size" and self.frame(f.value) is not None:
                return F.count(F.lit(1))
            if isinstance(f, ast.Attribute) and f.attr in ("sum", "mean", "max", "min", "std", "median", "nunique", "count"):
                return self.reduced(self.series(f.value), f.attr)
        raise ExpressionError("not a statistic")

    def matching_columns(self, node: ast.ListComp) -> int:
        """len([c for c in df.columns if c.endswith('_GT')]): a number that the schema decides."""
        tests = node.generators[0].ifs
        if len(node.generators) != 1 or len(tests) != 1 or not isinstance(tests[0], ast.Call) or not isinstance(tests[0].func, ast.Attribute):
            raise ExpressionError("not a statistic")
        how, what = tests[0].func.attr, str(constant(tests[0].args[0]))
        if how not in ("endswith", "startswith"):
            raise ExpressionError("not a statistic")
        return sum(getattr(n, how)(what) for n in self.names)


def named(df, kinds: dict[str, str] | None = None) -> dict[str, Value]:
    """Values for the columns of a DataFrame, by their types."""
    out = {}
    for name, kind in df.dtypes:
        k = BOOL if kind == "boolean" else NUMBER if kind in ("int", "bigint", "double", "float", "smallint", "tinyint") or kind.startswith("decimal") else TEXT if kind == "string" else ANY
        out[name] = Value(F.col(f"`{name}`"), (kinds or {}).get(name, ANY if k == TEXT else k))
    return out
