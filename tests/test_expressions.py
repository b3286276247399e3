import pytest
from pyspark.sql import functions as F

from helicase.plans.filterlang import FilterSyntaxError, Schema, compile_filter, composed, expanded
from helicase.plans.pyexpr import Aggregates, ExpressionError, Rows, named


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "0.001", "PASS", ["HIGH", "LOW"], ["0.5", "0.01"], None), (2, "x", "q10", ["LOW"], ["0.2", "0.9"], "3"), (3, None, None, [], [None, "0.04"], ".")]
    return spark.createDataFrame(data, "id int, af string, filter string, impact array<string>, gaf array<string>, ac string")


def schema():
    return Schema({"FILTER": F.col("filter"), "AF": F.col("af"), "AC": F.col("ac")}, {("ANN", "IMPACT"): F.col("impact"), ("GEN", "AF"): F.col("gaf")})


@pytest.mark.parametrize(
    ("text", "ids"),
    [
        ("(FILTER = 'PASS')", [1]), ("(FILTER != 'PASS')", [2]), ("!(FILTER = 'PASS')", [2, 3]), ("AF < 0.01", [1]), ("(na AC)", [1, 3]), ("exists AC", [2]),
        ("ANN[ANY].IMPACT has 'HIGH'", [1]), ("ANN[*].IMPACT = 'LOW'", [1, 2]), ("ANN[0].IMPACT = 'LOW'", [2]), ("GEN[1].AF >= 0.04 & GEN[0].AF < 0.3", [2]), ("GEN[*].AF >= 0.9 | FILTER =~ '^PA'", [1, 2]),
        ("FILTER !~ 'q' && AF<1", [1]), ("((AF < 0.01) | (na AF)) & !(FILTER = 'q10')", [1, 3]), ("AC + 1 == 4", [2]),
    ],
)
def test_filters(rows, text, ids):
    assert sorted(r.id for r in rows.where(compile_filter(text, schema())).collect()) == ids


@pytest.mark.parametrize("text", ["(AF < 1", "AF <", "AF < 1)", "NOPE = 1", "AF ; 1", "(((A"])
def test_filter_errors_raise(spark, text):
    with pytest.raises(FilterSyntaxError):
        compile_filter(text, schema())


def test_presets_and_macros():
    text = composed(["pass", "rare"], "AF < 1")
    assert text.startswith("((FILTER = 'PASS')) & (")
    assert "0.0001" in text
    assert "{{" not in text
    assert expanded("GEN[{tumor_idx}].DP >= {tumor_dp_min}", {}) == "GEN[1].DP >= 20"
    with pytest.raises(ValueError, match="preset"):
        composed(["absent"])
    with pytest.raises(ValueError, match="fragment"):
        expanded("{{absent:1}}", {})


@pytest.mark.parametrize(
    ("text", "values"),
    [
        ("af > 0.0005", [True, False, False]), ("af != 0.001", [False, True, True]), ("(filter == 'PASS') * 2 + 1", [3.0, 1.0, 1.0]), ("filter.str.contains('P')", [True, False, False]), ("filter.isin(['q10'])", [False, True, False]),
        ("~filter.isna()", [True, True, False]), ("af.fillna(7)", [0.001, 7.0, 7.0]), ("np.where(id > 1, 1, 0)", [0, 1, 1]), ("id ** 2", [1.0, 4.0, 9.0]), ("id in [1, 3]", [True, False, True]), ("ac.str.extract(r'(\\d)', expand=False).astype('float')", [None, 3.0, None]),
        ("1 < id < 3", [False, True, False]), ("max(id, 2)", [2, 2, 3]), ("id.clip(2, 2)", [2, 2, 2]),
    ],
)
def test_row_expressions(rows, text, values):
    v = Rows(named(rows)).compile(text)
    assert [r.v for r in rows.orderBy("id").select(v.column.alias("v")).collect()] == values


@pytest.mark.parametrize("text", ["__import__('os')", "id.apply(1)", "open('x')", "absent + 1", "[x for x in id]", "lambda: 1"])
def test_disallowed_expressions_raise(rows, text):
    with pytest.raises(ExpressionError):
        Rows(named(rows)).compile(text)


@pytest.mark.parametrize(
    ("text", "value"),
    [("len(df)", 3), ("df['filter'].nunique()", 2), ("(df['filter'] == 'PASS').sum()", 1), ("(df.id > 1).mean()", 2 / 3), ("df[df['id'] > 1]['id'].max()", 3), ("len(df[df['id'] > 1])", 2), ("df['id'].sum() / len(df)", 2.0), ("pd.to_numeric(df['af'], errors='coerce').count()", 1), ("size()", 3)],
)
def test_statistics(rows, text, value):
    assert rows.agg(Aggregates(named(rows)).compile_stat(text).alias("v")).first().v == pytest.approx(value)
