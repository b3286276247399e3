"""Every query of the engine against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

if not os.path.isdir(SF):
    pytest.skip("no tables", allow_module_level=True)

from helicase.plans import catalogue_io as catalogue  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    import math

    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (int, float)):
        return "null" if isinstance(v, float) and math.isnan(v) else repr(round(float(v), 5))
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    found = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(found.columns, found.fetchall())


@pytest.mark.parametrize("name", ["lambda_gc", "linear_burden_full"])
def test_kernel_queries_give_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry_point():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_point_without_the_training_data_operators(tmp_path, pipeline):
    """The rest works in a copy from which both llm folders are gone, with the pipeline's file or without."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    away = shutil.ignore_patterns("llm", "__pycache__", ".git", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(root, tmp_path / "copy", ignore=away)
    told = "import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-B", "-c", told], cwd=tmp_path / "copy", env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split("\n")[-2] == f"{sorted(catalogue.QUERIES)} {sorted(catalogue.ORACLE_SQL)}"
