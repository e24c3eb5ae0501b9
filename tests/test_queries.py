"""Every registered query against its SQL in DuckDB on the smallest data set."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from docketlake.plans.inputs import TABLES

SF = "/root/testdata/sf0.001"
# Queries of the optional subpackage are tested with it.
QUERIES = {k: v for k, v in entry.queries().items() if k in entry.QUERIES}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in entry.QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(v):
    return f"{v:.9g}" if isinstance(v, float) else repr(v)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(comparable(r[c]) for c in columns) for r in df.collect())
    result = duck.sql(SQL[name])
    assert sorted(result.columns) == columns
    at = [result.columns.index(c) for c in columns]
    assert got == sorted(tuple(comparable(r[i]) for i in at) for r in result.fetchall())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.action_type for r in rows} == {"administrative", "civil", "criminal"}


def test_extractor_reaches_workers_without_the_package(tmp_path):
    """From another folder the workers cannot import this package; the job must carry what it needs."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = (
        "import importlib.util as u; from pyspark.sql import SparkSession;"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate();"
        f"p = u.spec_from_file_location('e', {os.path.join(root, '__spark_entry__.py')!r});"
        "m = u.module_from_spec(p); p.loader.exec_module(m);"
        f"print('rows', m.queries()['extract_apply'](s, {SF!r}).count())"
    )
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 133" in out.stdout, out.stderr[-2000:]
