"""Every registered query against its own SQL in DuckDB, values exact."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point

ORACLE = entry_point.oracle_sql()
# The training-data operators have tests of their own.
QUERIES = {n: q for n, q in entry_point.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sample_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sample_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _ordered(found):
    return sorted(found, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, duck, sample_dir, name):
    df = QUERIES[name](spark, sample_dir)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    expected = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert _ordered(tuple(r) for r in df.select(*columns).collect()) == _ordered(expected)
    assert expected, "a query without rows proves nothing"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
