"""Every registered query against its DuckDB oracle on sf0.001 (order-insensitive)."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import duck, norm  # noqa: E402

from quarry.plans.queries import all_queries  # noqa: E402

# The optional training-data operators have tests of their own.
QUERIES = {name: E.queries()[name] for name in all_queries()}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}
SQL_TYPE = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    spark_types = {f.name: SQL_TYPE.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    idx = {c: i for i, c in enumerate(rel.columns)}
    exp = Counter(tuple(norm(r[idx[c]]) for c in cols) for r in rel.fetchall())
    assert sum(got.values()) == sum(exp.values())
    assert got == exp


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["policy_id", "customer_id"]
