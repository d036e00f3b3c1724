"""Every query with SQL gives the rows that DuckDB gives; every other one runs."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lunaria import queries as core

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def rows(pdf, columns):
    pdf = pdf[columns].astype(object)
    return sorted(map(repr, pdf.where(pdf.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    if name not in entry.oracle_sql():
        assert len(got)
        return
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


def test_flagship(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
