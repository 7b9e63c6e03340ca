"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "nation customer part orders lineitem".split()
CHECKED = ["ledger_ingest", "clean_ledger", "customer_features", "customer_targets", "sequence_last_n"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = [sorted(tuple(map(str, r)) for r in df[columns].astype(object).itertuples(index=False)) for df in (got, want)]
    assert rows[0] == rows[1]


def test_entry_returns_features(spark):
    assert entry.entry(spark).count() > 0
