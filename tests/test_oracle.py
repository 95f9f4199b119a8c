"""Every registered query against its SQL oracle, at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
# Compositions that another test covers piece by piece; the check tool runs them at sf0.01.
SLOW = {
    "research_table", "metadata_append", "bars_incremental", "compacted", "ingest_summary",
    "ingested_trades", "metadata_incremental",
}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE and n not in SLOW])
def test_matches_oracle(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    rel = duck.execute(ORACLE[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows(df.columns, got) == rows(cols, rel.fetchall())


def test_oracle_names_are_registered():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
