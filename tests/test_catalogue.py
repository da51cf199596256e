"""Every registered query runs; those with an oracle match DuckDB on sf0.001."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from check_oracle import rows_key  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from intactly.sources.tables import TABLES  # noqa: E402

QUERIES = entry_mod.queries()
SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["month", "rows", "fingerprint"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    assert len(cols) == len(set(cols))
    if name not in SQL:
        return
    res = con.execute(SQL[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(cols) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert rows_key(cols, rows) == rows_key(o_cols, o_rows)
