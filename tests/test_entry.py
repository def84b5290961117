"""Driver contract: entry() runs; a sample of queries matches the oracle at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import rows_of

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "weight" in df.columns and "partner_continent" in df.columns


def test_every_query_has_sql():
    from tradeflow.workloads import registry
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def sql_names():
    from tradeflow.workloads import registry
    return sorted(registry.oracle_sql())


@pytest.mark.parametrize("name", sql_names())
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(oracle_sql()[name])
    want, want_cols = rows_of([d[0] for d in cur.description], cur.fetchall())
    df = queries()[name](spark, SF)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got_cols == want_cols
    assert len(got) == len(want) and got == want
