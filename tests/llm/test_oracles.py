"""Every SQL of the subpackage against its query."""

from __future__ import annotations

import duckdb
import pytest
from llm.edge_tables import SF
from oracle_check import TABLES, digest

from ipcforge.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows, cur = [tuple(r) for r in df.collect()], con.execute(ORACLES[name])
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert digest(df.columns, rows)[0] == digest([d[0] for d in cur.description], cur.fetchall())[0]


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
