"""Driver contract: entry() smoke check and every oracle at sf0.001."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import ROOT, SF_SMALL
from oracle_check import TABLES, digest


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["bulletin_code", "y", "n_rows"]
    assert sum(r["n_rows"] for r in rows) == 3285  # long rows at sf0.001: 3570 items of kept documents, 285 of them without a code


def test_registry_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(E._QUERIES) == set(E._ORACLE)  # every query of the base library has its SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E._ORACLE))
def test_oracle_matches(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs_outside_the_repo(tmp_path):
    """Executors need no import path to the package (functions ship by value)."""
    import subprocess

    entry_file = os.path.join(ROOT, "__spark_entry__.py")
    code = (
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('entry_mod', {entry_file!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
        "print('ROWS', m.entry(s).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS " in out.stdout
