from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ipcforge.session import get_session

    s = get_session(app="ipcforge-tests", master="local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def eval_col(spark, values, fn, schema="x string"):
    """Apply a column function to a list of inputs; return the outputs in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    out = df.select("i", fn("x").alias("out")).orderBy("i").collect()
    return [r["out"] for r in out]


def unzipped(spark, pub, months):
    """(bulletin_code, source_file, xml) of the months' archives, read whole and plainly; a corrupt member is null."""
    import zipfile

    rows = []
    for month in months:
        with zipfile.ZipFile(os.path.join(pub, f"{month}.zip")) as zf:
            for name in (n for n in zf.namelist() if n.endswith("Document.xml")):
                try:
                    rows.append((month, name, bytearray(zf.read(name))))
                except Exception:
                    rows.append((month, name, None))
    return spark.createDataFrame(rows, "bulletin_code string, source_file string, xml binary")
