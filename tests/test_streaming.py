"""Incremental prep: archives arriving in two rounds are each processed once."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ipcforge.plans import derived
from ipcforge.sources import tables
from ipcforge.streaming.bulletins import read_stream_output, start_prep_stream


def test_prep_stream_two_rounds(spark):
    root = tempfile.mkdtemp(prefix="ipcforge-stream-")
    pub = os.path.join(root, "pub")
    os.makedirs(pub)
    out = os.path.join(root, "wide")
    cl = tables.code_lines(spark, SF_SMALL)
    docs = tables.bulletin_documents(spark, SF_SMALL, cl)
    months = [r[0] for r in docs.select("bulletin_code").distinct().orderBy("bulletin_code").collect()][-3:]
    rows = docs.where(F.col("bulletin_code").isin(months)).collect()  # small test fixture

    def write_zip(month):
        with zipfile.ZipFile(os.path.join(pub, f"{month}.zip"), "w") as zf:
            for d in rows:
                if d["bulletin_code"] == month:
                    zf.writestr(d["source_file"], d["xml"])

    lst = derived.suggestion_lines(spark, SF_SMALL)
    for m in months[:2]:
        write_zip(m)
    q = start_prep_stream(spark, pub, lst, out, name="prep_test")
    q.awaitTermination(300)
    first = read_stream_output(spark, out).count()
    write_zip(months[2])
    q = start_prep_stream(spark, pub, lst, out, name="prep_test")
    q.awaitTermination(300)
    got = read_stream_output(spark, out)
    expected = derived.wide(spark, SF_SMALL).where(F.col("bulletin_code").isin(months))
    assert got.count() == expected.count() > first > 0
    assert sorted(r[0] for r in got.select("bulletin_code").distinct().collect()) == months
