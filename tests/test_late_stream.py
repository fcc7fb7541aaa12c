"""Suggestion files that come after their documents, across restarts of the stream."""

from __future__ import annotations

import os
import tempfile
import time
import zipfile

import pytest

from ipcforge.operators.wide import build_wide, encode_wide
from ipcforge.session import cut_lineage
from ipcforge.sources.files import scan_bulletin_documents, scan_lst
from ipcforge.streaming.bulletins import read_stream_output
from ipcforge.streaming.late import _release, start_late_stream

DOC = ("<d><B110>RU{n}</B110><B210>{app}</B210><B480><date>20210301</date></B480>"
       "<classification-ipcr><text>A01K 31/00</text></classification-ipcr></d>")


@pytest.fixture
def place():
    root = tempfile.mkdtemp(prefix="ipcforge-late-")
    os.makedirs(f"{root}/pub")
    os.makedirs(f"{root}/lst")
    return root


def _archive(place, month, apps):
    with zipfile.ZipFile(f"{place}/pub/{month}.zip", "w") as zf:
        for i, app in enumerate(apps):
            zf.writestr(f"{month}/{i}/Document.xml", DOC.format(n=i, app=app) if app != "broken" else "<d><B110>")


def _file(place, app, line="A01K 31/00 (50%);B01K 1/00 (9%)"):
    with open(f"{place}/lst/{app}.LST", "w") as fh:
        fh.write(f"HEAD\nAI_IPC:{line}\n")


def _run(spark, place, deadline=3600.0):
    q = start_late_stream(spark, f"{place}/pub", f"{place}/lst", f"{place}/out", deadline, name=os.path.basename(place), partitions=2, salts=2)
    done = q.awaitTermination(120)
    q.stop()
    assert done and q.exception() is None
    return read_stream_output(spark, f"{place}/out")


def _batch(spark, place, months):
    codes = spark.createDataFrame([(m,) for m in months], "bulletin_code string")
    docs = cut_lineage(scan_bulletin_documents(spark, f"{place}/pub", codes, 2))
    return encode_wide(build_wide(docs, scan_lst(spark, f"{place}/lst")))


def _rows(df, *without):
    return sorted(map(str, (tuple(r) for r in df.drop("error", *without).collect())))


def test_file_after_the_archive_gives_the_row_of_the_batch_job(spark, place):
    _file(place, "2")
    _archive(place, "202103", ["1", "2", "2", "", "broken", "4"])
    got = _run(spark, place)
    assert sorted(r["application_number"] or "-" for r in got.collect()) == ["-", "-", "2", "2"]
    _file(place, "1", "C07D 401/00 (7%)")
    _archive(place, "202104", ["1", "2", "5"])
    _run(spark, place)  # a new query goes on with the state of the first
    _file(place, "4")
    _file(place, "9")
    got = _run(spark, place)
    assert _rows(got) == _rows(_batch(spark, place, ["202103", "202104"])) and got.count() == 8
    _file(place, "5")
    assert _rows(_run(spark, place)) == _rows(_batch(spark, place, ["202103", "202104"]))


def test_documents_leave_at_the_deadline(spark, place):
    _archive(place, "202103", ["1", "2"])
    _file(place, "2")
    assert _run(spark, place, deadline=0.5).count() == 1
    time.sleep(1)
    _file(place, "1")
    assert _run(spark, place, deadline=0.5).count() == 1  # too late
    _archive(place, "202104", ["1"])
    assert _run(spark, place, deadline=0.5).count() == 2  # the line is there for later documents


class _State:
    """State of one key, as the function sees it."""

    def __init__(self):
        self.value, self.timeout, self.hasTimedOut = None, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_state_ends_at_the_deadline(monkeypatch):
    import pandas as pd

    clock = [100.0]
    monkeypatch.setattr(time, "time", lambda: clock[0])
    state, run = _State(), _release(10.0)
    doc = pd.DataFrame({"document": ["d1"], "passes": [False], "ai_line": [None], "modified": [None]})
    assert list(run(("k", 0), iter([doc]), state)) == [] and state.exists and state.timeout == 10_000
    clock[0] = 104.0
    second = doc.assign(document="d2")
    assert list(run(("k", 0), iter([second]), state)) == [] and state.timeout == 6_000
    clock[0], state.hasTimedOut = 111.0, True
    assert list(run(("k", 0), iter([]), state)) == [] and "d1" not in state.value[2] and "d2" in state.value[2]
    clock[0] = 115.0
    assert list(run(("k", 0), iter([]), state)) == [] and not state.exists
    # the newest line wins, whatever the order, and stays
    state.hasTimedOut = False
    lines = pd.DataFrame({"document": [None, None], "passes": [False, False], "ai_line": ["new", "old"], "modified": [2.0, 1.0]})
    assert list(run(("k", 0), iter([lines]), state)) == []
    assert list(run(("k", 0), iter([doc]), state))[0].values.tolist() == [["d1", "new"]]
