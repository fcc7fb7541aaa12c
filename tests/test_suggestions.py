"""Incremental ingest of suggestion files: only new ones are read, the newest line wins."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ipcforge.operators.wide import doc_lst_join
from ipcforge.sources import files, suggestions


@pytest.fixture
def place():
    return tempfile.mkdtemp(prefix="ipcforge-lst-")


def _put(place, key, line, at):
    path = os.path.join(place, "lst", f"{key}.LST")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(f"HEAD\nAI_IPC:{line}\n")
    os.utime(path, (at, at))
    return path


def _lines(store):
    return {r["application_key"]: r["ai_line"][7:] for r in store.lines().collect()}


def _joined(spark, store, keys, **more):
    docs = spark.createDataFrame([(f"{i}/Document.xml", k) for i, k in enumerate(keys)], "source_file string, application_key string")
    rows = doc_lst_join(docs, store, **more).collect()
    assert len(rows) == len(keys)
    return {r["application_key"]: r["ai_line"] and r["ai_line"][7:] for r in rows}


@pytest.mark.parametrize("buckets", [None, 4])
def test_batches_beside_the_base(spark, place, buckets, monkeypatch):
    monkeypatch.setattr(suggestions, "PATHS_PER_READ", 2)
    lst, out = f"{place}/lst", f"{place}/table"
    for i in range(8):
        _put(place, str(i), f"first {i}", 1_600_000_000 + i)
    store = suggestions.start(spark, lst, out, buckets)
    assert _lines(store) == {str(i): f"first {i}" for i in range(8)}
    assert suggestions.ingest_new(spark, lst, out) == suggestions.Ingested(None, 0)

    # one file is written anew with its old time and length: proof that it is not read again
    _put(place, "0", "FIRST 0", 1_600_000_000)
    for i in (3, 5):
        _put(place, str(i), f"second {i}", 1_600_000_100)
    _put(place, "2021/77", "sub", 1_500_000_000)  # new, though older than all others
    _put(place, "a[1]{x}", "pattern", 1_600_000_200)
    assert suggestions.ingest_new(spark, lst, out) == suggestions.Ingested(1, 4)
    assert suggestions.ingest_new(spark, lst, out).n_files == 0
    _put(place, "5", "third 5", 1_600_000_300)
    assert suggestions.ingest_new(spark, lst, out) == suggestions.Ingested(2, 1)

    want = {str(i): f"first {i}" for i in range(8)} | {"3": "second 3", "5": "third 5", "2021/77": "sub", "a[1]{x}": "pattern"}
    store = suggestions.read(spark, out)
    assert _lines(store) == want
    keys = [*want, "none", None, "5", "5", "5"]
    for more in ({}, {"hot_share": 10**6, "salt_rows": 1}, {"hot_share": 10**6, "salt_rows": 2}):
        assert _joined(spark, store, keys, **more) == {k: want.get(k) for k in keys}

    os.remove(os.path.join(lst, "3.LST"))  # a removed file keeps its line
    folded = suggestions.compact(spark, out)
    assert _lines(folded) == want and folded.newer.count() == 0 and suggestions._batches(spark, out) == [0]
    if buckets:
        assert files._stored_buckets(spark, out) == buckets
    assert suggestions.ingest_new(spark, lst, out).n_files == 0
    _put(place, "9", "late", 1_600_000_400)
    assert suggestions.ingest_new(spark, lst, out).n_files == 1
    assert _lines(suggestions.read(spark, out)) == want | {"9": "late"}


def test_a_failed_batch_is_repeated(spark, place, monkeypatch):
    lst, out = f"{place}/lst", f"{place}/table"
    _put(place, "1", "one", 1_600_000_000)
    suggestions.start(spark, lst, out)
    _put(place, "2", "two", 1_600_000_001)
    _put(place, "3", "three", 1_600_000_001)
    monkeypatch.setattr(suggestions, "PATHS_PER_READ", 1)
    real, calls = files.line_of_lst, []

    def breaks(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(files, "line_of_lst", breaks)
    with pytest.raises(RuntimeError):
        suggestions.ingest_new(spark, lst, out)
    assert _lines(suggestions.read(spark, out)) == {"1": "one"}  # a half batch does not count
    assert suggestions.ingest_new(spark, lst, out) == suggestions.Ingested(1, 2)
    assert _lines(suggestions.read(spark, out)) == {"1": "one", "2": "two", "3": "three"}


def test_bucketed_base_stays_unshuffled_beside_batches(spark, place):
    lst, out = f"{place}/lst", f"{place}/table"
    for i in range(4):
        _put(place, str(i), f"x {i}", 1_600_000_000)
    suggestions.start(spark, lst, out, 8)
    _put(place, "7", "new", 1_600_000_001)
    suggestions.ingest_new(spark, lst, out)
    docs = spark.createDataFrame([("a", "1"), ("b", "7")], "source_file string, application_key string")
    plan = doc_lst_join(docs, suggestions.read(spark, out))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan


def test_ingest_without_a_start_is_an_error(spark, place):
    os.makedirs(f"{place}/lst")
    files.ingest_lst(spark, f"{place}/lst", f"{place}/table")
    with pytest.raises(ValueError):
        suggestions.ingest_new(spark, f"{place}/lst", f"{place}/table")
    assert _lines(suggestions.start(spark, f"{place}/nowhere", f"{place}/other")) == {}


def test_failing_ingest_keeps_the_table(spark, place, monkeypatch):
    _put(place, "1", "one", 1_600_000_000)
    for buckets in (None, 4):
        out = f"{place}/kept{buckets}"
        files.ingest_lst(spark, f"{place}/lst", out, buckets)
        monkeypatch.setattr(files, "line_of_lst", lambda *a: F.raise_error(F.lit("bad store")).cast("string"))
        with pytest.raises(Exception, match="bad store"):
            files.ingest_lst(spark, f"{place}/lst", out, buckets)
        monkeypatch.undo()
        again = files.lst_table(spark, out) if buckets else spark.read.parquet(out)
        assert [r["ai_line"] for r in again.collect()] == ["AI_IPC:one"]
