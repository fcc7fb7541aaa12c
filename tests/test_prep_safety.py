"""What the jobs do with broken inputs, empty runs, crashes and foreign workers."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, unzipped
from ipcforge.plans.jobs import _join, prep_job, read_table, read_wide, select_job, train_job, write_table
from ipcforge.sources import files
from ipcforge.sources.files import archive_ranges, ingest_lst, list_object_keys, lst_table, scan_lst

DOC = ("<d><B110>RU{n}</B110><B210>{app}</B210><B480><date>20210301</date></B480>"
       "<classification-ipcr><text>A01K 31/00</text></classification-ipcr></d>")


def _write(root: str, month: str, apps: list[str], broken: str | None = None) -> None:
    os.makedirs(os.path.join(root, "pub"), exist_ok=True)
    path = os.path.join(root, "pub", f"{month}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for n, app in enumerate(apps):
            zf.writestr(f"{month}/{n}/Document.xml", DOC.format(n=n, app=app))
        zf.writestr(f"{month}/note.txt", "no document")
    if broken:
        with zipfile.ZipFile(path) as zf:
            info = zf.getinfo(broken)
            at = info.header_offset + 30 + len(info.filename) + 4
        data = bytearray(open(path, "rb").read())
        data[at] ^= 0xFF  # inside the packed content: its checksum is wrong now
        open(path, "wb").write(bytes(data))


def _suggest(root: str, app: str, line: str = "AI_IPC:A01K 31/00 (9%);B01K 1/00 (5%)") -> None:
    path = os.path.join(root, "lst", f"{app}.LST")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    open(path, "w").write("HEAD\n" + line + "\n")


@pytest.fixture
def place():
    return tempfile.mkdtemp(prefix="ipcforge-safety-")


def test_corrupt_member_is_one_error_row(spark, place):
    _write(place, "202103", ["1", "2", "3"], broken="202103/1/Document.xml")
    for app in "123":
        _suggest(place, app)
    res = prep_job(spark, f"{place}/pub", f"{place}/lst", f"{place}/out", "last", 1)
    wide = read_wide(spark, res.output_path)
    assert res.rows == 3 and wide.where("error is not null").select("source_file").collect()[0][0] == "202103/1/Document.xml"
    plain = unzipped(spark, f"{place}/pub", ["202103"])
    assert plain.where("xml is null").count() == 1 and plain.count() == 3


def test_slash_in_the_application_number(spark, place):
    _write(place, "202103", ["2021/77"])
    _suggest(place, "2021/77")
    assert scan_lst(spark, f"{place}/lst").first()["application_key"] == "2021/77"
    res = prep_job(spark, f"{place}/pub", f"{place}/lst", f"{place}/out", "last", 1)
    assert res.rows == 1 and read_wide(spark, res.output_path).first()["lst_key"] == "lst/2021/77.LST"


def test_empty_rerun_keeps_the_dataset(spark, place):
    _write(place, "202103", ["1"])
    _suggest(place, "1")
    first = prep_job(spark, f"{place}/pub", f"{place}/lst", f"{place}/out", "last", 1)
    again = prep_job(spark, f"{place}/pub", f"{place}/nothing", f"{place}/out", "last", 1)  # no suggestions: no rows
    assert again.rows == 0 and again.output_path is None
    assert read_wide(spark, first.output_path).count() == 1
    third = prep_job(spark, f"{place}/pub", f"{place}/lst", f"{place}/out", "last", 1)
    assert third.rows == 1 and os.listdir(f"{place}/out") == [os.path.basename(first.output_path)]


def test_month_that_is_none(spark, place):
    _write(place, "202113", ["1"])
    with pytest.raises(ValueError, match="not a calendar month"):
        prep_job(spark, f"{place}/pub", f"{place}/lst", f"{place}/out", "last", 1)


def test_bucket_number_is_kept_with_the_table(spark, place):
    for i in range(40):
        _suggest(place, str(i))
    ingest_lst(spark, f"{place}/lst", f"{place}/table", buckets=4)
    other = spark.newSession()  # another session reopens it by its place
    other.sql(f"DROP TABLE IF EXISTS {files._lst_table_name(place + '/table')}")
    table = lst_table(other, f"{place}/table")
    docs = other.range(40).select(F.col("id").cast("string").alias("application_key"))
    assert docs.join(table, "application_key").count() == 40
    with pytest.raises(ValueError, match="4 buckets"):
        lst_table(other, f"{place}/table", 8)


def test_each_archive_directory_is_read_once(spark, place, monkeypatch):
    _write(place, "202103", [str(i) for i in range(50)])
    opened = []
    monkeypatch.setattr(files, "RANGE_BYTES", 1000)
    monkeypatch.setattr(zipfile.ZipFile, "_RealGetContents",
                        lambda self, f=zipfile.ZipFile._RealGetContents: (opened.append(1), f(self))[1])
    import pandas as pd

    ranges = pd.concat(files._list_ranges(iter([pd.DataFrame({"bulletin_code": ["202103"], "path": [f"file://{place}/pub/202103.zip"]})])))
    rows = pd.concat(files._read_and_parse(iter([ranges])))
    assert len(ranges) > 5 and len(rows) == 50 and rows["parse_error"].isna().all() and len(opened) == 1
    keys = list_object_keys(spark, f"{place}/pub", "*.zip").select(F.lit("202103").alias("bulletin_code"), F.concat(F.lit(f"file://{place}/pub/"), "key").alias("path"))
    assert archive_ranges(keys).agg(F.sum(F.size("members"))).first()[0] == 50


def test_crashed_write_does_not_block_the_table(spark, place):
    base = f"{place}/state"
    write_table(spark.range(1).selectExpr("id AS x"), base)
    os.makedirs(f"{base}/v=2")  # a write that never finished
    assert write_table(spark.range(5).selectExpr("id AS x"), base).endswith("v=3")
    assert read_table(spark, base, "x long").count() == 5


def test_two_rounds_and_a_missing_model(spark, place):
    rng = [f"2021{m:02d}" for m in range(1, 7)]
    for m in rng:
        _write(place, m, [f"{m}{i}" for i in range(4)])
        for i in range(4):
            _suggest(place, f"{m}{i}")
    prep_job(spark, f"{place}/pub", f"{place}/lst", f"{place}/out", "last", 6)
    for first in (1, 4):
        runs = train_job(spark, f"{place}/out", f"{place}/models", "last", 6, max_iter=2, model_name="other")
        assert sorted(int(r["model_version"]) for r in runs.collect()) == [first, first + 1, first + 2]
        assert {r["model_name"] for r in runs.collect()} == {"other"}
    assert read_table(spark, f"{place}/models/versions", "model_name string, model_version string, run_id string").count() == 6
    import json

    meta = json.load(open(f"{place}/models/candidates/v1_reg_base_meta.json"))
    assert meta["model_name"] == "other" and meta["config"]["random_state"] == "42" and "val_rmse" in meta["metrics"]
    prod = f"{place}/prod"
    os.rename(f"{place}/models/candidates", f"{place}/models/elsewhere")
    with pytest.raises(FileNotFoundError):
        select_job(spark, f"{place}/models", prod)
    assert not os.path.exists(f"{prod}/aliases") and not os.path.exists(f"{prod}/registry")
    os.rename(f"{place}/models/elsewhere", f"{place}/models/candidates")
    done = select_job(spark, f"{place}/models", prod)
    registry = read_table(spark, _join(prod, "registry"), "slot string, source_model_key string").first()
    assert done["promote"] and registry["source_model_key"].startswith(f"{place}/models/candidates/")
    aliases = read_table(spark, _join(prod, "aliases"), "model_name string, alias string").first()
    assert aliases["model_name"] == "other"


def test_jobs_run_without_the_package_on_the_workers(place):
    _write(place, "202103", ["1", "2"])
    _suggest(place, "1")
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "from ipcforge.session import get_session\n"
        "from ipcforge.plans.jobs import prep_job\n"
        "from ipcforge.sources.files import scan_lst\n"
        "from ipcforge.streaming.bulletins import read_stream_output, start_prep_stream\n"
        "s = get_session(master='local[2]', shuffle_partitions=2)\n"
        f"print('ROWS', prep_job(s, {place!r} + '/pub', {place!r} + '/lst', {place!r} + '/out', 'last', 1).rows)\n"
        f"q = start_prep_stream(s, {place!r} + '/pub', scan_lst(s, {place!r} + '/lst'), {place!r} + '/stream')\n"
        "q.awaitTermination(200)\n"
        f"print('STREAM', read_stream_output(s, {place!r} + '/stream').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS 1" in out.stdout and "STREAM 1" in out.stdout


def test_own_settings_survive_get_session(spark):
    from ipcforge.session import get_session

    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "123")
    try:
        assert get_session().conf.get(key) == "123"
    finally:
        spark.conf.set(key, old)
