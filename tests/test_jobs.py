"""File tests: bulletin ZIPs and .LST files in a scratch folder, then the three jobs."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ipcforge.operators.long import wide_to_long
from ipcforge.operators.wide import encode_wide
from ipcforge.plans import derived
from ipcforge.plans.jobs import prep_job, read_results, select_job, train_job
from ipcforge.sources import tables
from ipcforge.sources.files import scan_lst


@pytest.fixture(scope="module")
def bucket(spark):
    """pub/YYYYMM.zip + lst/<app>.LST written from the derived sf0.001 inputs."""
    root = tempfile.mkdtemp(prefix="ipcforge-bucket-")
    pub, lst = os.path.join(root, "pub"), os.path.join(root, "lst")
    os.makedirs(os.path.join(pub, "x"))
    os.makedirs(lst)
    cl = tables.code_lines(spark, SF_SMALL)
    docs = tables.bulletin_documents(spark, SF_SMALL, cl).collect()  # small test fixture
    by_month: dict[str, list] = {}
    for d in docs:
        by_month.setdefault(d["bulletin_code"], []).append(d)
    months = sorted(by_month)
    keep = months[-6:]
    skipped = keep[2]  # a month inside the window without an archive
    for m in keep:
        if m == skipped:
            continue
        with zipfile.ZipFile(os.path.join(pub, f"{m}.zip"), "w") as zf:
            for d in by_month[m]:
                zf.writestr(d["source_file"], d["xml"])
            zf.writestr(f"{m}/readme.txt", "not a document")
    with zipfile.ZipFile(os.path.join(pub, "x", f"{keep[-1]}.zip"), "w") as zf:
        zf.writestr("junk/Document.xml", "<a/>")
    for f in tables.ai_files(cl).collect():
        with open(os.path.join(lst, f"{f['application_key']}.LST"), "wb") as fh:
            data = f["text"].encode("utf-8")
            if int(f["application_key"]) % 13 == 0:
                # undecodable bytes in the header and right after the marker are dropped
                data = b"\xff\xfe" + data.replace(b"AI_IPC:", b"AI_IPC:\xc3", 1)
            fh.write(data)
    return {"root": root, "pub": pub, "lst": lst, "months": keep, "skipped": skipped}


def test_scan_lst_drops_invalid_bytes(spark, bucket):
    got = scan_lst(spark, bucket["lst"])
    row = got.where(F.col("application_key") == "13").first()
    assert row is None or row["ai_line"].startswith("AI_IPC:")
    assert got.where(F.col("ai_line") == "").count() == 0


def test_prep_train_select(spark, bucket):
    out = os.path.join(bucket["root"], "dataprep")
    res = prep_job(spark, bucket["pub"], bucket["lst"], out, "last", 5)
    assert res.resolved_month == bucket["months"][-1]
    assert len(res.window) == 5 and bucket["skipped"] in res.window
    wide = spark.read.parquet(res.output_path)
    # same rows as the table-derived path restricted to the archives present
    present = [m for m in res.window if m != bucket["skipped"]]
    expected = encode_wide(derived.wide(spark, SF_SMALL)).where(F.col("bulletin_code").isin(present))
    cols = [c for c in wide.columns if c != "error"]
    assert wide.select(cols).exceptAll(expected.select(cols)).count() == 0
    assert expected.select(cols).exceptAll(wide.select(cols)).count() == 0
    assert wide.where("error is not null").count() == expected.where("error is not null").count()
    assert wide_to_long(wide).count() == wide_to_long(expected).count()

    with pytest.raises(ValueError, match="not among"):
        prep_job(spark, bucket["pub"], bucket["lst"], out, "209901", 2)
    with pytest.raises(ValueError, match="six digits"):
        prep_job(spark, bucket["pub"], bucket["lst"], out, "2026-1", 2)

    # train on a 12-month window so both sides of the split have rows
    res12 = prep_job(spark, bucket["pub"], bucket["lst"], out, "last", 12)
    models = os.path.join(bucket["root"], "models")
    runs = train_job(spark, out, models, "last", 12, max_iter=3)
    got = {r["candidate_name"]: r for r in runs.collect()}
    assert set(got) == {"v1_reg_base", "v1_reg_shallow", "v1_reg_no_ipc_parts"}
    assert all(r["model_version"] is not None for r in got.values())
    assert read_results(spark, os.path.join(models, "results")).count() == 3
    assert res12.rows > 0

    prod = os.path.join(bucket["root"], "prod")
    first = select_job(spark, models, prod, "0.0")
    assert first["promote"] is True and first["reason"] == "no_current_champion"
    second = select_job(spark, models, prod, "0.0")
    assert second["promote"] is False  # equal error is not strictly better
    assert os.path.isdir(first["promoted_model_key"].replace("file:", ""))


def test_prep_with_compacted_suggestions(spark, bucket):
    from ipcforge.sources.files import ingest_lst

    compact = ingest_lst(spark, bucket["lst"], os.path.join(bucket["root"], "lst_compact"))
    out = os.path.join(bucket["root"], "dataprep_compact")
    a = prep_job(spark, bucket["pub"], compact, out, "last", 3)
    b = prep_job(spark, bucket["pub"], bucket["lst"], os.path.join(bucket["root"], "dataprep_files"), "last", 3)
    assert a.rows == b.rows > 0
    wa, wb = spark.read.parquet(a.output_path), spark.read.parquet(b.output_path)
    assert wa.exceptAll(wb).count() == 0 and wb.exceptAll(wa).count() == 0


def test_one_archive_spreads_over_tasks(spark, bucket):
    from ipcforge.sources import files
    from conftest import unzipped
    from ipcforge.sources.files import archive_ranges, read_archive_documents
    from ipcforge.sources.xmldocs import parse_patent_xml

    zips = [os.path.join(bucket["pub"], f) for f in os.listdir(bucket["pub"]) if f.endswith(".zip")]
    biggest = max(zips, key=os.path.getsize)
    month = os.path.basename(biggest)[:6]
    path = "file://" + biggest
    archives = spark.createDataFrame([(month, path)], "bulletin_code string, path string")
    old, files.RANGE_BYTES = files.RANGE_BYTES, 2000  # the test archive is small
    try:
        ranges = archive_ranges(archives).collect()
        docs = read_archive_documents(spark.createDataFrame(ranges, files.RANGE_SCHEMA), 8)
    finally:
        files.RANGE_BYTES = old
    assert len(ranges) >= 4 and all(r["last"] - r["first"] <= 2000 or len(r["members"]) == 1 for r in ranges)
    tasks = docs.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 3  # one archive, many reading tasks
    fallback = parse_patent_xml(unzipped(spark, bucket["pub"], [month]))
    cols = ["bulletin_code", "source_file", "patent_number", "application_number", "bulletin_date"]
    assert docs.select(cols).exceptAll(fallback.select(cols)).count() == 0
    assert docs.count() == fallback.count() > 0


def test_prep_with_bucketed_suggestions(spark, bucket):
    from ipcforge.operators.wide import build_wide
    from ipcforge.sources.files import ingest_lst, lst_table

    path = os.path.join(bucket["root"], "lst_bucketed")
    ingest_lst(spark, bucket["lst"], path, buckets=8)
    table = lst_table(spark, path, 8)  # re-registration by location is idempotent
    docs = spark.createDataFrame(
        [("200101", "a/Document.xml", "RU1", "1", "20010101", ["A01K 31/00"], None)],
        "bulletin_code string, source_file string, patent_number string, application_number string, "
        "bulletin_date string, ipc_texts array<string>, parse_error string",
    )
    plan = build_wide(docs, table)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    a = prep_job(spark, bucket["pub"], table, os.path.join(bucket["root"], "dataprep_bucketed"), "last", 3)
    b = spark.read.parquet(os.path.join(bucket["root"], "dataprep_files", os.path.basename(a.output_path)))
    wa = spark.read.parquet(a.output_path)
    assert wa.exceptAll(b).count() == 0 and b.exceptAll(wa).count() == 0


def test_hot_key_on_a_bucketed_table_spreads(spark, bucket):
    """All documents have one application number; the suggestion side is bucketed."""
    from ipcforge.operators.wide import doc_lst_join
    from ipcforge.sources.files import lst_table

    table = lst_table(spark, os.path.join(bucket["root"], "lst_bucketed"))
    docs = spark.range(4000).select(F.concat(F.col("id").cast("string"), F.lit("/Document.xml")).alias("source_file"),
                                    F.lit("1").alias("application_key"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = doc_lst_join(docs, table, salt_rows=100)
        per_part = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(r["count"] for r in per_part) == 4000 and max(r["count"] for r in per_part) < 2000
    assert joined.where("ai_line is not null").count() == 4000
