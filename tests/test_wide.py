"""Wide-table routing and XML contracts on hand-made documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ipcforge.operators.long import wide_to_long
from ipcforge.operators.wide import WIDE_COLUMNS, build_wide, decode_wide, encode_wide
from ipcforge.session import cut_lineage
from ipcforge.sources.xmldocs import parse_document, parse_patent_xml


def build_wide_from_documents(docs, lst):
    return build_wide(cut_lineage(parse_patent_xml(docs)), lst)


def _doc(app: str | None, codes: list[str | None], extra: str = "") -> str:
    app_el = "" if app is None else f"<B210>{app}</B210>"
    nodes = "".join(
        "<classification-ipcr><text/></classification-ipcr>" if c is None
        else f"<classification-ipcr><text>{c}</text></classification-ipcr>"
        for c in codes
    )
    return f"<doc><B110>RU1</B110>{app_el}<B480><date>20260301</date></B480>{nodes}{extra}</doc>"


def test_parse_document_semantics():
    assert parse_document("<r><B110>x<i/>y</B110></r>")[0] == "x"  # text before the first child
    assert parse_document("<r><a><B110></B110></a></r>")[0] == ""  # present but empty
    assert parse_document("<r><a/></r>")[0] is None  # absent
    assert parse_document('<!DOCTYPE r SYSTEM "a.dtd"><r><B110>1</B110></r>')[0] == "1"
    assert parse_document("<r/>junk")[4] is not None  # trailing junk is an error
    assert parse_document("<B110>1</B110>")[0] is None  # the root itself does not match
    assert parse_document(None)[4] is not None


def test_routing_and_keys(spark):
    docs = [
        ("202603", "a/Document.xml", _doc(" 77 ", ["a61k 31/00", None, "C07D 401/10 20060101"])),
        ("202603", "b/Document.xml", _doc("   ", ["A61K 31/00"])),
        ("202603", "c/Document.xml", _doc(None, [])),
        ("202603", "d/Document.xml", "<doc><B110>oops</doc>"),
        ("202603", "e/Document.xml", _doc("88", ["A61K 31/00"])),  # file without an AI line
        ("202603", "f/Document.xml", _doc("99", [])),  # no file at all
        ("202603", "g/Document.xml", _doc("77", ["X"])),  # duplicated application: both match
    ]
    df = spark.createDataFrame(docs, "bulletin_code string, source_file string, xml string")
    lst = spark.createDataFrame(
        [("77", "AI_IPC:A61K 31/00 (50.0%);C07D 401/00;A61K 31/00 (1%);"), ("88", "")],
        "application_key string, ai_line string",
    )
    wide = {r["source_file"]: r for r in build_wide_from_documents(df, lst).collect()}
    assert set(wide) == {"a/Document.xml", "b/Document.xml", "c/Document.xml", "d/Document.xml", "g/Document.xml"}
    a = wide["a/Document.xml"]
    assert a["application_number"] == " 77 " and a["lst_key"] == "lst/77.LST" and a["lst_found"] is True
    assert a["expert_ipc_canon"] == ["A61K 31/00", "C07D 401/10"] and a["expert_ipc_count"] == 2
    assert a["ai_ipc_canon"] == ["A61K 31/00", "C07D 401/00", "A61K 31/00"] and a["ai_scores"] == [50.0, None, 1.0]
    b = wide["b/Document.xml"]
    assert b["error"] == "application_number is empty" and b["expert_ipc_canon"] == ["A61K 31/00"]
    assert b["lst_found"] is False and b["ai_ipc_count"] == 0 and b["patent_number"] == "RU1"
    assert wide["c/Document.xml"]["error"] == "application_number is empty"
    d = wide["d/Document.xml"]
    assert d["error"] and d["patent_number"] is None and d["expert_ipc_count"] == 0 and d["ai_ipc_raw"] == []

    long = wide_to_long(build_wide_from_documents(df, lst)).where(F.col("patent_id") == " 77 ").orderBy("rank").collect()
    assert [(r["rank"], r["ipc_code"], r["y"], r["ai_score"]) for r in long] == [
        (1, "A61K 31/00", 1.0, 50.0), (2, "C07D 401/00", 0.5, None), (3, "A61K 31/00", 1.0, 1.0)]


def test_encode_decode_wide_roundtrip(spark):
    docs = [("202603", "a/Document.xml", _doc("77", ["A61K 31/00"]))]
    df = spark.createDataFrame(docs, "bulletin_code string, source_file string, xml string")
    lst = spark.createDataFrame([("77", "AI_IPC:B01K 1/00 (2.5%);C01K 2/00")], "application_key string, ai_line string")
    wide = build_wide_from_documents(df, lst)
    enc = encode_wide(wide)
    assert enc.first()["ai_scores"] == "2.5|"
    back = decode_wide(enc).first()
    orig = wide.first()
    assert [back[c] for c in WIDE_COLUMNS] == [orig[c] for c in WIDE_COLUMNS]


def test_error_rows_spread_over_join_partitions(spark):
    """Rows without an application key must not all hash into one join partition."""
    from ipcforge.operators.wide import doc_lst_join

    docs = spark.range(4000).select(
        F.concat(F.col("id").cast("string"), F.lit("/Document.xml")).alias("source_file"),
        F.when(F.col("id") < 10, F.col("id").cast("string")).alias("application_key"),
    )
    lst = spark.range(10).select(F.col("id").cast("string").alias("application_key"), F.lit("AI_IPC:x").alias("ai_line"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = doc_lst_join(docs, lst)
        per_part = joined.where(F.col("application_key").isNull()).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert joined.count() == 4000
        assert joined.where(F.col("ai_line").isNotNull()).count() == 10
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert max(r["count"] for r in per_part) < 3990 / 2


def _hot_docs(spark):
    return spark.range(6000).select(
        F.concat(F.col("id").cast("string"), F.lit("/Document.xml")).alias("source_file"),
        F.when(F.col("id") % 50 == 0, F.lit(None))
        .when(F.col("id") < 4000, F.lit("HOT"))
        .otherwise((F.col("id") % 300).cast("string"))
        .alias("application_key"),
    )


def _hot_lines(spark):
    return spark.createDataFrame(
        [("HOT", "AI_IPC:hot")] + [(str(i), f"AI_IPC:{i}") for i in range(0, 300, 2)],
        "application_key string, ai_line string",
    )


def test_hot_key_join_matches_plain_join(spark):
    """One application key holding most documents: same rows, spread over tasks."""
    from ipcforge.operators.wide import doc_lst_join

    docs, lst = _hot_docs(spark), _hot_lines(spark)
    plain = docs.join(lst, "application_key", "left").select("source_file", "application_key", "ai_line")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = doc_lst_join(docs, lst, salt_rows=500)
        assert hot.columns == plain.columns
        assert hot.exceptAll(plain).count() == 0 and plain.exceptAll(hot).count() == 0
        per_part = hot.where(F.col("application_key") == "HOT").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(r["count"] for r in per_part) == 3920
    assert max(r["count"] for r in per_part) < 3920 / 2


def test_any_number_of_keys_may_be_hot(spark):
    """Every key counts as hot, far more than any fixed bound would allow."""
    from ipcforge.operators.wide import doc_lst_join

    docs = spark.range(30000).select(
        F.concat(F.col("id").cast("string"), F.lit("/Document.xml")).alias("source_file"),
        (F.col("id") % 12000).cast("string").alias("application_key"))
    lst = spark.range(12000).select(F.col("id").cast("string").alias("application_key"), F.concat(F.lit("AI_IPC:"), "id").alias("ai_line"))
    got = doc_lst_join(docs, lst, hot_share=10**6, salt_rows=1)
    assert got.where("ai_line = concat('AI_IPC:', application_key)").count() == got.count() == 30000


def test_codeless_item_keeps_scores_with_their_codes(spark):
    """An item that is only a date has a score and no code; both list forms give the same long rows."""
    df = spark.createDataFrame([("202603", "a/Document.xml", _doc("77", ["B01K 1/00"]))], "bulletin_code string, source_file string, xml string")
    lst = spark.createDataFrame([("77", "AI_IPC:20060101 (50%);B01K 1/00 (9%)")], "application_key string, ai_line string")
    wide = build_wide_from_documents(df, lst)
    for form in (wide, encode_wide(wide), decode_wide(encode_wide(wide))):
        assert [(r["rank"], r["ipc_code"], r["ai_score"]) for r in wide_to_long(form).collect()] == [(1, "B01K 1/00", 9.0)]
