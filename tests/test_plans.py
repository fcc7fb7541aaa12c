"""Plan-shape tests: the physical plans we want at scale, not just the right rows."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ipcforge.operators.long import label_distribution_by_month, wide_to_long
from ipcforge.operators.split import split_long
from ipcforge.operators.wide import encode_wide
from ipcforge.plans import derived
from ipcforge.sources.xmldocs import parse_patent_xml


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wide_path(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ipcforge-plan-"), "wide.parquet")
    encode_wide(derived.wide(spark, SF_SMALL)).write.parquet(path)
    return path


def test_wide_to_long_is_one_narrow_stage(spark, wide_path):
    long = wide_to_long(spark.read.parquet(wide_path))
    plan = _plan(long)
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "Generate" in plan


def test_wide_read_prunes_columns(spark, wide_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    long = wide_to_long(spark.read.parquet(wide_path))
    scan = [ln for ln in _plan(long).split("\n") if "FileScan parquet" in ln][0]
    schema = scan.split("ReadSchema:")[1]
    for unused in ("source_file", "patent_number", "lst_key", "ai_ipc_raw", "error"):
        assert unused not in schema, schema
    for used in ("expert_ipc_canon", "ai_ipc_canon", "ai_scores", "bulletin_code", "application_number"):
        assert used in schema


def test_label_distribution_aggregates_before_shuffle(spark, wide_path):
    dist = label_distribution_by_month(wide_to_long(spark.read.parquet(wide_path)))
    plan = _plan(dist)
    assert "partial_count" in plan
    exchange_at = plan.index("Exchange")
    assert plan.index("partial_count") > exchange_at  # partial agg is below (after) the exchange line


def test_month_dimension_is_broadcast(spark, wide_path):
    split = split_long(wide_to_long(spark.read.parquet(wide_path)))
    split.write.format("noop").mode("overwrite").save()
    plan = _plan(split)
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert split.where(F.col("split").isNull()).count() == 0


def test_xml_parse_is_the_only_python_step(spark):
    parsed = _plan(parse_patent_xml(derived.documents(spark, SF_SMALL)))
    assert parsed.count("MapInPandas") == 1 and "BatchEvalPython" not in parsed
    plan = _plan(derived.wide(spark, SF_SMALL))
    assert "MapInPandas" not in plan  # the join reads the parsed documents written
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


FACT_QUERIES = [
    "label_distribution_by_month", "wide_to_long", "wide_to_long_encoded", "build_wide", "bulletin_counts",
    "doc_lst_join", "parse_ai_line", "canonicalize_code", "expert_codes", "code_parts", "exact_match_semi",
    "main_match_semi", "unmatched_anti", "top_k_codes",
]


@pytest.mark.parametrize("name", FACT_QUERIES)
def test_fact_queries_never_funnel_into_one_task(spark, name):
    """No single-partition exchange, no row-at-a-time Python, at most one document parse per plan."""
    import __spark_entry__ as E

    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "SinglePartition" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("MapInPandas") <= 1


def test_window_filter_does_not_shuffle_rows_by_month(spark):
    import __spark_entry__ as E

    df = E.queries()["window_filter"](spark, SF_SMALL)
    df.collect()
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_match_operators_are_narrow(spark, wide_path):
    from ipcforge.operators.long import exact_match_semi, main_match_semi, unmatched_anti

    wide = spark.read.parquet(wide_path)
    for op in (exact_match_semi, main_match_semi, unmatched_anti):
        assert "Exchange" not in _plan(op(wide))


def test_registry_queries_scan_one_small_table(spark):
    import __spark_entry__ as E

    for name in ("set_alias", "rotate_slots", "promotion_decision"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "lineitem" not in plan and plan.count("FileScan") <= 8, name


def test_fixed_predictor_makes_the_long_rows_once(spark, tmp_path):
    from ipcforge.operators.metrics import evaluate_by_month

    rows = [(f"2021{m:02d}", float(i % 2), 0.5 * i) for m in range(1, 7) for i in range(4)]
    spark.createDataFrame(rows, "bulletin_code string, y double, p double").write.parquet(f"{tmp_path}/rows")
    found = evaluate_by_month(spark.read.parquet(f"{tmp_path}/rows"), F.col("p"))
    assert not any(str(tmp_path) in f for f in found.inputFiles())
    assert [(r["n_train"], r["n_val"]) for r in found.collect()] == [(16, 8)]
