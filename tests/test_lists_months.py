"""List codecs (P4-P6, J5), month functions (D5, S5, S6, K2) and split points."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import eval_col
from ipcforge.functions import (
    bulletin_code_from_key,
    dataset_code_from_key,
    dataset_name,
    decode_code_list,
    decode_score_list,
    encode_code_list,
    encode_score_list,
    month_series,
    zip_scores,
)
from ipcforge.operators.split import month_split


def test_encode_lists(spark):
    df = spark.createDataFrame([(["a", None, "b"], [1.5, None, 22.23])], "c array<string>, s array<double>")
    r = df.select(encode_code_list("c"), encode_score_list("s")).first()
    assert r[0] == "a||b" and r[1] == "1.5||22.23"


def test_decode_code_list(spark):
    vals = ["a|b", "a||b|", " a|b ", "['x', 'y']", "[broken", "['x', ", "", None, "[]"]
    got = eval_col(spark, vals, decode_code_list)
    assert got == [["a", "b"], ["a", "b"], ["a", "b"], ["x", "y"], ["[broken"], ["['x',"], [], [], []]


def test_decode_score_list(spark):
    vals = ["1.0|2.5", "1.0||3.0", "", "[1.0, 2.5]", "[1.0, 'x']", " 7 ", None]
    got = eval_col(spark, vals, decode_score_list)
    assert got == [[1.0, 2.5], [1.0, None, 3.0], [], [1.0, 2.5], [], [7.0], []]


def test_zip_scores_positional(spark):
    df = spark.createDataFrame([(["a", "b", "c"], [1.0]), (["a"], [1.0, 2.0, 3.0])], "c array<string>, s array<double>")
    rows = df.select(zip_scores("c", "s").alias("z")).collect()
    assert [(x["code"], x["score"]) for x in rows[0]["z"]] == [("a", 1.0), ("b", None), ("c", None)]
    assert [(x["code"], x["score"]) for x in rows[1]["z"]] == [("a", 1.0)]


token = st.text(alphabet=st.characters(blacklist_characters="|", blacklist_categories=("Cs",)), min_size=1, max_size=8)


@settings(max_examples=25, deadline=None)
@given(st.lists(token.filter(lambda s: s.strip() == s and not s.startswith("[")), max_size=6))
def test_decode_encode_roundtrip(spark, xs):
    df = spark.createDataFrame([(xs,)], "c array<string>")
    got = df.select(decode_code_list(encode_code_list("c"))).first()[0]
    assert got == xs


def test_month_series(spark):
    df = spark.createDataFrame([("202603", 4), ("202603", 0), ("202601", 2), ("202603", -1)], "c string, n int")
    got = [r[0] for r in df.select(month_series("c", F.col("n"))).collect()]
    assert got == [["202603", "202602", "202601", "202512"], [], ["202601", "202512"], []]


def test_bulletin_and_dataset_keys(spark):
    keys = ["pub/202603.zip", "pub/202699.zip", "pub/2026.zip", "pub/x/202603.zip", "pub/202603.ZIP",
            "pub/abcdef.zip", "other/202603.zip"]
    assert eval_col(spark, keys, lambda c: bulletin_code_from_key(c, "pub/")) == [
        "202603", "202699", None, None, None, None, None]
    ds = ["d/ipc_with_ai_202603_last_10.parquet", "d/ipc_with_ai_2026_last_1.parquet",
          "d/ipc_with_ai_202603_last_.parquet", "d/ipc_with_ai_202603_last_10.parquet\n"]
    assert eval_col(spark, ds, lambda c: dataset_code_from_key(c, "d/")) == ["202603", None, None, "202603"]
    r = spark.range(1).select(dataset_name(F.lit("202603"), 10)).first()[0]
    assert r == "ipc_with_ai_202603_last_10.parquet"


def test_split_points(spark):
    # n months -> number of train months at 2/3 (FIXTURES.md §3.5)
    expected = {1: 0, 2: 1, 3: 2, 4: 2, 5: 3, 6: 4, 9: 6, 10: 6, 12: 8}
    for n, want in expected.items():
        rows = [(f"2020{m:02d}" if m <= 12 else f"2021{m - 12:02d}",) for m in range(1, n + 1)]
        df = spark.createDataFrame(rows + [(None,)], "bulletin_code string")
        got = month_split(df).where("split = 'train'").count()
        assert got == want, n
