"""Golden cases for the code functions (FIXTURES.md §3.1-3.4)."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import eval_col
from ipcforge.functions import (
    canonicalize_code,
    code_parts,
    expert_codes,
    first_ai_line,
    has_ai_items,
    label_match,
    main_group_of,
    parse_ai_line,
)

CANON_CASES = [
    ("c07d401/00", "C07D 401/00"),
    ("A61K  31/00 20060101AFI", "A61K 31/00"),
    ("A61K 0031/0012", "A61K 31/0012"),
    ("A61K 000031/00", "A61K 31/00"),
    ("C07D 4 01/00", "C07D 401/00"),
    ("A61K 0000 31/00", "A61K 0000 31/00"),
    ("A61K31 / 00", "A61K 31/00"),
    ("C07D401/0020060101", "C07D401/"),
    ("20060101", None),
    ("   ", None),
    (None, None),
    ("", None),
    ("X99Z 1/00", "X99Z 1/00"),
    ("A61K 31/0", "A61K 31/0"),
    ("A61K 31/00 (2006.01)", "A61K 31/00 (2006.01)"),
    ("A61K 31/00", "A61K 31/00"),
    ("A61K\t31/00\n", "A61K 31/00"),
    ("А" + "61" + "К" + " 31/00", "А" + "61" + "К" + " 31/00"),
    ("A61K 12345/00", "A61K 12345/00"),
    ("A61K 0000/00", "A61K 0/00"),
    ("H04L 9/0012345", "H04L 9/0012345"),
    ("A61K 31/1234567", "A61K 31/1234567"),
    ("C07D 401 /00", "C07D 401/00"),
    ("foo  /  bar", "FOO/BAR"),
    # Python-specific blanks: U+001C..U+001F count as white space.
    ("A61K\x1c31/00", "A61K 31/00"),
]


@pytest.mark.parametrize("bind", [False, True])
def test_canonicalize_golden(spark, bind):
    raws = [c[0] for c in CANON_CASES]
    got = eval_col(spark, raws, lambda c: canonicalize_code(c, bind=bind))
    for (raw, want), g in zip(CANON_CASES, got):
        assert g == want, (raw, g, want)


def test_canonicalize_idempotent_on_canonical(spark):
    outs = [w for _, w in CANON_CASES if w is not None]
    got = eval_col(spark, outs, canonicalize_code)
    assert got == outs


def _items(row):
    return [(x["raw"], x["score"]) for x in row]


def test_parse_ai_line_golden(spark):
    lines = [
        "AI_IPC:G06F 17/30 (41.5%);H04L12/00 (7.25%); ;bad item;X (5%) y;(3%);A (1,5%);",
        "AI_IPC:",
        "no",
        None,
        "zz AI_IPC: A1 (1%);AI_IPC:B2 (2%)",
    ]
    got = eval_col(spark, lines, parse_ai_line)
    assert _items(got[0]) == [
        ("G06F 17/30", 41.5), ("H04L12/00", 7.25), ("bad item", None), ("X (5%) y", None),
        ("(3%)", None), ("A (1,5%)", None),
    ]
    assert [x["canon"] for x in got[0]][:2] == ["G06F 17/30", "H04L 12/00"]
    assert got[1] == [] and got[2] == [] and got[3] == []
    assert _items(got[4]) == [("A1", 1.0), ("AI_IPC:B2", 2.0)]


def test_first_ai_line(spark):
    texts = [
        "HEAD\r\nAI_IPC:A (1%)\nAI_IPC:B (2%)",
        "x AI_IPC:no\nAI_IPC:yes",
        "﻿AI_IPC:bom",
        "A\x0bAI_IPC:vt",
        "nothing",
        "",
    ]
    got = eval_col(spark, texts, first_ai_line)
    assert got == ["AI_IPC:A (1%)", "AI_IPC:yes", "", "AI_IPC:vt", "", ""]


PARTS_CASES = [
    ("C07D 401/10", "C07D 401/00", ("C", "07", "D", 401, 10)),
    ("C07D401/012", "C07D401/00", ("C", "07", "D", 401, 12)),
    ("XYZW12/34", "XYZW12/00", ("X", "YZ", "W", 12, 34)),
    ("C7D 401/00", "C7D 401/00", ("C", "7D", " ", 401, 0)),
    ("/x", "/00", (None,) * 5),
    ("ABCD/10", "ABCD/00", (None,) * 5),
    ("C07D401/", "C07D401/00", (None,) * 5),
    ("a/b/c", None, (None,) * 5),
    ("abc", None, (None,) * 5),
    ("", None, (None,) * 5),
    (None, None, (None,) * 5),
    ("C07D 1_0/10", "C07D 1_0/00", (None,) * 5),
    ("C07D 1.5/10", "C07D 1.5/00", (None,) * 5),
    ("C07D +5/-3", "C07D +5/00", ("C", "07", "D", 5, -3)),
]


def test_main_group_and_parts(spark):
    codes = [c[0] for c in PARTS_CASES]
    mains = eval_col(spark, codes, main_group_of)
    parts = eval_col(spark, codes, code_parts)
    for (code, main, want), m, p in zip(PARTS_CASES, mains, parts):
        assert m == main, (code, m)
        assert (p["section"], p["class2"], p["subclass"], p["main_group"], p["subgroup"]) == want, (code, p)


def test_label_match(spark):
    expert = ["A61K 31/00", "C07D 401/10"]
    rows = [(c, expert) for c in ["A61K 31/00", "A61K 31/44", "C07D 401/00", "C07D 403/10", "abc", None]]
    rows.append(("A61K 31/00", []))
    df = spark.createDataFrame(rows, "code string, expert array<string>")
    got = [r[0] for r in df.select(label_match("code", "expert")).collect()]
    assert got == [1.0, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0]


def test_expert_codes_sorted_distinct(spark):
    df = spark.createDataFrame([(["c07d401/00", None, "", "A61K 31/00", "C07D 401/00", "20060101"],)], "t array<string>")
    assert df.select(expert_codes("t")).first()[0] == ["A61K 31/00", "C07D 401/00"]


def test_scalar_functions_have_no_python_udf(spark):
    df = spark.createDataFrame([("A61K 31/00", "AI_IPC:A (1%)")], "c string, l string")
    q = df.select(canonicalize_code("c"), parse_ai_line("l"), code_parts("c"), main_group_of("c"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None


ai_text = st.lists(st.sampled_from(list("AB1 ;()%.\t\x1c:_I") + ["AI_IPC:"]), max_size=30).map("".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(ai_text, min_size=1, max_size=20))
def test_has_ai_items_matches_parse(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    rows = df.select((F.size(parse_ai_line("l")) > 0).alias("a"), has_ai_items("l").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows), lines


def test_usual_spellings_skip_the_cleaning(spark):
    """The quick form and the cleaned one agree, and a strip is no regular expression."""
    from ipcforge.functions import codes
    from ipcforge.functions.text import WS_CHARS, py_strip

    assert sorted(WS_CHARS) == [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = [f"{a}{s}01{k}{b}{z}31{b}/{b}10{t}{e}" for a in ("", " ", "\n") for s in "Ah" for k in "Kk" for b in ("", " ", "\t ")
             for z in ("", "00", "00000", "000000") for t in ("", " 20060101AFI", "20060101", " (2006.01)", " 20060101\nX/1") for e in ("", "\x1c")]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    slow = codes._canon_of_cleaned(codes._cleaned_code(F.col("x")))
    assert df.where(~slow.eqNullSafe(codes.canonicalize_code("x"))).count() == 0
    assert df.where(F.col("x").rlike(codes._PLAIN)).count() > len(texts) // 4
    assert "regexp" not in str(py_strip(F.col("x")))


def test_match_operators_parse_a_list_once(spark):
    """No test of the exploded list's size is pushed below, which would parse the line a second time."""
    from ipcforge.operators.long import unmatched_anti

    wide = spark.createDataFrame([("1", "202101", "f", "A01K 31/00", "A01K 31/00|B01K 31/10")],
                                 "application_number string, bulletin_code string, source_file string, expert_ipc_canon string, ai_ipc_canon string")
    found = unmatched_anti(wide)
    assert [r["ipc_code"] for r in found.collect()] == ["B01K 31/10"]
    assert "size(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_quick_form_runs_once(spark):
    """The usual spellings are matched by one expression, and text that holds no code by none of the two full ones."""
    from ipcforge.functions import codes

    df = spark.createDataFrame([("a01k 0031/10",), ("\x00a01k 31/10",), ("A01K 0000 31/10",), ("A01K  0000/10",), (None,)], "x string")
    made = df.select("x", canonicalize_code("x").alias("c"))
    assert made._jdf.queryExecution().analyzed().toString().count(codes._PLAIN) == 1
    assert [r["c"] for r in made.collect()] == ["A01K 31/10", "\x00A01K 31/10", "A01K 0000 31/10", "A01K 0/10", None]
    some = spark.createDataFrame([("31101010",), ("A01K 31/10 (2006.01)",), ("A01K 31/10",)], "x string")
    assert [r[0] for r in some.select(F.col("x").rlike(codes._MAY_BE_CODE)).collect()] == [False, False, True]


def test_scores_are_cut_off_without_the_slow_expression(spark):
    """Only an item with a line feed inside is read by the full expression."""
    from ipcforge.functions import codes

    lines = ["AI_IPC:A01K 31/10 \t(12.5%);(5%);X (a) (7%);A (5%) (6%);B\nC (5%);D \n (5%);E (٣%);F (1.%)"]
    assert _items(eval_col(spark, lines, parse_ai_line)[0]) == [
        ("A01K 31/10", 12.5), ("(5%)", None), ("X (a)", 7.0), ("A (5%)", 6.0), ("B\nC (5%)", None), ("D", 5.0), ("E", None), ("F (1.%)", None)]
    plan = spark.createDataFrame([("",)], "l string").select(parse_ai_line("l"))._jdf.queryExecution().analyzed().toString()
    assert codes._AI_SCORE in plan and "contains(" in plan.lower()


def test_first_ai_line_at_every_line_break(spark):
    lines = ["xAI_IPC:a\r\nAI_IPC:b\x85AI_IPC:c", "AI_IPC:", "\nAI_IPC:x\u2028y", "AAI_IPC:a", None, "\x1dAI_IPC:z\x1e"]
    assert eval_col(spark, lines, first_ai_line) == ["AI_IPC:b", "AI_IPC:", "AI_IPC:x", "", None, "AI_IPC:z"]
