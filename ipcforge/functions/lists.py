"""List codecs for the wide table.

Our wide table keeps lists as native ``ArrayType`` columns.  The interchange
form used by existing datasets flattens each list to a ``'|'``-joined string
(and older files may hold a Python-literal ``"['a', 'b']"``); these helpers
convert between the two without leaving the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

from .text import col_of, py_strip

# Fixed value: the list separator of the interchange form.
SEP = "|"
_SEP_RE = r"\|"


def encode_code_list(arr: Column | str) -> Column:
    """array<string> -> 'a|b'; a NULL element becomes an empty token."""
    return F.coalesce(F.array_join(col_of(arr), SEP, ""), F.lit(""))


def encode_score_list(arr: Column | str) -> Column:
    """array<double> -> '41.5|7.25|'; NULL scores become empty tokens."""
    as_text = F.transform(col_of(arr), lambda x: x.cast("string"))
    return F.coalesce(F.array_join(as_text, SEP, ""), F.lit(""))


def _is_bracketed(s: Column) -> Column:
    return s.startswith("[") & s.endswith("]")


def decode_code_list(c: Column | str, dtype: DataType = StringType(), positional: bool = False) -> Column:
    """P5: array | 'a|b' | "['a','b']" -> array<string>.

    Pipe form drops empty tokens; a malformed bracket form or any other value
    gives an empty array.  Native arrays pass through unchanged.  With
    ``positional`` an empty token stays, as NULL, so that the list keeps its
    alignment with the score list.
    """
    c = col_of(c)
    empty = F.array().cast("array<string>")
    if isinstance(dtype, ArrayType):
        return F.coalesce(c.cast("array<string>"), empty)
    s = py_strip(c)
    bracket = F.from_json(s, "array<string>", {"mode": "PERMISSIVE"})
    if positional:
        pipe = F.when(s == "", empty).otherwise(F.transform(F.split(s, _SEP_RE), lambda x: F.nullif(x, F.lit(""))))
    else:
        pipe = F.filter(F.split(s, _SEP_RE), lambda x: x != "")
    return F.coalesce(F.when(_is_bracketed(s), bracket).otherwise(pipe), empty)


def decode_score_list(c: Column | str, dtype: DataType = StringType()) -> Column:
    """Array | '1.0|2.5|' | '[1.0, 2.5]' -> array<double>.

    Pipe form keeps positions: an empty or unparseable token becomes NULL.
    A bracket form with any bad element gives an empty array.
    """
    c = col_of(c)
    empty = F.array().cast("array<double>")
    if isinstance(dtype, ArrayType):
        return F.coalesce(c.cast("array<double>"), empty)
    s = py_strip(c)
    bracket = F.from_json(s, "array<double>", {"mode": "PERMISSIVE"})
    pipe = F.transform(F.split(s, _SEP_RE), lambda x: py_strip(x).try_cast("double"))
    return F.coalesce(
        F.when(s == "", empty).when(_is_bracketed(s), bracket).otherwise(pipe), empty
    )


def zip_scores(codes: Column | str, scores: Column | str) -> Column:
    """I-th code with i-th score; missing scores are NULL, extra ones ignored.

    Pairs without a code go after the zip, so a score never moves to another code.
    """
    sc = col_of(scores)
    pairs = F.transform(
        col_of(codes),
        lambda code, i: F.struct(code.alias("code"), F.get(sc, i).alias("score")),
    )
    return F.filter(pairs, lambda p: p["code"].isNotNull() & (p["code"] != ""))
