"""Classification-code scalar functions as Spark column expressions.

All functions take and return ``Column`` objects and compile to built-in
expressions (regexp, string, array higher-order functions); none of them is a
Python UDF, so they run inside whole-stage code generation where possible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, col_of, collapse_ws, let, py_rstrip, py_strip

# The code layout "<section A-H><2 digits><letter> <group>/<subgroup>"
# with a 1-4 digit main group and a 2-6 digit subgroup.
# (a) matched on the text with every blank removed; leading zeros of the main
#     group are dropped (the look-ahead keeps the 1..4 digit bound).
_CANON_A = r"^([A-H])(\p{Nd}{2})([A-Z])(?=\p{Nd}{1,4}+/)(?>0*(?=\p{Nd}))(\p{Nd}++)/(\p{Nd}{2,6}+)\z"
# (b) matched on the text with blanks kept; zero padding before the main group
#     is absorbed.  Cleaned text has no other blank than U+0020 and no line end.
_CANON_B = r"^([A-H]) *+(\p{Nd}{2}) *+([A-Z]) *+(?>0*(?=\p{Nd}))(\p{Nd}{1,4}+) *+/ *+(\p{Nd}{2,6}+)\z"
# What (a) and (b) both need: text without it stays as cleaned.
_MAY_BE_CODE = r"^[A-H][ A-Z\p{Nd}]++/[ \p{Nd}]++\z"
_CANON_FMT = "$1$2$3 $4/$5"
_IS_CANONICAL = r"^[A-H][0-9]{2}[A-Z] [1-9][0-9]{0,3}/[0-9]{2,6}\z"
# The usual ASCII spellings of a code, whole: any case, blanks around the group and
# the slash, zeros before the group (fewer than 8 digits), a version date behind. (a) or
# (b) gives the same for the cleaned text of what matches here.
# The blanks are named one by one: a class of named characters is a table look-up.
_BLANK = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20]"
_PLAIN = (
    rf"(?s)^{_BLANK}*+([ABCDEFGHabcdefgh])([0-9]{{2}})([A-Za-z]){_BLANK}*+(?=[0-9]{{1,7}}+[^0-9])0*+([1-9][0-9]{{0,3}}+)"
    rf"{_BLANK}*+/{_BLANK}*+([0-9]{{2,6}}+)(?:{_BLANK}++(?:[0-9]{{8}}.*)?)?\z"
)
# Marks text that _PLAIN rewrote: such text starts with a blank or a letter, never with NUL.
_MARK = "\x00"
# Fixed value: a version date (8 digits) ends the code text.
_CUT_AT_8_DIGITS = r"(?s)\p{Nd}{8}.*"

# An AI item is "<code> (<number>%)"; the percent must end it.
_AI_MARKER = "AI_IPC:"
_AI_ITEM = rf"(?U)^([^\n]+?){WS}*\((\d+(?:\.\d+)?)%\)$"
# The same score in a stripped item without line feed: what stands before the last
# bracket is its code, so the code needs no expression.
_AI_SCORE = r"(?s)(?<=.)\((\p{Nd}+(?:\.\p{Nd}+)?)%\)\z"

# Parts of a code for the features.
_INT_TEXT = r"(?U)^[+-]?\d+$"


def _cleaned_code(raw: Column) -> Column:
    """Upper-case, collapse blanks, cut at the first 8-digit run, tidy '/'."""
    s = F.trim(collapse_ws(F.upper(raw)))
    s = F.rtrim(F.regexp_replace(s, _CUT_AT_8_DIGITS, ""))
    return F.replace(F.replace(s, F.lit(" /"), F.lit("/")), F.lit("/ "), F.lit("/"))


def _canon_of_cleaned(s: Column) -> Column:
    # (a) puts a blank into text that has none, so a blank tells that it matched;
    # (b) leaves text that it does not match as it is.
    compact = F.regexp_replace(F.replace(s, F.lit(" "), F.lit("")), _CANON_A, _CANON_FMT)
    spaced = F.regexp_replace(s, _CANON_B, _CANON_FMT)
    code = let(compact, lambda a: F.when(F.contains(a, F.lit(" ")), a).otherwise(spaced))
    return F.when(s.rlike(_MAY_BE_CODE), code).otherwise(F.nullif(s, F.lit("")))


def canonicalize_code(raw: Column | str, bind: bool = True) -> Column:
    """``'c07d  0401 / 00 20060101'`` -> ``'C07D 401/00'``.

    Unparseable text is returned cleaned (upper case, single blanks); blank or
    NULL input gives NULL.  Text in canonical form is known by one match, and the
    usual spellings are rewritten by one expression (``_PLAIN``); for
    all other the cleaned text is bound once (:func:`let`), because Spark's common
    sub-expression elimination reaches neither branches nor array lambdas
    (``bind=False`` repeats the cleaning instead).
    """
    raw = col_of(raw)
    cleaned = _cleaned_code(raw)
    rest = let(cleaned, _canon_of_cleaned) if bind else _canon_of_cleaned(cleaned)
    marked = F.regexp_replace(raw, _PLAIN, _MARK + _CANON_FMT)

    def usual_or_rest(m: Column) -> Column:
        hit = m.startswith(_MARK) & ~raw.startswith(_MARK)
        return F.when(hit, F.upper(F.substr(m, F.lit(2)))).otherwise(rest)

    return F.when(raw.rlike(_IS_CANONICAL), raw).otherwise(let(marked, usual_or_rest) if bind else usual_or_rest(marked))


def parse_ai_line(line: Column | str) -> Column:
    """``'AI_IPC:G06F 17/30 (41.5%);X'`` -> array<struct<raw, canon, score>>.

    The payload starts after the first marker; items are split on ';', blank
    items are skipped; an item without a trailing ``(nn.nn%)`` keeps its whole
    text with a NULL score.
    """
    line = col_of(line)
    at = F.instr(line, _AI_MARKER)
    payload = F.when(at > 0, py_strip(F.substr(line, at + len(_AI_MARKER))))
    items = F.filter(
        F.transform(F.split(payload, ";"), lambda x: py_strip(x)), lambda x: x != ""
    )

    def item_struct(item: Column) -> Column:
        # The score has at least one digit, so a non-empty extract is the match
        # test: one regex run per item, two for those with a line feed inside.
        several = F.contains(item, F.lit("\n"))

        def build(score_text: Column) -> Column:
            hit = score_text != ""
            before = F.substr(item, F.lit(1), F.length(item) - F.length(score_text) - 3)  # the score stands in "(%)"
            code = F.when(several, py_strip(F.regexp_extract(item, _AI_ITEM, 1))).otherwise(py_rstrip(before))
            raw = F.when(hit, code).otherwise(item)
            score = F.when(hit, score_text.try_cast("double"))
            return F.struct(raw.alias("raw"), score.alias("score"))

        return let(F.when(several, F.regexp_extract(item, _AI_ITEM, 2)).otherwise(F.regexp_extract(item, _AI_SCORE, 1)), build)

    parsed = F.transform(items, item_struct)
    out = F.transform(
        parsed,
        lambda x: F.struct(
            x["raw"].alias("raw"),
            canonicalize_code(x["raw"]).alias("canon"),
            x["score"].alias("score"),
        ),
    )
    return F.coalesce(out, F.array().cast(AI_ITEMS_TYPE))


AI_ITEMS_TYPE = "array<struct<raw:string,canon:string,score:double>>"

_NON_BLANK_ITEM_CHAR = rf"[^;{WS[1:]}"


def has_ai_items(line: Column | str) -> Column:
    """``size(parse_ai_line(line)) > 0`` as one cheap regex test.

    An item survives parsing iff it has a character that is neither blank
    nor ';' after the first marker.  Use it for filters: Catalyst pushes
    filters below projections by copying their expressions, and this keeps
    the copy cheap instead of running the full parse twice.
    """
    line = col_of(line)
    at = F.instr(line, _AI_MARKER)
    return F.coalesce((at > 0) & F.substr(line, at + len(_AI_MARKER)).rlike(_NON_BLANK_ITEM_CHAR), F.lit(False))


def first_ai_line(text: Column | str) -> Column:
    """The first line of a file that starts with the marker (or "")."""
    from .text import first_line_starting_with

    return first_line_starting_with(text, _AI_MARKER)


def expert_codes(node_texts: Column | str) -> Column:
    """Node texts -> sorted distinct canonical codes (NULLs and blanks dropped)."""
    texts = F.filter(col_of(node_texts), lambda x: x.isNotNull() & (x != ""))
    canon = F.transform(texts, lambda x: canonicalize_code(x))
    canon = F.filter(canon, lambda x: x.isNotNull())
    return F.coalesce(F.array_sort(F.array_distinct(canon)), F.array().cast("array<string>"))


def _one_slash(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit("/"), F.lit(""))) == 1


def main_group_of(code: Column | str) -> Column:
    """``'C07D 401/10'`` -> ``'C07D 401/00'``; not exactly one '/' -> NULL."""
    c = col_of(code)
    return F.when(
        _one_slash(c),
        F.concat(py_strip(F.substring_index(c, "/", 1)), F.lit("/00")),
    )


def code_parts(code: Column | str) -> Column:
    """struct(section, class2, subclass, main_group, subgroup), all-or-nothing."""
    c = col_of(code)
    main = py_strip(F.substring_index(c, "/", 1))
    sub = py_strip(F.substring_index(c, "/", -1))
    group_text = py_strip(F.substr(main, F.lit(5)))
    ok = (
        _one_slash(c)
        & (F.length(main) >= 4)
        & group_text.rlike(_INT_TEXT)
        & sub.rlike(_INT_TEXT)
    )
    group = group_text.try_cast("int")
    subgroup = sub.try_cast("int")
    ok = ok & group.isNotNull() & subgroup.isNotNull()
    return F.struct(
        F.when(ok, F.substr(main, F.lit(1), F.lit(1))).alias("section"),
        F.when(ok, F.substr(main, F.lit(2), F.lit(2))).alias("class2"),
        F.when(ok, F.substr(main, F.lit(4), F.lit(1))).alias("subclass"),
        F.when(ok, group).alias("main_group"),
        F.when(ok, subgroup).alias("subgroup"),
    )


def expert_main_groups(expert: Column | str) -> Column:
    """Main groups of an expert code list (NULLs dropped); compute once per document."""
    return F.filter(F.transform(col_of(expert), lambda x: main_group_of(x)), lambda x: x.isNotNull())


def label_match(code: Column | str, expert: Column | str, expert_main: Column | str | None = None) -> Column:
    """1.0 exact hit, 0.5 same main group, else 0.0.

    Pass ``expert_main`` (:func:`expert_main_groups` of the same list, computed
    before an explode) so it is not recomputed for every suggested code.
    """
    c, e = col_of(code), col_of(expert)
    main = main_group_of(c)
    expert_main = expert_main_groups(e) if expert_main is None else col_of(expert_main)
    return (
        F.when(F.array_contains(e, c), F.lit(1.0))
        .when(main.isNotNull() & F.array_contains(expert_main, main), F.lit(0.5))
        .otherwise(F.lit(0.0))
    )
