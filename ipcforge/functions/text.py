"""Text helpers expressed as Spark column expressions (no UDFs).

Python's ``str.strip``/``str.isspace`` treat more characters as blank than
Spark's ``trim`` (which only removes U+0020), and ``str.splitlines`` breaks on
more characters than ``\\n``.  These helpers reproduce the Python behaviour
with Java regular expressions so everything stays inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python treats as white space, which are Java's
# Unicode \s and the four separators U+001C..U+001F; named one by one, because
# a class of named characters is a table look-up and ``(?U)\s`` is not.  Those
# above U+00FF stand behind one range test.
_WIDE_WS = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
WS = rf"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0{_WIDE_WS}]"
WS_CHARS = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                                    0x202F, 0x205F, 0x3000))
# Line boundaries of Python's str.splitlines:
# \n \r \x0b \x0c \x1c \x1d \x1e \x85     (and \r\n as one break).
# Named one by one for the same reason.
LINE_BREAK_CHARS = "\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029"

# Runs of blanks that are not one U+0020 already.
_OTHER_WS = WS.replace(r"\x20", "")
_WS_RUN_RE = rf"{_OTHER_WS}{WS}*+|\x20{WS}++"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times inside ``body``.

    Spark has no SQL ``LET``; a one-element ``transform`` evaluates the value
    a single time per row, which matters inside array lambdas where common
    sub-expression elimination does not apply.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def py_strip(c: Column | str) -> Column:
    """``str.strip()`` semantics (Unicode blanks plus U+001C..U+001F)."""
    return F.trim(col_of(c), F.lit(WS_CHARS))


def py_rstrip(c: Column | str) -> Column:
    return F.rtrim(col_of(c), F.lit(WS_CHARS))


def collapse_ws(c: Column | str) -> Column:
    """``re.sub(r"\\s+", " ", s)`` with Python's notion of ``\\s``."""
    return F.regexp_replace(col_of(c), _WS_RUN_RE, " ")


def decode_utf8_lenient(content: Column | str) -> Column:
    """Bytes to text, dropping undecodable bytes (``errors="ignore"``)."""
    return F.replace(
        F.make_valid_utf8(col_of(content).cast("string")), F.lit("�"), F.lit("")
    )


def first_line_starting_with(text: Column | str, prefix: str) -> Column:
    """First line (``str.splitlines`` boundaries) that starts with ``prefix``.

    One regex scan over the text; no per-line array is materialised, so very
    large files stay cheap.  Returns ``""`` when there is no such line.
    """
    pattern = (
        rf"(?:^|(?<=[{LINE_BREAK_CHARS}])){_quote(prefix)}[^{LINE_BREAK_CHARS}]*"
    )
    return F.regexp_extract(col_of(text), pattern, 0)


def _quote(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in s)
