"""PII by anchor expansion.

An Aho-Corasick automaton over the whole text finds anchors: at-signs,
schemes, plus signs, digits and identifier cues.  From each anchor a small
deterministic parser walks to the left and right, finds the boundaries and
validates (octets, Luhn, digit counts, IBAN remainder).  Work per text is one
automaton pass plus the neighbourhoods of its anchors, memory one Arrow batch;
rows are independent, so the operator is a narrow stage that any executor can
repeat.

Kinds: ``email ip card phone`` (the base) and ``address`` (the target of a
``mailto:``/``tel:`` scheme or a URL that carries user information),
``account`` (IBAN, social security or account number behind a cue).

Defined results: a null or empty text has no spans; repeated rows give
repeated results; extra columns pass through :func:`with_pii` untouched; an
empty table gives an empty table.  Positions are code points, end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, worker_state

KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = ("email", "ip", "card", "phone")
MASK = {k: f"[{k.upper()}]" for k in KINDS}

# Cues that introduce an identifier, and schemes.
CUES = ("iban", "account", "acct", "ssn", "social security", "routing", "passport", "konto", "cuenta", "compte")
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,17}(?![A-Za-z0-9])")
_GAP = re.compile(r"(?: ?(?:no|nr|number|num|code)\.?)?[ \t]*[:#=]?[ \t]*", re.I)
_USERINFO = re.compile(r"[^\s/@?#<>\"']+@[A-Za-z0-9.-]+(?::[0-9]+)?")
_TARGET = re.compile(r"[A-Za-z0-9._%+@-]+")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("@", 1))
    found.add_word("+", ("+", 1))
    for digit in "0123456789":
        found.add_word(digit, ("0", 1))
    for scheme in SCHEMES:
        for form in {scheme, scheme.upper(), scheme.capitalize()}:
            found.add_word(form, ("s", len(form)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            found.add_word(form, ("c", len(form)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _emails(text: str, ats: list[int]) -> Iterator[tuple[int, int]]:
    end = 0
    for at in ats:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()


def _digit_runs(at: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of neighbouring digit positions as [start, end)."""
    runs, start, last = [], -2, -2
    for p in at:
        if p != last + 1:
            if start >= 0:
                runs.append((start, last + 1))
            start = p
        last = p
    if start >= 0:
        runs.append((start, last + 1))
    return runs


def _chains(text: str, runs: list[tuple[int, int]], seps: str) -> Iterator[list[tuple[int, int]]]:
    """Runs joined by exactly one separator character."""
    chain: list[tuple[int, int]] = []
    for run in runs:
        if chain and not (run[0] == chain[-1][1] + 1 and text[run[0] - 1] in seps):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


def _ips(text: str, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    for chain in _chains(text, runs, "."):
        for i in range(0, len(chain) - 3, 4):
            if all(_octet(text[a:b]) for a, b in chain[i:i + 4]):
                yield chain[i][0], chain[i + 3][1]


def _cards(text: str, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    for chain in _chains(text, runs, " -"):
        if 16 <= sum(b - a for a, b in chain) <= 19 and _luhn("".join(text[a:b] for a, b in chain)):
            yield chain[0][0], chain[-1][1]


def _phones(text: str, pluses: list[int]) -> Iterator[tuple[int, int]]:
    end = 0
    for at in pluses:
        if at >= end and (m := _PHONE.match(text, at)):
            end = m.end()
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                yield at, end


def _iban(found: str) -> bool:
    code = found.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _accounts(text: str, cues: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    end = 0
    for start, at in cues:
        if start < end or start and text[start - 1].isalnum():
            continue
        at = _GAP.match(text, at).end()
        if m := _IBAN.match(text, at):
            code = m.group()
            while code and not _iban(code):  # words behind the number may look like its groups
                code = code.rpartition(" ")[0]
            if code:
                end = at + len(code)
                yield at, end
                continue
        m = _SSN.match(text, at)
        if m and m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000" or (m := _ACCOUNT.match(text, at)):
            end = m.end()
            yield at, end


def _addresses(text: str, schemes: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    end = 0
    for start, at in schemes:
        if start < end:
            continue
        m = (_TARGET if text[at - 1] == ":" else _USERINFO).match(text, at)
        if m and (text[at - 1] != ":" or "@" in m.group() or sum(c.isdigit() for c in m.group()) >= 6):
            end = m.end()
            yield start, end


def _gaps(spans: Iterable[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Does a span overlap none of these?  Their union is searched, whatever their number."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free(a: int, b: int) -> bool:
        i = bisect_right(ends, a)
        return i == len(ends) or starts[i] >= b

    return free


def find_pii(text: str, automaton: ahocorasick.Automaton | None = None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), by kind as listed, then start."""
    automaton = automaton or worker_state("pii_automaton", _automaton)
    ats, pluses, digits, schemes, cues = [], [], [], [], []
    for last, (what, length) in automaton.iter(text) if text else ():
        if what == "0":
            digits.append(last)
        elif what == "@":
            ats.append(last)
        elif what == "+":
            pluses.append(last)
        elif what == "s":
            schemes.append((last - length + 1, last + 1))
        else:
            cues.append((last - length + 1, last + 1))
    runs = _digit_runs(digits)
    out = [("email", *s) for s in _emails(text, ats)]
    out += [("ip", *s) for s in _ips(text, runs)]
    out += [("card", *s) for s in _cards(text, runs)]
    out += [("phone", *s) for s in _phones(text, pluses)]
    free = _gaps(s[1:] for s in out)
    out += [("address", *s) for s in _addresses(text, schemes) if free(*s)]
    out += [("account", *s) for s in _accounts(text, cues) if free(*s)]
    return out


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets (overlaps merge into the first)."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], MASK[kind]]
        at = max(at, end)
    return "".join([*parts, text[at:]])


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def with_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "pii_spans", redacted_col: str | None = None) -> DataFrame:
    """``docs`` with all its columns, the spans and, if asked for, the redacted text.

    Columns of these names are replaced.
    """
    keep = [c for c in docs.columns if c not in (spans_col, redacted_col) or c == text_col]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    added = [spans_col] + ([redacted_col] if redacted_col and redacted_col != text_col else [])
    probe = docs.select("*", F.lit(None).cast(SPANS).alias(spans_col),
                        *[F.lit("").alias(c) for c in added[1:]])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_state("pii_automaton", _automaton)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            whole = texts(batch.column(at))
            spans = [find_pii(t, automaton) for t in whole]
            cols, names = list(batch.columns), list(batch.schema.names)
            if redacted_col:
                clean = pa.array([redact(t, s) if s else t for t, s in zip(whole, spans)], pa.string())
            if redacted_col == text_col:
                cols[at] = clean
            cols.append(pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], kind))
            names.append(spans_col)
            if len(added) > 1:
                cols.append(clean)
                names.append(redacted_col)
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(run, probe.schema)


def span_digest(spans: list[tuple[str, int, int]]) -> str:
    """Comma-joined kind:start:end."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, derived from the spans with SQL functions."""
    found = with_pii(docs.select("doc_id", "text")).select("doc_id", "pii_spans")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda *kinds: F.filter("pii_spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(of(*BASE)), 256).alias("base_sha256"), joined(F.col("pii_spans")).alias("spans"),
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[len(BASE):]])
