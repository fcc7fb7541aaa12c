"""Secret scan with DataFrame functions only.

Base kinds are found by their patterns.  The method adds the kind ``markov``:
token-like runs whose characters are explained better by a Markov chain of
random strings than by a chain of ordinary identifiers (log-likelihood ratio
above a threshold).  Both chains are character bigram models trained from
labelled samples: values of base matches against all other runs of a bounded
sample of documents.  The finished model is a 128 x 128 table of log ratios
(bounded by the alphabet), a literal in the plan; the scan itself is one
narrow stage without a shuffle.

Match positions come from ``split`` and ``regexp_extract_all`` with one
pattern: gaps and matches alternate, so their running code-point lengths are
the positions.

Defined results: a null or empty text has no spans; repeated rows give
repeated results; an empty table gives an empty table (and an uninformed
model, all ratios 0); other columns pass through :func:`with_secrets`
untouched, a column named like the result is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base kinds in order, pattern, and which group's length counts.
_VALUE = r"[A-Za-z0-9+/_.=-]+"
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(""" + _VALUE + ")"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "markov")
BASE = KINDS[:3]
MIN_ASSIGN = 12

SAMPLE_DOCS = 4096  # expected documents of the training sample: its bound
THRESHOLD = 12.0  # nats by which the random chain must explain a run better

_SPANS = "array<struct<start:bigint,no:int,end:bigint,value:string>>"


def _found(text: Column, pattern: str, group: int, no: int, least: int) -> Column:
    """Spans of all matches whose ``group`` has ``least`` code points or more."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(start.cast("long").alias("start"), F.lit(no).alias("no"), end.cast("long").alias("end"),
                        part["value"].alias("value"))
        return F.struct(end.cast("long").alias("at"),
                        F.when(F.length(part["value"]) >= least, F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(parts, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("spans")),
                        step, lambda acc: acc["spans"])
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast(_SPANS))


def _base(text: Column) -> Column:
    return F.concat(_found(text, ASSIGN, 1, 0, MIN_ASSIGN), _found(text, ACCESS, 0, 1, 18), _found(text, HEX, 0, 2, 16))


def _codes(run: Column) -> Column:
    """ASCII codes of a run's characters, 0 before the first."""
    chars = F.filter(F.split(run, ""), lambda c: c != "")
    return F.concat(F.array(F.lit(0)), F.transform(chars, lambda c: F.ascii(c)))


def labelled_samples(docs: DataFrame, text_col: str = "text", key_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(random boolean, run) from about ``sample_docs`` different documents chosen by a hash of key and text.

    Values of base matches are random strings; every other run of 6 or more
    characters is an ordinary identifier.
    """
    row = F.xxhash64(key_col, text_col)  # null keys differ by their texts
    total = docs.agg(F.approx_count_distinct(row)).first()[0]
    cut = int(min(1.0, sample_docs / max(total, 1)) * (1 << 30))
    chosen = docs.where(F.pmod(row, F.lit(1 << 30)) < cut)
    some = chosen.select(row.alias("row"), F.coalesce(text_col, F.lit("")).alias("t")).dropDuplicates(["row"])
    some = some.select("t", F.transform(_base(F.col("t")), lambda s: s["value"]).alias("hits"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), ACCESS, " "), HEX, " ")
    other = F.regexp_extract_all(rest, F.lit(RUN.replace("{20,}", "{6,}")), F.lit(0))
    runs = lambda a, label: F.transform(a, lambda v: F.struct(F.lit(label).alias("random"), v.alias("run")))
    return some.select(F.inline(F.concat(runs(F.col("hits"), True), runs(other, False))))


def train(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log ratios of the two chains as a flat 128 x 128 table (previous code, next code)."""
    codes = samples.select("random", _codes(F.col("run")).alias("c")).where(F.size("c") > 1)
    pairs = codes.select("random", F.explode(F.arrays_zip(
        F.slice("c", 1, F.size("c") - 1).alias("a"), F.slice("c", 2, F.size("c") - 1).alias("b"))).alias("p"))
    # at most 2 x 128 x 128 rows: the alphabet bounds what reaches the driver
    counts = pairs.where((F.col("p.a") < 128) & (F.col("p.b") < 128)).groupBy("random", "p.a", "p.b").count().collect()
    used = len({r["b"] for r in counts}) or 1
    n, row = {}, {}
    for r in counts:
        n[r["random"], r["a"], r["b"]] = r["count"]
        row[r["random"], r["a"]] = row.get((r["random"], r["a"]), 0) + r["count"]
    log_p = lambda label, a, b: math.log((n.get((label, a, b), 0) + smooth) / (row.get((label, a), 0) + smooth * used))
    return [round(log_p(True, a, b) - log_p(False, a, b), 6) for a in range(128) for b in range(128)]


def llr(run: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a run under the two chains."""
    ratios = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")

    def step(acc: Column, c: Column) -> Column:
        code = F.least(F.ascii(c), F.lit(127))
        return F.struct(code.alias("a"), (acc["s"] + F.element_at(ratios, acc["a"] * 128 + code + 1)).alias("s"))

    chars = F.filter(F.split(run, ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit(0).alias("a"), F.lit(0.0).alias("s")), step, lambda acc: acc["s"])


def with_secrets(docs: DataFrame, model: list[float], text_col: str = "text", out: str = "secret_spans", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus ``out``: array of (start, no, end) by start, then kind as listed in ``KINDS``."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c != out]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(*keep, _base(text).alias("__base"), _found(text, RUN, 0, 3, 20).alias("__runs"))
    clear = lambda r: ~F.exists("__base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
    added = F.filter("__runs", lambda r: clear(r) & (llr(r["value"], model) > threshold))
    spans = F.sort_array(F.transform(F.concat("__base", added), lambda s: F.struct(
        s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"))))
    return base.select(*keep, spans.alias(out))


def secret_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns; trains on a sample of ``docs`` first."""
    docs = docs.select("doc_id", "text")
    model = train(labelled_samples(docs))
    found = with_secrets(docs, model).select("doc_id", "secret_spans")
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.element_at(names, s["no"] + 1), s["start"], s["end"])), ",")
    of = lambda *no: F.filter("secret_spans", lambda s: s["no"].isin(*no))
    return found.select(
        "doc_id", *[F.size(of(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(joined(of(0, 1, 2)), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"))
