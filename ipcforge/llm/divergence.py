"""Source divergence audit: how far the word use of a source lies from the other sources of its language.

Terms are runs of ASCII letters and of any characters beyond ASCII, A-Z read
as a-z.  Tasks count the terms of a slice of texts with array operations only,
in buckets by byte length: a term of up to 8 bytes is one 64-bit word, one of
up to 16 bytes two, both sorted by 16-bit radix passes; longer terms lie in
byte-sorted buckets by the power of two that holds them.  The rows of a slice
are ordered by (language, source) before, so that the stable sort leaves the
groups and rows of a term in order and one pass over the runs gives
occurrences and texts per (language, source, term).

Spark adds up the counts (partial sums before the shuffle) and keeps the terms
of enough texts.  All sums over terms are exact integers.  Pairs of sources are
not made per term: the terms of a language are dealt over parts of bounded size by
their hash, and a part adds up its terms for all pairs of sources in a matrix.

Defined results: a null text, language or source is read as empty; the empty
language and the empty source are groups like all others; each row is a text
of its own, repeated keys included; a text without terms still makes its
group occur; equal values are ordered by the UTF-8 bytes of the item; a
language without kept terms has value 0 for every pair and no terms; an empty
table gives an empty table; other columns are not read, whatever their names.
A task holds one slice of ``SLICE`` bytes or the longest text, about 60 times
its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices, text_buffer

MIN_TEXTS = 3  # a kept term is in at least this many texts of its language
TOP_TERMS = 200
SCALE = 1_000_000_000
SLICE = 1 << 22
PART_ROWS = 200_000  # rows of counts per part of a language
SALTS = 64  # parts of a group in the join with its totals
_BLOCK = 1 << 20  # cells of a matrix of terms by sources

_TERM = np.zeros(256, bool)
_TERM[0x80:] = True
_TERM[ord("a"): ord("z") + 1] = True
_TERM[ord("A"): ord("Z") + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32


# ---------------------------------------------------------------- counting


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte starts, byte lengths, text numbers) of all terms of lower-cased texts, in order."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = _TERM[data]
    edge = inside[1:] != inside[:-1]
    begins, ends = edge & inside[1:], edge & inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    cut = cut[inside[cut] & inside[cut + 1]]  # two texts meet within a run
    begins[cut] = True
    ends[cut] = True
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) - starts, np.searchsorted(offsets, starts, "right") - 1


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The bytes of spans of at most ``width`` bytes, one zero-padded row each."""
    out = np.zeros((len(starts), width), np.uint8)
    at = np.arange(width)
    for lo in range(0, len(starts), 1 << 17):  # bounds the index arrays
        s, m = starts[lo:lo + (1 << 17)], lengths[lo:lo + (1 << 17)]
        here = at[None, :] < m[:, None]
        out[lo:lo + len(s)][here] = data[(s[:, None] + at)[here]]
    return out


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by 64-bit keys, most significant first: passes over 16-bit digits, last digit first.

    numpy sorts 16-bit integers stably by counting, not by comparing.
    """
    order = None
    for key in reversed(keys):
        for shift in (0, 16, 32, 48):
            digit = (key >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and not (digit != digit[0]).any():
                continue
            if order is None:
                order = np.argsort(digit, kind="stable")
            else:
                order = order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(keys[0])) if order is None else order


def _packed_runs(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, marks of rows that begin another term) for terms of one or two words."""
    order = radix_order(words)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for w in words:
        there = w[order]
        new[1:] |= there[1:] != there[:-1]
    return order, new


def _byte_runs(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for a bucket of fixed-width byte strings."""
    order = np.argsort(terms, kind="stable")
    there = terms[order]
    return order, np.concatenate([np.ones(min(1, len(there)), bool), there[1:] != there[:-1]])


def count_terms(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, length, group, occurrences, texts) per term and group.

    ``data`` is lower-cased, ``group`` ascends with the texts.  The byte span is
    that of an occurrence.
    """
    starts, lengths, text = term_spans(data, offsets)
    found = []
    low = 0
    high = 8
    while len(starts) and low < int(lengths.max()):
        here = np.flatnonzero((lengths > low) & (lengths <= high))
        low, width, high = high, high, high * 2
        if not len(here):
            continue
        s, n, t = starts[here], lengths[here], text[here]
        if width <= 16:
            words = gather(data, s, n, width).view(">u8").astype(np.uint64)
            order, new = _packed_runs([words[:, i] for i in range(words.shape[1])])
        elif width <= 1024:
            order, new = _byte_runs(gather(data, s, n, width).view(f"S{width}")[:, 0])
        else:  # no padding to a width for very long ones
            terms = np.array([data[a:a + m].tobytes() for a, m in zip(s, n)], object)
            order, new = _byte_runs(terms)
        t = t[order]
        g = group[t]
        new = new.astype(bool)
        new[1:] |= g[1:] != g[:-1]
        run = np.flatnonzero(new)
        other_text = new.copy()
        other_text[1:] |= t[1:] != t[:-1]
        first = order[run]
        found.append((s[first], n[first], g[run], np.diff(np.append(run, len(t))), np.add.reduceat(other_text.astype(np.int64), run)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Byte spans as an Arrow string array."""
    ends = np.cumsum(lengths, dtype=np.int64)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[at])).cast(pa.string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "texts"]
    for batch in batches:
        group_of, keys = {}, []
        ids = np.zeros(batch.num_rows, np.int64)
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            ids[i] = group_of.setdefault(key, len(keys))
            if ids[i] == len(keys):
                keys.append(key)
        # each group that occurs, terms or not
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                          pa.nulls(len(keys), pa.string()), pa.array([0] * len(keys), pa.int64()),
                                          pa.array([0] * len(keys), pa.int64())], names)
        order = np.argsort(ids, kind="stable")
        data, offsets = text_buffer(batch.column(2).take(pa.array(order)))
        ids = ids[order]
        langs, sources = (pa.array([k[j] for k in keys], pa.string()) for j in (0, 1))
        for lo, hi in slices(offsets, SLICE):
            part = _LOWER[data[offsets[lo]:offsets[hi]]]
            start, length, group, n, texts = count_terms(part, offsets[lo:hi + 1] - offsets[lo], ids[lo:hi])
            for a in range(0, len(start), 1 << 16):
                b = slice(a, a + (1 << 16))
                g = pa.array(group[b])
                yield pa.RecordBatch.from_arrays([langs.take(g), sources.take(g), _strings(part, start[b], length[b]),
                                                  pa.array(n[b].astype(np.int64)), pa.array(texts[b].astype(np.int64))], names)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, texts): occurrences and texts per term and group; a null term marks each group that occurs."""
    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    counts = read.mapInArrow(_count, "lang string, source string, term string, n long, texts long")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))


# ---------------------------------------------------------------- shares and divergence


def shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + terms)) without a product that leaves 64 bits."""
    d = np.int64(total + terms)
    whole, rest = np.divmod(np.asarray(count, np.int64) + 1, d)
    out = whole
    for _ in range(3):  # three steps of a thousand
        digit, rest = np.divmod(rest * 1000, d)
        out = out * 1000 + digit
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); a share is at most SCALE + 1, so the square stays within 64 bits."""
    return (p - q) * (p - q) // q


def _add_pairs(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over the terms of one part of a language, for all ordered pairs of its sources."""
    source = np.array(groups.column("source").to_pylist(), object)
    order = np.argsort(source)
    total = groups.column("total").to_numpy()[order]
    names = source[order]
    m = len(names)
    v = int(groups.column("terms")[0].as_py())
    sums = np.zeros((m, m), np.int64)
    if counts.num_rows:
        coded = counts.column("term").combine_chunks().dictionary_encode()
        term = np.asarray(coded.indices)
        place = np.searchsorted(names, np.array(counts.column("source").to_pylist(), object))
        n = counts.column("n").to_numpy()
        by_term = np.argsort(term, kind="stable")
        term, place, n = term[by_term], place[by_term], n[by_term]
        step = max(1, _BLOCK // m)
        n_terms = len(coded.dictionary)
        for lo in range(0, n_terms, step):
            a, b = np.searchsorted(term, [lo, min(n_terms, lo + step)])
            block = np.zeros((min(step, n_terms - lo), m), np.int64)
            block[term[a:b] - lo, place[a:b]] = n[a:b]
            p = np.stack([shares(block[:, i], int(total[i]), v) for i in range(m)])
            for i in range(m):
                sums[i] += divergence(p[i][None, :], p).sum(axis=1)
    one, two = np.nonzero(~np.eye(m, dtype=bool))
    lang = groups.column("lang")[0].as_py()
    pick = pa.array(names.tolist(), pa.string())
    return pa.table({"lang": pa.array([lang] * len(one), pa.string()), "source": pick.take(pa.array(one)),
                     "item": pick.take(pa.array(two)), "value": pa.array(sums[one, two])})


def divergence_audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                     min_texts: int = MIN_TEXTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the language, and the terms a source uses more than its language."""
    counts, _ = materialize(term_counts(docs, text, lang, source), "term_counts")
    per_term = Window.partitionBy("lang", "term")
    first = F.row_number().over(per_term.orderBy("source")) == 1
    kept = (counts.where(F.col("term").isNotNull())
            .select("lang", "source", "term", "n", F.sum("texts").over(per_term).alias("texts"),
                    F.sum("n").over(per_term).alias("lang_n"), first.cast("long").alias("lead"))
            .where(F.col("texts") >= min_texts).drop("texts"))
    kept, _ = materialize(kept, "kept_terms")
    # one row per group and per language
    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("lead").alias("terms"), F.count(F.lit(1)).alias("rows"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.where(F.col("term").isNull()).select("lang", "source").join(of_group, ["lang", "source"], "left")
              .join(of_lang, "lang", "left").na.fill(0, ["total", "lang_total", "terms", "rows"]))
    groups, _ = materialize(groups, "term_groups")

    parts = F.ceil((F.col("rows") + 1) / F.lit(PART_ROWS)).cast("int")
    dealt_groups = groups.select("lang", "source", "total", "terms", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    # a group may hold a third of all rows: its one row is copied per salt
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    facts = kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(salted, ["lang", "source", "salt"])
    dealt = facts.select("lang", "source", "term", "n", F.pmod(F.xxhash64("term"), parts).cast("int").alias("part"))
    pairs = (dealt.groupBy("lang", "part").cogroup(dealt_groups.groupBy("lang", "part"))
             .applyInArrow(_add_pairs, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair")))

    def share(n: str, total: str):  # decimal arithmetic: the product may leave 64 bits
        wide = (F.col(n).cast("decimal(20,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
        return 1 + F.call_function("div", wide, F.col(total).cast("decimal(20,0)") + F.col("terms").cast("decimal(20,0)"))

    p, q = F.col("p"), F.col("q")
    terms = (facts.select("lang", "source", F.col("term").alias("item"), share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q"))
             .where(p > q).select("lang", "source", "item", F.call_function("div", (p - q) * (p - q), q).alias("value"))
             .withColumn("part", F.lit("term")))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    # the filter on the place lets every partition cut its groups before the shuffle
    top = terms.withColumn("rank", place).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", place).select(*columns).unionByName(top.select(*columns))
