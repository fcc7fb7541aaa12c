"""Quality classifier from weak labels.

1. Overlapping heuristic labellers vote low, high or abstain on every
   document (share of symbols, capitals, repeated words, ...).
2. Expectation-maximisation over the counts of vote patterns (Spark counts them over
   all documents; there are at most 3 to the number of labellers) estimates
   each labeller's accuracy (hits and false alarms) and the share of low
   documents, without labels. The result is a posterior per pattern.
3. The posteriors of a bounded sample (``SAMPLE_DOCS`` expected of the different
   documents, chosen by a hash of key and text; a repeated row counts once) train a
   hashed linear scorer in numpy, which scores all documents and decides.

Defined results: a null or empty text gets no votes and a score from the
bias alone, and is kept; repeated rows get equal scores; an empty table gives
an empty table; other columns pass through, columns named like the results
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, remove_path, slices, text_buffer
from .words import word_spans

# Labellers: statistic, low at or above, high at or below, fewest words to vote.
LABELLERS = (
    ("symbols", 0.12, 0.06, 5),  # ASCII punctuation among bytes
    ("capitals", 0.30, 0.10, 4),  # among ASCII letters
    ("shouts", 0.25, 0.05, 3),  # words ending in two or more exclamation marks
    ("repeated", 0.70, 0.45, 40),  # 1 - distinct / words
    ("neighbours", 0.20, 0.05, 10),  # words equal to the one before
    ("commonest", 0.30, 0.15, 20),  # share of the most frequent word
    ("bare_symbols", 0.15, 0.05, 5),  # words of punctuation only
    ("no_function_words", 0.93, 0.85, 15),  # 1 - share of short plain words
    ("dirty_words", 0.50, 0.30, 5),  # words with two or more symbols
)
SAMPLE_DOCS = 4096
DIMENSIONS = 2048

_byte = np.arange(256)
_UPPER = (_byte >= 65) & (_byte <= 90)
_LETTER = _UPPER | (_byte >= 97) & (_byte <= 122) | (_byte >= 128)
_SYMBOL = (_byte > 32) & (_byte < 127) & ~_LETTER & ~((_byte >= 48) & (_byte <= 57))


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text the labellers' statistics (n x labellers) and word count; per word its text and feature ids (words x 3)."""
    n = len(offsets) - 1
    h, starts, ends, at = word_spans(data, offsets)
    words = np.diff(at)
    doc = np.repeat(np.arange(n), words)
    upper, letter, symbol = (np.concatenate([[0], np.cumsum(lut[data], dtype=np.int64)]) for lut in (_UPPER, _LETTER, _SYMBOL))
    size = np.maximum(np.diff(offsets), 1)
    per = lambda mask: np.bincount(doc, mask, n) / np.maximum(words, 1)
    length, symbols = ends - starts, symbol[ends] - symbol[starts]
    letters, uppers = letter[ends] - letter[starts], upper[ends] - upper[starts]
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    before = data[np.maximum(ends - 2, 0)] if len(ends) else last
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((h, doc))
    hs, ds = h[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])])) if len(h) else np.zeros(0, np.int64)
    most = np.zeros(n)
    np.maximum.at(most, ds[first], np.diff(np.append(first, len(h))))
    distinct = np.bincount(ds[first], minlength=n)
    plain_letters = np.maximum(letter[offsets[1:]] - letter[offsets[:-1]], 1)
    stats = np.stack([
        (symbol[offsets[1:]] - symbol[offsets[:-1]]) / size,
        (upper[offsets[1:]] - upper[offsets[:-1]]) / plain_letters,
        per((last == 33) & (before == 33) & (length > 1)),
        1 - distinct / np.maximum(words, 1),
        per(same),
        most / np.maximum(words, 1),
        per(symbols == length),
        1 - per((length <= 4) & (letters >= length - 1) & (letters > 0)),
        per((symbols >= 2) & (symbols < length)),
    ], axis=1)
    shape = (np.minimum(length, 15) + 16 * np.minimum(uppers, 3) + 64 * np.minimum(symbols, 3) + 256 * same
             + 512 * np.where(_SYMBOL[last], last, 0).astype(np.int64)).astype(np.uint64)
    ending = last.astype(np.uint64) * np.uint64(256) + before.astype(np.uint64)
    ids = np.stack([mix64(shape + np.uint64(1 << 32)), mix64(ending + np.uint64(2 << 32)), h], axis=1) % np.uint64(DIMENSIONS)
    return stats, words, doc, ids.astype(np.int64)


def votes(stats: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Vote per text and labeller: 1 low, 2 high, 0 abstains."""
    out = np.zeros(stats.shape, np.int64)
    for j, (_, low, high, least) in enumerate(LABELLERS):
        out[:, j] = np.where(words < least, 0, np.where(stats[:, j] >= low, 1, np.where(stats[:, j] <= high, 2, 0)))
    return out


_PLACES = 3 ** np.arange(len(LABELLERS))


def _level_ids(stats: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashed ids of the texts' statistics in sixteen levels (no words: none, -1)."""
    level = np.minimum(stats * 16, 15).astype(np.uint64) + np.arange(stats.shape[1], dtype=np.uint64) * np.uint64(16)
    ids = (mix64(level + np.uint64(3 << 32)) % np.uint64(DIMENSIONS)).astype(np.int64)
    ids[words == 0] = -1
    return ids


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Posterior of low per pattern, every labeller's hit and false-alarm rate, share of low documents.

    There are many kinds of low documents and a labeller knows one of them, so
    a low vote is evidence, while a high vote only says that this labeller
    saw nothing: rates of a low vote given the class, over the documents on
    which the labeller does not abstain.  Beta priors worth half of all votes
    say that false alarms are rare (0.2 %) and, worth a few votes, that hits are
    not; they keep the classes' meaning and every estimate defined.
    """
    v = (patterns[:, None] // _PLACES) % 3
    low = (v == 1).any(1).astype(float)
    voted, fired = (v > 0) * counts[:, None], (v == 1) * counts[:, None]
    share, hit, alarm = 0.05, np.full(v.shape[1], 0.3), np.full(v.shape[1], 0.002)
    for step in range(rounds):
        share = float(np.clip((low @ counts + 1) / (counts.sum() + 20), 1e-4, 0.5))
        hit = (low @ fired + 3) / (low @ voted + 10)
        trust = 0.5 * voted.sum(0) + 100
        alarm = ((1 - low) @ fired + 0.002 * trust) / ((1 - low) @ voted + trust)
        odds = np.log(share / (1 - share)) + (v == 1) @ np.log(hit / alarm) + (v == 2) @ np.log((1 - hit) / (1 - alarm))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        done, low = np.abs(new - low).max(initial=0) < 1e-9, new
        if done:
            break
    return low, hit, alarm, share


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels (adaptive full-batch steps)."""
    w, b = np.zeros(x.shape[1]), 0.0
    x = np.asarray(x, np.float32)
    first, second = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1 if len(x) else 1):
        error = (1 / (1 + np.exp(-(x @ w.astype(np.float32) + b))) - y).astype(np.float32)
        g = np.append(x.T @ error / len(x) + decay * w, error.mean())
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        step = rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


@dataclass
class Model:
    patterns: np.ndarray  # seen vote patterns, ascending
    posterior: np.ndarray  # of low, per pattern
    hit: np.ndarray
    alarm: np.ndarray
    share: float
    weights: np.ndarray
    bias: float


_SCALE = 4.0  # of word features: shares of words, summed over three families


def train(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    row = F.xxhash64(F.col(f"`{key_col}`"), F.col(f"`{text_col}`"))  # null keys differ by their texts
    total = docs.agg(F.approx_count_distinct(row)).first()[0]
    cut = int(min(1.0, sample_docs / max(total, 1)) * (1 << 30))
    chosen = F.when(F.pmod(row, F.lit(1 << 30)) < cut, row)
    texts = docs.select(chosen.alias("chosen"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had = set()  # chosen rows of this task: no more than the sample has
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            first = np.zeros(batch.num_rows, bool)
            for i in np.flatnonzero(batch.column(0).is_valid().to_numpy(zero_copy_only=False)):
                h = batch.column(0)[i].as_py()
                first[i] = h not in had
                had.add(h)
            for lo, hi in slices(offsets, rows=512):
                stats, words, doc, ids = statistics(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                pattern = votes(stats, words) @ _PLACES
                rows = np.flatnonzero(first[lo:hi])
                cells = []
                for i in rows:
                    x = np.bincount(ids[doc == i].ravel(), minlength=DIMENSIONS) * (_SCALE / max(words[i], 1))
                    own = _level_ids(stats[i:i + 1], words[i:i + 1])[0]
                    np.add.at(x, own[own >= 0], 1.0)
                    at = np.flatnonzero(x).astype(np.uint16)
                    cells.append(x[at].astype(np.float32).tobytes() + at.tobytes())
                kept, n = np.unique(pattern, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([kept, pattern[rows]])), pa.array(np.concatenate([n, np.zeros(len(rows), np.int64)])),
                     pa.array([None] * len(kept) + cells, pa.binary()),
                     pa.concat_arrays([pa.nulls(len(kept), pa.int64()), batch.column(0).slice(lo, hi - lo).take(pa.array(rows))])],
                    ["pattern", "n", "x", "row"])

    # counts per pattern of every slice, and the sample's features: the values that are not 0, then their places
    found, path = materialize(texts.mapInArrow(run, "pattern long, n long, x binary, row long"), "votes")
    seen = found.where("n > 0").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toArrow()
    patterns, counts = (seen.column(c).to_numpy() for c in ("pattern", "n"))
    posterior, hit, alarm, share = em(patterns, counts)
    sample = found.where("x is not null").dropDuplicates(["row"]).select("row", "pattern", "x").toArrow().sort_by("row")
    x = np.zeros((sample.num_rows, DIMENSIONS), np.float32)
    for row, cell in zip(x, sample.column("x")):
        n = cell.as_buffer().size // 6
        row[np.frombuffer(cell.as_buffer(), np.uint16, n, 4 * n)] = np.frombuffer(cell.as_buffer(), np.float32, n)
    y = posterior[np.searchsorted(patterns, sample.column("pattern").to_numpy())]
    remove_path(docs.sparkSession, path)
    weights, bias = fit_linear(x, y)
    return Model(patterns, posterior, hit, alarm, share, weights, bias)


ADDED = {"n_words": "long", "votes": "string", "posterior_low": "double", "score_low": "double", "keep": "boolean"}


def with_quality(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus word count, votes (one letter per labeller: l, h or -), posterior, score and decision."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED])
    schema = docs.select("*", *[F.lit(None).cast(k).alias(c) for c, k in ADDED.items()]).schema
    letters = np.array(["-", "l", "h"])
    patterns, posterior, weights, bias, share = model.patterns, model.posterior, model.weights, model.bias, model.share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(batch.schema.get_field_index(text_col)))
            for lo, hi in slices(offsets, rows=4096):
                stats, words, doc, ids = statistics(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                v = votes(stats, words)
                at = np.minimum(np.searchsorted(patterns, v @ _PLACES), max(len(patterns) - 1, 0))
                p = posterior[at] if len(patterns) else np.full(hi - lo, share)
                levels = _level_ids(stats, words)
                margin = bias + np.where(levels >= 0, weights[levels], 0.0).sum(1)
                margin += np.bincount(doc, weights[ids].sum(1), hi - lo) * _SCALE / np.maximum(words, 1)
                score = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
                cols = [c.slice(lo, hi - lo) for c in batch.columns]
                cols += [pa.array(words), pa.array(["".join(r) for r in letters[v]], pa.string()), pa.array(p), pa.array(score),
                         pa.array((score < 0.5) | (words == 0))]
                yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, *ADDED])

    return docs.mapInArrow(run, schema)


def quality_table(docs: DataFrame) -> DataFrame:
    """doc_id with the classifier's columns for every document."""
    docs = docs.select("doc_id", "text")
    return with_quality(docs, train(docs)).drop("text")


def keep_good(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier, trained on all of them, does not reject."""
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = with_quality(marked, train(docs, key_col, text_col), "text")
    return found.where("keep").select("row.*")
