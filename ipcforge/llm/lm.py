"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Every token has a class: the most frequent words and the text end have one
each, all other words share hashed classes.  The model predicts the next
class from the vector of the previous one, ``s(w | c) = (r_c A) . q_w + b_w``;
a word within a hashed class has its smoothed share of the class.  So
probabilities are normalised over all words, known or not.

All training texts count.  Spark aggregates word counts and the class pairs
(context, next) of the whole corpus; the pairs are sufficient for the model and at
most ``CLASSES`` squared, so the numpy training sees all tokens in bounded
memory.  One batched matrix product then gives the normalised log
probabilities of all contexts, a table of that bound that scoring looks up.

Word counts grow with the corpus.  Scoring tasks get the most frequent words (at
most ``SHORT``, a count bound) by broadcast; all rarer words of a text are
joined with the full counts in Spark and summed per text.

Defined results: a null or empty text is its end token alone; a null key is
not held out; repeated rows are scored each; equal counts are ordered by
hash; an empty table gives an empty table; other columns are not carried.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices, text_buffer
from .words import word_hashes

OWN, SHARED = 767, 256  # classes of one word, and hashed classes; with the end 1024 in all
CLASSES = OWN + SHARED + 1
SHORT = 1 << 19  # words whose counts are broadcast
SMOOTH = 0.1
END = np.uint64(0x656E64)  # stands for the end token among word hashes
_END_CLASS = OWN


def is_held_out(key: Column) -> Column:
    """One tenth of the keys, by their checksum."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def _token_stream(batch_text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, token hashes with ends, n+1 token offsets) per slice of a batch."""
    data, offsets = text_buffer(batch_text)
    for lo, hi in slices(offsets):
        h, at = word_hashes(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        tokens = np.insert(h, at[1:], END)
        yield lo, hi, tokens, at + np.arange(len(at))


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, n) of all tokens of a one-column table of texts."""

    def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        h, n = (np.concatenate(x) for x in zip(*parts))
        h, at = np.unique(h, return_inverse=True)
        return h, np.bincount(at, n, len(h)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for _, _, tokens, _ in _token_stream(batch.column(0)):
                parts.append(np.unique(tokens, return_counts=True))
                held += len(parts[-1][0])
                if held > 4_000_000:  # bounded memory: merge, and hand over what stays large
                    parts = [merge(parts)]
                    held = len(parts[0][0])
                    if held > 2_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(parts[0][0].view(np.int64)), pa.array(parts[0][1])], ["h", "n"])
                        parts, held = [], 0
        if parts:
            h, n = merge(parts)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _shortlist(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the most frequent words, ``SHORT`` at most.

    A histogram over count magnitudes (a few hundred rows) gives the bound.
    """
    rows = counts.groupBy(F.floor(F.log2("n") * 16).alias("size")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect()
    least, held = None, 0
    for r in sorted(rows, key=lambda r: -r["size"]):
        held += r["words"]
        if held > SHORT:
            break
        least = r["least"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = counts.where(F.col("n") >= least).toArrow()
    h = found.column("h").to_numpy().view(np.uint64)
    n = found.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


class Classes:
    """Class of a token hash, and the smoothed share of a word within its class."""

    def __init__(self, own: np.ndarray):
        self.hashes = np.sort(own)

    def of(self, h: np.ndarray) -> np.ndarray:
        out = (h & np.uint64(SHARED - 1)).astype(np.int64) + OWN + 1
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            own = self.hashes[at] == h
            out[own] = at[own]
        out[h == END] = _END_CLASS
        return out


def pair_counts(texts: DataFrame, classes: Classes) -> np.ndarray:
    """Counts of (context class, next class) over all texts, a CLASSES x CLASSES table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for _, _, tokens, _ in _token_stream(batch.column(0)):
                c = classes.of(tokens)
                context = np.concatenate([[_END_CLASS], c[:-1]])  # a text follows an end
                seen += np.bincount(context * CLASSES + c, minlength=CLASSES * CLASSES)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["pair", "n"])

    found = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(CLASSES * CLASSES, np.int64)
    table[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return table.reshape(CLASSES, CLASSES)


def train_nce(pairs: np.ndarray, dim: int = 48, noise: int = 8, steps: int = 200, rate: float = 0.3,
              prior: float = 10.0, damp: float = 0.05, seed: int = 7) -> np.ndarray:
    """Normalised natural-log probabilities (context x class) of a log-bilinear model.

    Each data token is set against ``noise`` draws from the smoothed unigram
    distribution (drawn anew every 20 steps), and the model learns to tell them apart.
    A row's gradient is averaged over the row's own tokens, so rare and
    frequent classes learn at one pace; ``prior`` is the precision of a
    normal prior on the vectors and ``damp`` a uniform weight, so that rows with
    few tokens stay near zero.
    """
    rng = np.random.default_rng(seed)
    m, total = len(pairs), max(int(pairs.sum()), 1)
    context = pairs.sum(1) / total
    unigram = (pairs.sum(0) + SMOOTH) / (pairs.sum() + SMOOTH * m)
    data = (pairs / total).astype(np.float32)
    log_noise = np.log(noise * unigram).astype(np.float32)
    params = {"r": rng.normal(0, 0.3, (m, dim)), "a": np.eye(dim), "q": rng.normal(0, 0.1, (m, dim)), "b": np.log(unigram)}
    params = {k: v.astype(np.float32) for k, v in params.items()}
    pull = np.float32(prior / total)
    per_class = 1 / ((unigram + damp / m + pull) * noise ** 0.5)
    pace = {"r": 1 / (context[:, None] + damp / m + pull), "a": np.ones(1), "q": per_class[:, None], "b": per_class}
    pace = {k: v.astype(np.float32) for k, v in pace.items()}
    moving = {k: np.zeros_like(v) for k, v in params.items()}
    for step in range(steps):
        if step % 20 == 0:
            mean = np.minimum(noise * total * context[:, None] * unigram[None, :], 1e15)
            drawn = (rng.poisson(mean) / total).astype(np.float32)
        hidden = params["r"] @ params["a"]
        is_data = 1 / (1 + np.exp(-np.clip(hidden @ params["q"].T + params["b"] - log_noise, -30, 30)))
        slope = drawn * is_data - data * (1 - is_data)
        back = slope @ params["q"]
        grads = {"r": back @ params["a"].T + pull * params["r"], "a": params["r"].T @ back,
                 "q": slope.T @ hidden + pull * params["q"], "b": slope.sum(0)}
        now = rate * min(1.0, 2 * (1 - (step + 1) / (steps + 1)))
        for k, g in grads.items():
            moving[k] = 0.9 * moving[k] - now * g * pace[k]
            params[k] += moving[k]
    logits = ((params["r"] @ params["a"]) @ params["q"].T + params["b"]).astype(np.float64)
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


@dataclass
class Model:
    tokens: int  # N
    words: int  # V
    short_hashes: np.ndarray
    short_counts: np.ndarray
    classes: Classes
    log10_p: np.ndarray  # context x class
    shared_tokens: np.ndarray  # per hashed class
    shared_words: np.ndarray
    counts: DataFrame  # all words


def train(texts: DataFrame) -> Model:
    """A model of all rows of a one-column table of texts."""
    counts, _ = materialize(word_counts(texts), "word-counts")
    per = counts.groupBy(F.col("h").bitwiseAND(F.lit(SHARED - 1)).alias("k")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    shared_tokens, shared_words = np.zeros(SHARED, np.int64), np.zeros(SHARED, np.int64)
    for r in per:
        shared_tokens[r["k"]], shared_words[r["k"]] = r["n"], r["words"]
    tokens, words = int(shared_tokens.sum()), int(shared_words.sum())
    h, n = _shortlist(counts)
    order = np.lexsort((h, -n))
    order = order[h[order] != END][:OWN]
    classes = Classes(h[order])
    for one, count in [*zip(h[order], n[order]), *zip(h[h == END], n[h == END])]:
        shared_tokens[int(one) & (SHARED - 1)] -= count
        shared_words[int(one) & (SHARED - 1)] -= 1
    pairs = pair_counts(texts, classes)
    return Model(tokens, words, h, n, classes, train_nce(pairs) / np.log(10), shared_tokens, shared_words, counts)


_SCORED = ("row long, key long, held_out boolean, n_tokens long, n_known long, base double, score double, "
           "rare array<struct<h:bigint,n:bigint>>")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for (key, held_out, text) rows."""
    spark = docs.sparkSession
    fixed = spark.sparkContext.broadcast((model.short_hashes, model.short_counts, model.classes.hashes, model.log10_p.astype(np.float32)))
    whole = np.log10(model.tokens + SMOOTH * (model.words + 1))
    in_class = np.zeros(CLASSES)
    in_class[OWN + 1:] = np.log10(model.shared_tokens + SMOOTH * (model.shared_words + 1))
    kind = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, counts, own_hashes, log10_p = fixed.value
        classes = Classes(own_hashes)
        table, top = log10_p.ravel(), max(len(short) - 1, 0)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, tokens, at in _token_stream(batch.column(2)):
                size = hi - lo
                doc = np.repeat(np.arange(size), np.diff(at))
                c = classes.of(tokens)
                context = np.concatenate([[_END_CLASS], c[:-1]])
                place = np.minimum(np.searchsorted(short, tokens), top)
                known = short[place] == tokens if len(short) else np.zeros(len(tokens), bool)
                own = np.zeros(len(tokens))
                own[known] = np.log10(counts[place[known]] + SMOOTH)
                shared = c > _END_CLASS
                add = lambda x: np.bincount(doc, x, size)
                base = add(own) - whole * np.diff(at)
                model_score = add(table[context * CLASSES + c].astype(np.float64) + np.where(shared, own - in_class[c], 0.0))
                rare = np.flatnonzero(~known)
                order = rare[np.lexsort((tokens[rare], doc[rare]))]
                first = np.flatnonzero(np.concatenate([[True], (tokens[order][1:] != tokens[order][:-1]) | (doc[order][1:] != doc[order][:-1])])) if len(order) else order
                times = np.diff(np.append(first, len(order)))
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc[order[first]], minlength=size))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                    [pa.array(tokens[order[first]].view(np.int64)), pa.array(times.astype(np.int64))], ["h", "n"])).cast(kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(size)), batch.column(0).slice(lo, size), batch.column(1).slice(lo, size),
                     pa.array(np.diff(at).astype(np.int64)), pa.array(add(known).astype(np.int64)), pa.array(base),
                     pa.array(model_score), lists],
                    ["row", "key", "held_out", "n_tokens", "n_known", "base", "score", "rare"])
                row += size

    done, _ = materialize(docs.select("key", "held_out", "text").mapInArrow(run, _SCORED), "scored")
    rare = done.select("row", F.inline("rare")).withColumnRenamed("n", "times")
    found = rare.join(model.counts, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + F.lit(SMOOTH))).alias("more"),
                                    F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("seen"))
    more, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    return done.drop("rare").join(sums, "row", "left").select(
        "key", "held_out", "n_tokens", (F.col("n_known") + seen).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))


def lm_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: training on all documents that are not held out, scores for all."""
    docs = docs.select(F.col("doc_id").cast("long").alias("key"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    model = train(docs.where(~F.col("held_out")).select("text"))
    return score(docs, model).withColumnRenamed("key", "doc_id")
