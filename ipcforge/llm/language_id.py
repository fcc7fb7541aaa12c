"""Language of a text: unigram models over the pieces of a fixed public vocabulary, summed over all segmentations.

The vocabulary is a byte-level one (every byte is a piece, so every text can be
cut); its path is a parameter and it is never trained or extended.  A language's
model is a probability per piece.  The probability of a word is the sum over
all ways to cut it into pieces, by the forward algorithm; the text's is the
product over its words, so a word is computed once and looked up afterwards.

A word is a run of letters (with their marks), lower-cased, led by a
space as the vocabulary's own words are; runs longer than ``LONGEST`` letters are cut
into words of that length, the first with the space.  Digits, signs and white space say
nothing about a language and are no part of the score.

Learning takes all labelled training rows: Spark counts the words per
language, and each round of expectation-maximisation is a pass over that table: tasks
run the forward and the backward algorithm and hand on expected piece counts,
which Spark adds to one number per piece and language (the only thing that
reaches the driver: vocabulary x languages).  The models are smoothed by the
mean of all languages, and that by equal shares of all single bytes.

Defined results: a null text and one without a letter are ``und`` with score 0;
so is every text when no language could be learned; equal likelihoods go to the
first language by name; the score is the posterior of the chosen language with
equal priors; training rows with a null language teach nothing, the empty
language is one like all others; a null key is not held out; repeated rows count
and are returned each; an empty table gives an empty table; other columns are
not read.  Texts are read whole; a task holds one slice of texts or the longest one, about
20 times its size, and ``CACHE`` words.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, slices, texts, worker_state

LONGEST = 16  # letters of a word; keeps probabilities within the range of doubles
ROUNDS = 4
UNKNOWN = "und"
CACHE = 400_000
_LEVEL = 0.01  # share of a model that the mean of all languages gets, and of that the single bytes
_GAIN = 1e3  # per byte; keeps products of 65 bytes within the range of doubles at both ends
_MARKS = np.uint64(1 << 18)
_WORDS = 4096  # words per run of the forward algorithm
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_PLAIN = re.compile(r"[^\W\d_²³¹¼½¾]+")  # the same for texts without marks, which begin at U+0300
_MARKED = re.compile("[\u0300-\U0010ffff]")


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(key: Column) -> Column:
    """A quarter of the keys, by their checksum."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def words_of(text: str) -> list[str]:
    """The words of a text, each led by a space unless it continues a longer run."""
    text = text.lower()
    letters = _LETTERS if _MARKED.search(text) else _PLAIN
    runs = [" " + run for run in letters.findall(text)]
    if not runs or len(max(runs, key=len)) <= LONGEST + 1:
        return runs
    out = []
    for run in runs:
        out.append(run[:LONGEST + 1])
        out += [run[i:i + LONGEST] for i in range(LONGEST + 1, len(run), LONGEST)]
    return out


# ---------------------------------------------------------------- segmentations


class Pieces:
    """The vocabulary as sorted hashes per piece length."""

    def __init__(self, path: str):
        with open(path, "rb") as fh:
            pieces = [base64.b64decode(line.split()[0]) for line in fh if line.strip()]
        self.size = len(pieces)
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if len(piece) <= 4 * LONGEST + 1:
                by_length.setdefault(len(piece), []).append(i)
        self.tables = []
        for length, ids in sorted(by_length.items()):
            at = np.array(ids)
            h = self._hash(np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8).reshape(-1, length))
            order = np.argsort(h)
            maybe = np.zeros(_MARKS, bool)  # most substrings are no piece: one look tells
            maybe[h % _MARKS] = True
            self.tables.append((length, h[order], at[order], maybe))
        self.single = np.array(by_length.get(1, []))
        if len(self.single) < 256:
            raise ValueError(f"{path} has no piece for some byte")

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), np.uint64)
        for i in range(rows.shape[1]):
            h = (h + rows[:, i] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return mix64(h)

    def edges(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, start, end, piece) of every piece that occurs in a word."""
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), lengths)
        begin = np.cumsum(lengths) - lengths
        start = np.arange(len(data)) - begin[word]
        left = lengths[word] - start  # bytes from here to the word's end
        found = []
        h, at = np.zeros(len(data), np.uint64), np.arange(len(data))
        reached = 0
        for length, hashes, ids, maybe in self.tables:
            for i in range(reached, length):  # extend the hash of every substring by one byte
                fits = left[at] > i
                at, h = at[fits], h[fits]
                h = (h + data[at + i] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            reached = length
            if not len(at):
                break
            mixed = mix64(h)
            look = np.flatnonzero(maybe[mixed % _MARKS])
            mixed = mixed[look]
            place = np.minimum(np.searchsorted(hashes, mixed), len(hashes) - 1)
            hit = hashes[place] == mixed
            begins = at[look[hit]]
            found.append((word[begins], start[begins], start[begins] + length, ids[place[hit]]))
        return tuple(np.concatenate(x) for x in zip(*found))


def load_pieces(path: str) -> Pieces:
    return worker_state(f"pieces:{path}", lambda: Pieces(path))


def _scatter(into: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Add rows of ``values`` to the rows ``at`` of ``into``."""
    for j in range(values.shape[1]):
        into[:, j] += np.bincount(at, values[:, j], len(into))


def forward(pieces: Pieces, words: list[bytes], model: np.ndarray) -> tuple[np.ndarray, tuple, np.ndarray]:
    """(word probabilities x ``_GAIN`` per byte, edges in order of their end, all forward values).

    ``model`` has one column of piece probabilities per language.
    """
    word, start, end, piece = pieces.edges(words)
    order = np.argsort(end, kind="stable")
    word, start, end, piece = word[order], start[order], end[order], piece[order]
    lengths = np.array([len(w) for w in words])
    most = int(lengths.max())
    values = np.zeros((most + 1, len(words), model.shape[1]))
    values[0] = 1.0
    weight = model[piece] * (_GAIN ** (end - start))[:, None]
    cuts = np.searchsorted(end, np.arange(1, most + 2))
    for e in range(1, most + 1):
        a, b = cuts[e - 1], cuts[e]
        _scatter(values[e], word[a:b], values[start[a:b], word[a:b]] * weight[a:b])
    return values[lengths, np.arange(len(words))], (word, start, end, piece, weight), values


def expected_counts(pieces: Pieces, words: list[bytes], n: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Expected number of uses of every piece in ``n`` copies of the words, by forward and backward values (one language)."""
    total, (word, start, end, piece, weight), values = forward(pieces, words, model)
    lengths = np.array([len(w) for w in words])
    back = np.zeros(values.shape[:2])
    back[lengths, np.arange(len(words))] = 1.0
    order = np.argsort(-start, kind="stable")  # a position is complete before pieces that end there use it
    begins = start[order]
    cuts = np.searchsorted(-begins, np.arange(-values.shape[0] + 1, 2))
    for i in range(len(cuts) - 1):
        at = order[cuts[i]:cuts[i + 1]]
        if len(at):
            s = start[at[0]]
            back[s] += np.bincount(word[at], weight[at, 0] * back[end[at], word[at]], len(words))
    used = values[start, word, 0] * weight[:, 0] * back[end, word] / total[word, 0] * n[word]
    return np.bincount(piece, used, pieces.size)


def log_probabilities(pieces: Pieces, words: list[bytes], model: np.ndarray) -> np.ndarray:
    """Natural log of the probability of every word (rows) in every language (columns)."""
    out = np.zeros((len(words), model.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))  # words of like length together
    for lo in range(0, len(order), _WORDS):
        at = order[lo:lo + _WORDS]
        part = [words[i] for i in at]
        total, _, _ = forward(pieces, part, model)
        out[at] = np.log(total) - np.log(_GAIN) * np.array([len(w) for w in part])[:, None]
    return out


# ---------------------------------------------------------------- learning


@dataclass
class Model:
    languages: list[str]
    probabilities: np.ndarray  # pieces x languages


def word_table(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of a table (lang, text); tasks add up their slices first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                held.setdefault(lang, Counter()).update(words_of(text))
            for lang, count in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(count), pa.string()), pa.array(list(count), pa.string()),
                                                  pa.array(list(count.values()), pa.int64())], ["lang", "word", "n"])

    return rows.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def smoothed(counts: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Piece probabilities per language (columns) from expected counts; ``single`` are the pieces of one byte."""
    total = counts.sum(axis=0)
    own = counts / np.where(total > 0, total, 1)
    mean = (1 - _LEVEL) * own.mean(axis=1)
    mean[single] += _LEVEL / len(single)
    return (1 - _LEVEL) * own + _LEVEL * mean[:, None]


def learn(rows: DataFrame, path: str, rounds: int = ROUNDS) -> Model | None:
    """Models of all languages of a table (lang, text); None without any word."""
    table, _ = materialize(word_table(rows), "language_words")
    languages = sorted(r["lang"] for r in table.select("lang").distinct().collect())  # the models are one column each
    if not languages:
        return None
    pieces = load_pieces(path)
    size, single = pieces.size, pieces.single
    # at first all pieces are alike, so few long pieces win over many short ones
    model = Model(languages, np.full((size, len(languages)), 1.0 / size))
    for _ in range(rounds):
        shared = table.sparkSession.sparkContext.broadcast(model)  # vocabulary x languages

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces, now = load_pieces(path), shared.value
            column = {lang: j for j, lang in enumerate(now.languages)}
            counts: dict[int, np.ndarray] = {}
            for batch in batches:
                lang = np.array([column[x] for x in batch.column(0).to_pylist()], np.int64)
                words = [w.encode() for w in batch.column(1).to_pylist()]
                n = batch.column(2).to_numpy()
                for j in np.unique(lang):
                    mine = np.flatnonzero(lang == j)
                    mine = mine[np.argsort([len(words[i]) for i in mine], kind="stable")]
                    for lo in range(0, len(mine), _WORDS):
                        at = mine[lo:lo + _WORDS]
                        new = expected_counts(pieces, [words[i] for i in at], n[at], now.probabilities[:, j:j + 1])
                        counts[j] = counts.get(j, 0.0) + new
            for j, c in counts.items():
                used = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), j, np.int32)), pa.array(used.astype(np.int32)), pa.array(c[used])],
                                                 ["column", "piece", "n"])

        found = table.mapInArrow(run, "column int, piece int, n double").groupBy("column", "piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros((size, len(languages)))
        counts[found.column("piece").to_numpy(), found.column("column").to_numpy()] = found.column("n").to_numpy()
        model = Model(languages, smoothed(counts, single))
        shared.unpersist()
    return model


# ---------------------------------------------------------------- prediction


class Scores:
    """Log probabilities of the words met lately; a worker keeps them across tasks."""

    def __init__(self, pieces: Pieces, model: Model, limit: int):
        self.pieces, self.model, self.limit = pieces, model, limit
        self.row: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages)))

    def rows(self, words: list[str]) -> np.ndarray:
        """Table rows of the words; unknown ones are computed together."""
        if len(self.row) > self.limit:
            self.row = {}
        row = self.row
        at = list(map(row.get, words))
        if None in at:
            new = list(dict.fromkeys(w for w, i in zip(words, at) if i is None))
            first = len(row)
            need = first + len(new)
            if need > len(self.table):
                grown = np.zeros((max(need, 2 * len(self.table)), self.table.shape[1]))
                grown[:first] = self.table[:first]
                self.table = grown
            self.table[first:need] = log_probabilities(self.pieces, [w.encode() for w in new], self.model.probabilities)
            row.update(zip(new, range(first, need)))
            at = list(map(row.get, words))
        return np.array(at, np.int64)


def _decide(scores: Scores, parts: list[list[str]]) -> tuple[list[str], np.ndarray]:
    """Language and posterior per text."""
    counts = np.array([len(p) for p in parts], np.int64)
    rows = scores.rows([w for p in parts for w in p])
    sums = np.zeros((len(parts), scores.table.shape[1]))
    some = np.flatnonzero(counts)
    if len(some):
        begin = (np.cumsum(counts) - counts)[some]
        sums[some] = np.add.reduceat(scores.table[rows], begin, axis=0)
    best = sums.argmax(axis=1)
    share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    names = [scores.model.languages[b] if c else UNKNOWN for b, c in zip(best, counts)]
    return names, np.where(counts > 0, share, 0.0)


def identify(docs: DataFrame, model: Model | None, path: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` are dropped but those given first; adds ``lang_pred`` and ``score`` from the text alone."""
    keep = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + ["lang_pred string", "score double"])
    if model is None:
        return docs.drop(text).withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_scores = worker_state("language", dict)  # of one model at a time
        if name not in held_scores:
            held_scores.clear()
            held_scores[name] = Scores(load_pieces(path), shared.value, CACHE)
        scores = held_scores[name]
        for batch in batches:
            held = texts(batch.column(batch.schema.get_field_index(text)))
            sizes = np.cumsum([0] + [len(t) for t in held])
            names, share = [], []
            for lo, hi in slices(sizes):
                a, b = _decide(scores, [words_of(t) for t in held[lo:hi]])
                names += a
                share.append(b)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(np.concatenate(share) if share else [], pa.float64())],
                                             [*(f.name for f in keep), "lang_pred", "score"])

    return docs.select(*[F.col(f"`{f.name}`") for f in keep], F.col(text)).mapInArrow(run, schema)


def language_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", path: str | None = None,
                    rounds: int = ROUNDS) -> DataFrame:
    """(key, held_out, lang_pred, score) of every text; learned from the rows that are not held out and have a language."""
    path = path or vocabulary_path()
    known = docs.where(~held_out(F.col(key)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    model = learn(known.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")), path, rounds)
    return identify(docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), F.col(text)), model, path, text)
