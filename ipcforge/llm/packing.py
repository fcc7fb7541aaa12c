"""Best-fit packing of documents into fixed-length token sequences.

Three narrow steps around one bounded plan:

1. Tokenize (Arrow batches).  A document's ids plus the end id are cut into
   pieces of at most ``capacity``; every piece gets its rank among the pieces
   of equal length in its partition.
2. Rank globally: counts per (partition, length) and their running sums give
   every piece a number among all pieces of its length.
3. The histogram of lengths (at most ``capacity`` rows, whatever the size of
   the corpus) is packed by :func:`plan_bins`.  Its result says for a
   length and a range of ranks which sequences take them at which offset, so
   pieces find their place by binary search, without moving any text.

:func:`plan_bins`: pieces above one third of the capacity are matched first,
longest first, each with the tightest open partner (three cannot share a
sequence, so every sequence holds two of them at most); the smaller ones then
best-fit the remaining gaps, longest first.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; equal lengths are told apart by rank only; an empty table gives
an empty table; extra columns are not carried (join on the key if needed).
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import RecentCache, materialize, worker_state

CAPACITY = 2048
CACHE_WORDS = 300_000  # words per generation of a Python worker's cache (about 60 MB)
JOINED = 64  # words per call of the tokenizer
MARKS = b".,!?;:%$&#*"  # ASCII marks that form tokens apart from letters
SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCoder:
    """Ids of a text as little-endian uint32 bytes, word by word from a cache.

    The tokenizer drops white space and never joins across it, so a text's
    ids are its words' ids in order.  Pure ASCII texts are lower-cased first
    (the tokenizer does the same) to make the cache smaller; texts that hold
    a special token's string go through the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._coder = Tokenizer.from_file(path)
        self._cache = RecentCache(CACHE_WORDS)
        self._ends_in_letter: dict[str, bool] = {}  # by last character, at most one entry per code point

    def _encode(self, found: list[str]) -> list[bytes]:
        """Ids of words without ASCII white space: ``JOINED`` at a time as one text, cut where a word begins."""
        out = []
        for lo in range(0, len(found), 64 * JOINED):
            parts = [found[i:i + JOINED] for i in range(lo, min(len(found), lo + 64 * JOINED), JOINED)]
            for e, part in zip(self._coder.encode_batch([" ".join(p) for p in parts], add_special_tokens=False), parts):
                begins = np.cumsum([0] + [len(w) + 1 for w in part])
                at = (4 * np.searchsorted([a for a, _ in e.offsets], begins)).tolist()
                data = np.array(e.ids, "<u4").tobytes()
                out += [data[a:b] for a, b in zip(at, at[1:])]
        return out

    def _takes_marks(self, core: bytes) -> bool:
        """Does the word still end in a letter when normalized?  Marks behind it are tokens apart only then."""
        last = core[-4:].decode(errors="ignore")[-1:]
        if last not in self._ends_in_letter:
            self._ends_in_letter[last] = self._coder.normalizer.normalize_str(last)[-1:].isalpha()
        return self._ends_in_letter[last]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        whole = {i for i, t in enumerate(texts) if b"<|" in t and any(s in t for s in SPECIAL)}
        split = [() if i in whole else (t.lower() if t.isascii() else t).split() for i, t in enumerate(texts)]
        self._cache.turn()
        new = self._cache.missing(set().union(*split))
        words = self._cache.young
        # marks behind a letter are a token of their own, so most new words are a known one with a mark
        ends = [(w, core) for w in new if (core := w.rstrip(MARKS)) and core != w and self._takes_marks(core)]
        parts = {core for _, core in ends} | {w[len(core):] for w, core in ends}
        need = self._cache.missing(parts.union(new).difference([w for w, _ in ends]))
        words.update(zip(need, self._encode([w.decode() for w in need])))
        words.update((w, words[core] + words[w[len(core):]]) for w, core in ends)
        out = [b"".join(map(words.__getitem__, s)) for s in split]
        for i in whole:
            ids = self._coder.encode(texts[i].decode(), add_special_tokens=False).ids
            out[i] = np.array(ids, "<u4").tobytes()
        return out


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0,
                 key_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of every document with their rank among equal lengths of their partition."""
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_state(f"words:{vocabulary}", lambda: WordCoder(vocabulary))
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                keys = batch.column(0).to_pylist()
                texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
                rows, kept = [], []
                for key, ids in zip(keys, coder.ids(texts)):
                    ids += end
                    for piece, cut in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[cut:cut + 4 * capacity]
                        n = len(own) // 4
                        rows.append((key, piece, cut // 4, n, zlib.crc32(own), part, seen[n]))
                        seen[n] += 1
                        if keep_ids:
                            kept.append(np.frombuffer(own, "<i4"))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"]
                if keep_ids:
                    cols.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col(key_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset) for all pieces of a length histogram.

    Equal lengths move together: one step fills as many equal gaps as it
    can, so the number of steps depends on the number of different lengths
    and gaps only, not on the number of pieces.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges of sequences (first, count)
    order: list[int] = []
    opened = 0

    def put_back(gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, count))

    def fill(length: int, rank: int, count: int, gap: int, first: int, bins: int) -> int:
        """Up to ``count`` pieces into ``bins`` sequences of this gap; returns how many went in."""
        each = gap // length
        full = min(bins, count // each)
        for slot in range(each if full else 0):
            plan.append((length, rank + slot * full, full, first, capacity - gap + slot * length))
        put_back(gap - each * length, first, full)
        placed = each * full
        if full < bins and (rest := min(count - placed, each)):
            for slot in range(rest):
                plan.append((length, rank + placed + slot, 1, first + full, capacity - gap + slot * length))
            put_back(gap - rest * length, first + full, 1)
            placed, full = placed + rest, full + 1
        put_back(gap, first + full, bins - full)
        return placed

    def place(length: int, count: int) -> None:
        nonlocal opened
        rank = 0
        while rank < count:
            at = bisect_left(order, length)
            if at < len(order):
                gap = order[at]
                first, bins = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:
                gap, first, bins = capacity, opened, -(-(count - rank) // (capacity // length))
                opened += bins
            rank += fill(length, rank, count - rank, gap, first, bins)

    lengths = sorted(histogram, reverse=True)
    for length in (n for n in lengths if 3 * n > capacity):  # matching: at most two per sequence
        place(length, histogram[length])
    for length in (n for n in lengths if 3 * n <= capacity):  # best fit into what is left
        place(length, histogram[length])
    return plan


_RANKS = 1 << 45  # ranks below it and lengths share one 64-bit search key


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = 0,
         key_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and offset."""
    vocabulary = vocabulary or vocabulary_path("word_bpe_49k.json")
    pieces, _ = materialize(token_pieces(docs, vocabulary, capacity, end_id, key_col, text_col, keep_ids), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = sorted(plan_bins(histogram, capacity))
    low = np.array([p[0] * _RANKS + p[1] for p in plan], np.int64)
    rank0, bin0, offset = (np.array([p[i] for p in plan], np.int64) for i in (1, 3, 4))
    before = counts.select("part", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn(
        "rank", F.col("local_rank") + F.coalesce("before", F.lit(0)))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(low, length * _RANKS + rank, "right") - 1
            cols = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(bin0[at] + rank - rank0[at]), pa.array(offset[at])], [*names, "sequence_id", "offset"])

    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
              + ("ids array<int>, " if keep_ids else "") + "sequence_id long, offset long")
    return ranked.select(*names, "rank").mapInArrow(run, schema)
