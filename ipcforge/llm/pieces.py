"""SentencePiece encoding and decoding with a streaming Viterbi search.

The ids are those of the library for the same (merge-trained) model file.
They are found left to right: every prefix of a text has one segmentation, and
its last piece is the one whose predecessor it is compatible with (the two
pieces, joined, segment into themselves again).  So each position keeps a
backpointer, a transition between incompatible pieces is forbidden, and the
positions of the last ``longest piece`` characters are all that can still be
extended.  Ids are committed as soon as the paths of all these positions go
through one boundary; a text of any length needs a window of a few times the
longest piece.

Between two characters that stand side by side in no piece every path has a
boundary, so a text is cut there (before a space mark, around a line break)
and the ids of such a part are kept in a cache per worker.

Decoding is exact: spaces become the space mark and back, characters without
a piece become byte pieces, and so does a space mark in the text itself (the
library would give a space back for it).

Defined results: a null or empty text has no ids and decodes to empty; of
equally scored merges the leftmost comes first; repeated rows give repeated
results; an empty table gives an empty table; other columns pass through,
columns named like the results are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RecentCache, texts, worker_state

MARK = "▁"
CACHE_PARTS = 400_000  # per generation of a Python worker's cache


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, pieces: list[str], scores: list[float], plain: list[bool], byte_ids: list[int]):
        self.pieces = pieces
        self.table = {p: (s, i) for i, (p, s, ok) in enumerate(zip(pieces, scores, plain)) if ok}
        # character -> (id or -1, the characters that may follow)
        self.trie: dict[str, tuple[int, dict]] = {}
        for p, (_, i) in sorted(self.table.items(), key=lambda x: len(x[0])):
            level = self.trie
            for c in p[:-1]:
                level = level.setdefault(c, (-1, {}))[1]
            level[p[-1]] = (i, level[p[-1]][1] if p[-1] in level else {})
        self.byte_ids = byte_ids
        self.fits: dict[int, bool] = {}  # answers of compatible()
        self.longest = max(map(len, self.table), default=1)
        pairs = {p[i:i + 2] for p in self.table for i in range(len(p) - 1)}
        self.cut_before_mark = not any(x[1] == MARK and x[0] != MARK for x in pairs)
        self.cut_at_break = not any("\n" in x for x in pairs)
        self.pairs = pairs
        # how a piece is spelled, or None for a byte piece
        bytes_of = {i: b for b, i in enumerate(byte_ids)}
        self.spelled = [None if i in bytes_of else p.replace(MARK, " ") if p in self.table else "" for i, p in enumerate(pieces)]
        self.byte_of = bytes_of

    def merged(self, text: str) -> list[str]:
        """A short text's segmentation by merging its best-scored neighbours first."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.table[j][0], k) for k in range(len(parts) - 1) if (j := parts[k] + parts[k + 1]) in self.table]
            if not found:
                break
            k = min(found)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, before: int, piece: int) -> bool:
        """Whether a piece may follow another (-1: nothing that could merge with it); the answer is kept."""
        pair = ([self.pieces[before]] if before >= 0 else []) + [self.pieces[piece]]
        known = self.fits[before << 24 | piece] = self.merged("".join(pair)) == pair
        return known

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in ids]
        return cls([sp.id_to_piece(i) for i in ids], [sp.get_score(i) for i in ids], [not x for x in special],
                   [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


class StreamingViterbi:
    """Push characters, receive ids as soon as they are certain."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.widest = 0
        self._start(-1)

    def _start(self, before: int) -> None:
        self._text = ""  # characters since the last committed boundary
        self._last: list[int | None] = [before]  # last piece of the path to each position, -1 for bytes
        self._from = [0]  # where that piece starts
        self._done = 0  # starts already expanded

    def _expand(self, final: bool) -> None:
        """Extend every start whose pieces are all visible."""
        text, last, origin, v = self._text, self._last, self._from, self.v
        last += [None] * (len(text) + 1 - len(last))
        origin += [0] * (len(text) + 1 - len(origin))
        root, fits, n = v.trie, v.fits.get, len(text)
        for start in range(self._done, max(n if final else n - v.longest + 1, self._done)):
            before, level = last[start] << 24, root
            for end in range(start, n):
                hit = level.get(text[end])
                if hit is None:
                    break
                piece, level = hit
                if piece >= 0 and last[end + 1] is None:
                    known = fits(before | piece)
                    if known or known is None and v.compatible(last[start], piece):
                        last[end + 1], origin[end + 1] = piece, start
            if last[start + 1] is None:  # no piece: bytes
                last[start + 1], origin[start + 1] = -1, start
            self._done = start + 1

    def _path(self, end: int) -> list[int]:
        """Boundaries of the path to a position, from it to 0."""
        out = [end]
        while end:
            end = self._from[end]
            out.append(end)
        return out

    def _ids(self, upto: int) -> list[int]:
        out: list[int] = []
        last, origin, end = self._last, self._from, upto
        while end:
            start, i = origin[end], last[end]
            if i >= 0:
                out.append(i)
            else:
                out += [self.v.byte_ids[b] for b in reversed(self._text[start:end].encode())]
            end = start
        out.reverse()
        return out

    def feed(self, text: str) -> list[int]:
        """Ids that became certain with these characters."""
        out: list[int] = []
        step = 4 * self.v.longest
        for at in range(0, len(text), step):
            self._text += text[at:at + step]
            self._expand(False)
            self.widest = max(self.widest, len(self._text))
            # positions that can still be extended: the next start, and what pieces already reach behind it
            alive = [p for p in range(self._done, len(self._last)) if self._last[p] is not None]
            common = set(self._path(alive[0]))
            for p in alive[1:]:
                common.intersection_update(self._path(p))
            if upto := max(common, default=0):
                out += self._ids(upto)
                self._text = self._text[upto:]
                self._last = self._last[upto:]
                self._from = [max(s - upto, 0) for s in self._from[upto:]]
                self._done = max(self._done - upto, 0)
        return out

    def finish(self, text: str = "") -> list[int]:
        """The ids still open, of these last (few) characters too."""
        self._text += text
        self._expand(True)
        out = self._ids(len(self._text))
        self._start(-1)
        return out


class Coder:
    """Encoder and decoder with the per-part cache."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._cache = RecentCache(CACHE_PARTS)
        self._search = StreamingViterbi(vocabulary)
        mark, brk = self.v.cut_before_mark, self.v.cut_at_break
        if mark and brk:
            self._cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n").findall
        elif mark:
            self._cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        else:
            self._cut = lambda text: [text]
        self._literal = np.asarray([vocabulary.byte_ids[b] for b in MARK.encode()], "<i4").tobytes()

    def _search_ids(self, part: str) -> bytes:
        ids = self._search.finish(part) if len(part) <= 4 * self.v.longest else self._search.feed(part) + self._search.finish()
        return pack(f"<{len(ids)}i", *ids)

    def _part(self, part: str) -> bytes:
        """Ids of a part, which is cut once more where two characters share no piece."""
        pairs, cuts = self.v.pairs, [0]
        cuts += [i for i in range(1, len(part)) if part[i - 1:i + 1] not in pairs]
        if len(cuts) == 1:
            return self._search_ids(part)
        out, known = [], self._cache.young
        for start, end in zip(cuts, [*cuts[1:], len(part)]):
            own = part[start:end]
            ids = known.get(own)
            if ids is None:
                ids = known[own] = self._search_ids(own)
            out.append(ids)
        return b"".join(out)

    def _marked(self, text: str) -> bytes:
        cut = self._cut(text)
        try:
            return b"".join(map(self._cache.young.__getitem__, cut))
        except KeyError:
            self._cache.turn()
            new = self._cache.missing(set(cut))
            known = self._cache.young
            for p in new:
                known[p] = self._part(p)
            return b"".join(map(known.__getitem__, cut))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if MARK not in text:
            return self._marked(MARK + text.replace(" ", MARK))
        spans = (MARK + text.replace(MARK, "\0").replace(" ", MARK)).split("\0") if "\0" not in text else None
        if spans is None:
            first, *rest = text.split(MARK)
            spans = [MARK + first.replace(" ", MARK), *[r.replace(" ", MARK) for r in rest]]
        return self._literal.join(self._marked(s) if s else b"" for s in spans)

    def decode(self, ids: Iterable[int]) -> str:
        try:
            out = "".join(map(self.v.spelled.__getitem__, ids))
        except TypeError:  # byte pieces: gather their runs
            parts, run = [], bytearray()
            for i in ids:
                s = self.v.spelled[i]
                if s is None:
                    run.append(self.v.byte_of[i])
                else:
                    if run:
                        parts.append(run.decode("utf-8", "replace"))
                        run = bytearray()
                    parts.append(s)
            parts.append(run.decode("utf-8", "replace"))
            out = "".join(parts)
        return out[1:] if out.startswith(" ") else out


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _coder(path: str) -> Coder:
    return worker_state(f"pieces:{path}", lambda: Coder(Vocabulary.load(path)))


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` plus ``ids`` (array<int>) and ``ids_crc32`` (of the little-endian 32-bit ids)."""
    path = path or model_path()
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (ids_col, "ids_crc32")])
    schema = docs.select("*", F.lit(None).cast("array<int>").alias(ids_col), F.lit(0).cast("long").alias("ids_crc32")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                ids = [coder.encode(t) for t in texts(batch.column(batch.schema.get_field_index(text_col)))]
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, lists, pa.array([zlib.crc32(x) for x in ids], pa.int64())], [*batch.schema.names, ids_col, "ids_crc32"])

    return docs.mapInArrow(run, schema)


def _lists(col: pa.Array) -> Iterator[list[int]]:
    """Python lists of a list column (null: empty)."""
    flat = col.values.to_numpy(zero_copy_only=False)
    ends = col.offsets.to_numpy()
    known = col.is_valid().to_numpy(zero_copy_only=False)
    return (flat[a:b].tolist() if k else [] for a, b, k in zip(ends[:-1], ends[1:], known))


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` plus the text of its ids (null: empty)."""
    path = path or model_path()
    encoded = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c != out])
    schema = encoded.select("*", F.lit("").cast("string").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [coder.decode(x) for x in _lists(batch.column(batch.schema.get_field_index(ids_col)))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, out])

    return encoded.mapInArrow(run, schema)


def pieces_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, number and checksum of the ids, and whether decoding gives the text back.

    Encoding and decoding share one pass, so the ids of the whole corpus stay in the workers.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n, crc, same = [], [], []
                for text in texts(batch.column(1)):
                    ids = coder.encode(text)
                    n.append(len(ids) // 4)
                    crc.append(zlib.crc32(ids))
                    same.append(coder.decode(np.frombuffer(ids, "<i4").tolist()) == text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_ids", "ids_crc32", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
