"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

1. Features (one narrow pass over the texts): the set of distinct word
   shingles gives ``BANDS * ROWS`` MinHash samples.  The samples of a band
   become its key; all samples fold into an odd sketch, a parity bitmap in which
   sample i with value v flips bit hash(i, v).  Two sketches differ in few
   bits only when most samples agree, so the population count of their XOR
   estimates high similarities without the samples themselves.
2. Equal shingle sets collapse to one numbered class with one text, so a group
   of copies or repeated rows of any size costs one row from here on.
3. Star round: every member of a bucket (equal band key) is paired with the
   bucket's first member, never with all others; pairs whose sketches are too
   far apart go, the rest is confirmed exactly on full sets.  Confirmed links
   give components.
4. Rest round: members of one bucket that are not yet in one component
   are compared with each other, in salted blocks of bounded size, by their
   sketches and by a finer odd sketch that only these members get; what
   is near is confirmed exactly and merged.  So pairs are skipped only when their
   component is already known, and no link between components is lost.

With 24 bands of 4 rows a pair of similarity 0.8 shares no bucket with
probability 3e-6; the sketch bound is over five standard deviations wide.

Joins with a key that may hold a third of the rows are plain equi-joins of a table
with one row per key: adaptive execution broadcasts that row table when it is
measured small, and splits skewed partitions of the other side when not.

Defined results: each row is a document of its own, whether its key repeats, with
the same or another text, or is null; null and empty texts have an empty
set, are linked with nothing and stay; the component of a row is the
smallest key among all rows it reaches, null where none of them has a key; equal
sets are one class; an empty table gives an empty table; other columns are
ignored (:func:`near_duplicates`) or pass through (:func:`keep_first`).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, remove_path, slices, text_buffer
from .words import shingle_hashes, word_hashes

BANDS, ROWS = 24, 4
WORDS64 = 8  # odd sketch of 512 bits
FAR = 73  # sketches of a pair at the similarity bound differ in 36 bits on average, deviation 7
BLOCK = 256  # rows per block of a bucket in the rest round, and copies of a text per salt

# A finer sketch for the members of shared buckets: more samples, 2048 bits; a
# pair at the bound differs in 265 bits on average, deviation 20.
FINE, FINE64, FINE_FAR = 768, 32, 365

_INDEX = np.arange(1, FINE + 1, dtype=np.uint64)
_MULT = mix64(_INDEX * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_XOR = mix64(_INDEX * np.uint64(0x9FB21C651E98DF25))


def minhash(hashes: np.ndarray, samples: int = BANDS * ROWS) -> np.ndarray:
    """MinHash samples of a non-empty set."""
    least = np.full(samples, np.iinfo(np.uint64).max, np.uint64)
    xor, mult, width = _XOR[:samples, None], _MULT[:samples, None], (1 << 17) // samples
    for lo in range(0, len(hashes), width):
        part = (hashes[None, lo:lo + width] ^ xor) * mult
        np.minimum(least, part.min(axis=1), out=least)
    return least


def odd_sketches(samples: np.ndarray, words64: int = WORDS64) -> np.ndarray:
    """Parity bitmaps (n x words64 uint64) of n rows of samples."""
    index = np.arange(samples.shape[1], dtype=np.uint64)
    bit = mix64(samples + mix64(index + np.uint64(1))) % np.uint64(64 * words64)
    out = np.zeros((len(samples), words64), np.uint64)
    rows = np.arange(len(samples))
    for j in range(samples.shape[1]):
        word = (bit[:, j] >> np.uint64(6)).astype(np.int64)
        out[rows, word] ^= np.uint64(1) << (bit[:, j] & np.uint64(63))
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (n x BANDS); the band's number is part of it."""
    key = np.zeros((len(samples), BANDS), np.uint64)
    for r in range(ROWS):
        key = mix64(key + samples[:, r::ROWS][:, :BANDS] + np.arange(BANDS, dtype=np.uint64))
    return key


FEATURES = ("id long, text string, n_shingles long, set_a long, set_b long, bands array<long>, "
            + ", ".join(f"s{i} long" for i in range(WORDS64)))


def features(docs: DataFrame, width: int) -> DataFrame:
    """(id, text) rows with set size, identity of the set, band keys and odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in slices(offsets):
                own = offsets[lo:hi + 1] - offsets[lo]
                sets = shingle_hashes(*word_hashes(data[offsets[lo]:offsets[hi]], own), width)
                n = np.array([len(s) for s in sets], np.int64)
                full = [s for s in sets if len(s)]
                a, b = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                a[n > 0] = [np.add.reduce(mix64(s)) for s in full]
                b[n > 0] = [np.bitwise_xor.reduce(mix64(s + _XOR[0])) for s in full]
                samples = np.array([minhash(s) for s in full], np.uint64).reshape(len(full), BANDS * ROWS)
                sketch = np.zeros((hi - lo, WORDS64), np.uint64)
                sketch[n > 0] = odd_sketches(samples)
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(band_keys(samples).ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns), pa.array(n), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                     bands, *[pa.array(sketch[:, i].copy().view(np.int64)) for i in range(WORDS64)]],
                    ["id", "text", "n_shingles", "set_a", "set_b", "bands", *[f"s{i}" for i in range(WORDS64)]])

    return docs.mapInArrow(run, FEATURES)


def fine_sketches(texts: DataFrame, width: int) -> DataFrame:
    """(id, f0 ..) with the finer odd sketch of (id, text) rows whose sets are not empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in slices(offsets):
                own = offsets[lo:hi + 1] - offsets[lo]
                sets = shingle_hashes(*word_hashes(data[offsets[lo]:offsets[hi]], own), width)
                full = [i for i, x in enumerate(sets) if len(x)]
                samples = np.array([minhash(sets[i], FINE) for i in full], np.uint64).reshape(len(full), FINE)
                sketch = odd_sketches(samples, FINE64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(full, pa.int64())),
                     *[pa.array(sketch[:, i].copy().view(np.int64)) for i in range(FINE64)]],
                    ["id", *[f"f{i}" for i in range(FINE64)]])

    return texts.select("id", "text").mapInArrow(run, "id long, " + ", ".join(f"f{i} long" for i in range(FINE64)))


def _similar(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (u, v, text_u, text_v) whose sets reach the similarity, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [text_buffer(batch.column(i)) for i in (2, 3)]
            both = sides[0][1] + sides[1][1]
            for lo, hi in slices(both):
                sets = []
                for data, offsets in sides:
                    own = offsets[lo:hi + 1] - offsets[lo]
                    sets.append(shingle_hashes(*word_hashes(data[offsets[lo]:offsets[hi]], own), width))
                ok = []
                for i, (x, y) in enumerate(zip(*sets)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if common and 100 * common >= percent * (len(x) + len(y) - common):
                        ok.append(lo + i)
                if ok:
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(ok)) for c in (0, 1)], ["u", "v"])

    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long")


def _attach(pairs: DataFrame, texts: DataFrame, side: str, other: str) -> DataFrame:
    """``pairs`` with the text of one side.

    A class in very many pairs (a star's centre) is copied once per
    ``BLOCK`` of its pairs, so no task gets all of them.
    """
    need = pairs.groupBy(side).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("salts"))
    spread = pairs.join(need, side).withColumn("salt", F.pmod(F.xxhash64(other), F.col("salts")).cast("int")).drop("salts")
    copies = texts.join(need.withColumnRenamed(side, "id"), "id").select(
        F.col("id").alias(side), F.col("text").alias(f"text_{side}"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return spread.join(copies, [side, "salt"]).drop("salt")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Written links among candidate ``pairs`` (u, v)."""
    pairs, pairs_path = materialize(pairs, "pairs")
    left, left_path = materialize(_attach(pairs, texts, "u", "v"), "sides")
    links, _ = materialize(_similar(_attach(left, texts, "v", "u"), width, percent), "links")
    for path in (pairs_path, left_path):
        remove_path(pairs.sparkSession, path)
    return links


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """(id, component) for every node of the links (u, v); component is its smallest reachable id.

    Alternating star contraction: every node's larger neighbours, then its
    smaller ones, are hung on its smallest neighbour until nothing changes.
    Neighbourhoods are only aggregated, never collected.
    """
    edges, path = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                              .where("u <> v").distinct(), "edges")
    n = edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large, large_path = materialize(large, "edges")
        hung = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(hung.select("u", F.col("m").alias("v")))
        new, new_path = materialize(small.where("u <> v").distinct(), "edges")
        n, before = new.count(), n
        same = n == before and new.join(edges, ["u", "v"], "left_anti").isEmpty()
        for old in (path, large_path):
            remove_path(edges.sparkSession, old)
        edges, path = new, new_path
        if same:
            centres = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres), path


def _bits_apart(a: list[Column], b: list[Column]) -> Column:
    """Population count of the XOR of two sketches."""
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)])


def _classes(docs: DataFrame, key_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(id, hash of the text, n_shingles, component) of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sketch = [f"s{i}" for i in range(WORDS64)]
    # numbers become lasting with the write: of rows here, of classes below
    feats, _ = materialize(features(docs, width).withColumn("row", F.monotonically_increasing_id()), "features")
    sets = feats.where("n_shingles > 0").groupBy("set_a", "set_b").agg(
        F.min("id").alias("least"), F.min("row").alias("row"), *[F.first(c).alias(c) for c in ("bands", *sketch)])
    sets, _ = materialize(sets.withColumn("class", F.monotonically_increasing_id()), "sets")
    # the first of a bucket is the class of the smallest key: an original rather than one of its changed copies
    key = F.coalesce("least", F.lit((1 << 63) - 1))
    buckets, buckets_path = materialize(sets.select(F.col("class").alias("id"), key.alias("key"), F.explode("bands").alias("band")), "buckets")
    # only buckets that hold several classes, and the texts of their members, matter from here on
    heads = buckets.groupBy("band").agg(F.min(F.struct("key", "id")).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
    shared, shared_path = materialize(buckets.drop("key").join(heads.select("band", F.col("first.id").alias("head"), "size"), "band"), "shared")
    members = sets.join(shared.select(F.col("id").alias("class")).distinct(), "class", "left_semi")
    sketches, sketches_path = materialize(members.select(F.col("class").alias("id"), "row", "bands", *sketch), "sketches")
    # one plan at every size: whether few or many members, the texts are dealt by row
    wanted = sketches.select("id", "row")
    texts, texts_path = materialize(feats.select("row", "text").join(wanted.hint("merge"), "row").select("id", "text"), "texts")
    sketches = sketches.drop("row")

    pairs, star_path = materialize(shared.where("id <> head").select("id", "head").distinct(), "star")
    centres = sketches.select(F.col("id").alias("head"), *[F.col(c).alias(f"h{c}") for c in sketch])
    near = pairs.join(sketches.drop("bands"), "id").join(centres, "head")
    near = near.where(_bits_apart([F.col(c) for c in sketch], [F.col(f"h{c}") for c in sketch]) <= FAR)
    links = _confirm(near.select(F.col("id").alias("u"), F.col("head").alias("v")), texts, width, percent)
    label, label_path = components(links)

    known = shared.join(label, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
    known, known_path = materialize(known, "known")
    # per bucket: does it hold several components, how many members are outside the head's
    main = known.where("id = head").select("band", F.col("label").alias("main"))
    odd = known.join(main, "band").where("label <> main").groupBy("band", "main").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("lblocks"))
    sized, open_path = materialize(known.join(odd, "band"), "open")
    fine = fine_sketches(texts.join(sized.select("id").distinct(), "id", "left_semi"), width)
    sized = sized.withColumn("rblocks", F.ceil(F.col("size") / BLOCK).cast("int")).join(sketches.join(fine, "id"), "id")
    sized, sized_path = materialize(sized.withColumn("place", F.array_position("bands", F.col("band")).cast("int")), "sized")
    # members outside the head's component against all others, in blocks of both sides
    cell = lambda blocks, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(blocks)).cast("int")
    others = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    left = sized.where("label <> main").select("*", cell("lblocks", 1).alias("i"), others("rblocks").alias("j"))
    right = sized.select("*", cell("rblocks", 2).alias("j"), others("lblocks").alias("i"))
    both = lambda names: [[F.col(f"{side}.{c}") for c in names] for side in "lr"]
    same = [x == y for x, y in zip(*both(["band", "i", "j"]))]
    close = (_bits_apart(*both(sketch)) <= FAR) & (_bits_apart(*both([f"f{i}" for i in range(FINE64)])) <= FINE_FAR)
    # a pair that shares several buckets counts in the first of them
    first = ~F.arrays_overlap(F.slice("l.bands", F.lit(1), F.col("l.place") - 1), F.col("r.bands"))
    # two members outside the head's component meet on both sides: once is enough
    once = (F.col("r.label") == F.col("r.main")) | (F.col("l.id") < F.col("r.id"))
    met = left.alias("l").join(right.alias("r"), reduce(lambda x, y: x & y, same) & (F.col("l.label") != F.col("r.label"))
                               & once & close & first)
    met = met.select(F.greatest("l.id", "r.id").alias("u"), F.least("l.id", "r.id").alias("v")).distinct()
    more = _confirm(met, texts, width, percent)
    label, last_path = components(links.unionByName(more))
    for path in (buckets_path, shared_path, sketches_path, texts_path, star_path, label_path, known_path, open_path, sized_path):
        remove_path(spark, path)

    # the smallest key of every component, back to the classes and to the rows
    whole = sets.select("set_a", "set_b", "least", "class").join(label.withColumnRenamed("id", "class"), "class", "left")
    whole = whole.select("set_a", "set_b", "least", F.coalesce("component", "class").alias("class"))
    keys = whole.groupBy("class").agg(F.min("least").alias("component"))
    classes, _ = materialize(whole.join(keys, "class").select("set_a", "set_b", "component"), "classes")
    rows = feats.select("id", F.xxhash64("text").alias("text"), "n_shingles", "set_a", "set_b")
    remove_path(spark, last_path)
    linked = rows.where("n_shingles > 0").join(classes, ["set_a", "set_b"]).select("id", "text", "n_shingles", "component")
    alone = rows.where("n_shingles = 0").select("id", "text", "n_shingles", F.col("id").alias("component"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component) per row: the smallest key reachable over links."""
    return _classes(docs, key_col, text_col, width, percent).drop("text")


def keep_first(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the near duplicates of a smaller key.

    Rows without a key stay, and so do rows that repeat a kept key with a text of its component.
    """
    found = _classes(docs.where(F.col(f"`{key_col}`").isNotNull()), key_col, text_col, width, percent)
    gone = found.where("id <> component").select(F.col("id").alias("__gone"), F.col("text").alias("__text")).distinct()
    same = (docs[key_col] == gone["__gone"]) & (F.xxhash64(docs[text_col]) == gone["__text"])
    return docs.join(gone.hint("merge"), same, "left_anti")  # one plan at every size


def dedup_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns (4-word shingles, similarity 0.8); a row without key is kept where its component has none."""
    found = near_duplicates(docs, width=4, percent=80)
    kept = F.coalesce(F.col("id") == F.col("component"), F.col("component").isNull())
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))
