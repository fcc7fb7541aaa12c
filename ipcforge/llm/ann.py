"""Approximate nearest neighbours on shifted Hilbert curves.

Equal vectors form one class with their smallest ids.  Several times, the
classes are projected (random orthonormal directions), shifted, and ordered by
their Hilbert key; Spark range-partitions and sorts every ordering, which
gives each class a position.  A query is compared with the classes
within ``window`` positions on every curve: positions are cut into blocks, the
query goes to the blocks that its window touches, and blocks meet queries
in groups of bounded size.  The candidates of all curves merge and are ranked by
their exact inner product.

The window follows the data: for a bounded sample of queries (``SAMPLE``) the true
neighbours are found among all rows, and the window is the ``TARGET`` quantile of
their nearest distance over the curves.  Tightly clustered vectors need
narrow windows; vectors without structure need wide ones, up to the whole
curve, and then the search costs what an exact one costs.

Defined results: null, empty, zero or non-finite vectors take no part,
neither do rows without id; vectors of different length are not compared;
equal scores are ordered by id; repeated rows are separate candidates; fewer
candidates give shorter lists; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_hot, materialize
from .vectors import first_k, usable

CURVES, DIMS, BITS = 4, 6, 10
SAMPLE = 256  # queries on which the window is fitted
TARGET = 0.96  # share of their true neighbours within the window
BLOCK, QUERY_BLOCK = 8192, 1 << 16  # positions


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer cells (n x dims, values below 2**bits).

    The cells' Gray-coded corners are rotated level by level, from the
    coarsest to the finest, then the bits are interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    level = one << np.uint64(bits - 1)
    while level > one:
        below = level - one
        for i in range(dims):
            high = (x[i] & level) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            if i:
                x[i] ^= swap
        level >>= one
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    level = one << np.uint64(bits - 1)
    while level > one:
        flips ^= np.where((x[-1] & level) != 0, level - one, np.uint64(0))
        level >>= one
    x ^= flips
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def projection(curve: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions (length x dims) and shift of a curve."""
    rng = np.random.default_rng([curve, length, 2024])
    directions, _ = np.linalg.qr(rng.normal(size=(length, min(DIMS, length))))
    return directions, rng.uniform(0, 1, directions.shape[1])


def curve_keys(vectors: np.ndarray, curve: int, radius: float) -> np.ndarray:
    directions, shift = projection(curve, vectors.shape[1])
    spread = vectors @ directions * (np.sqrt(vectors.shape[1]) / (8 * radius)) + 0.5  # four deviations each way
    cells = np.clip((spread + shift) / 2, 0, 1 - 2.0 ** -BITS) * (1 << BITS)
    return hilbert_keys(cells, BITS)


def _matrix(col: pa.Array, length: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` best scores, ties to the smaller id; -inf is no score."""
    if scores.shape[1] > k:
        worst = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        rows, cols = np.nonzero((scores >= worst) & (scores > -np.inf))
    else:
        rows, cols = np.nonzero(scores > -np.inf)
    order = np.lexsort((ids[cols], -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, rows)
    keep = np.arange(len(rows)) - first < k
    return rows[keep], cols[keep]


def classes(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """Distinct vectors: two hashes as key, vector, smallest ``k`` + 1 ids, number of queries among its rows."""
    rows = vectors.select("vec_id", "v", F.xxhash64("v").alias("ka"), F.xxhash64(F.lit(1), "v").alias("kb"), is_query.alias("q"))
    some = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(16)))
    for by in (["ka", "kb", "salt"], ["ka", "kb"]):  # hot vectors shrink before their rows meet
        some = first_k(some, by, [F.col("vec_id")], k + 1).drop("place")
    ids = some.groupBy("ka", "kb").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min(F.struct("vec_id", "v"))["v"].alias("v"))
    asked = rows.groupBy("ka", "kb").agg(F.sum(F.col("q").cast("long")).alias("queries"))
    return ids.join(asked, ["ka", "kb"]).select("ka", "kb", F.element_at("ids", 1).alias("cid"), "ids", "v", "queries",
                                                F.size("v").cast("long").alias("length"))


def _ordered(known: DataFrame, radius: float) -> DataFrame:
    """(line, rank, cid, ids, v, queries, length) for every class and curve; a line is a curve over one vector length."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            vectors = batch.column(batch.schema.get_field_index("v"))
            for n in np.unique(length):
                own = pa.array(np.flatnonzero(length == n))
                part, matrix = batch.take(own), _matrix(vectors.take(own), int(n)).astype(np.float64)
                for curve in range(CURVES):
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(np.full(len(matrix), n * CURVES + curve)), pa.array(curve_keys(matrix, curve, radius))],
                        [*part.schema.names, "line", "key"])

    plain = known.select("cid", "ids", "v", "queries", "length")
    keyed = plain.mapInArrow(keys, plain.select("*", F.lit(0).cast("long").alias("line"), F.lit(0).cast("long").alias("key")).schema)
    parts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = keyed.repartitionByRange(parts, "line", "key", "cid").sortWithinPartitions("line", "key", "cid")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen: dict[int, int] = {}
        for batch in batches:
            line = batch.column(batch.schema.get_field_index("line")).to_numpy()
            place = np.empty(len(line), np.int64)
            for one in np.unique(line):
                own = line == one
                place[own] = seen.get(one, 0) + np.arange(own.sum())
                seen[one] = seen.get(one, 0) + int(own.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(line), TaskContext.get().partitionId())), pa.array(place)],
                [*batch.schema.names, "part", "place"])

    schema = in_order.select("*", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("place")).schema
    placed, _ = materialize(in_order.mapInArrow(places, schema), "curves")
    sizes = placed.groupBy("line", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("line", "part", F.coalesce(F.sum("n").over(
        Window.partitionBy("line").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # one row per partition and line, so its size does not follow the data
    return placed.join(F.broadcast(before), ["line", "part"]).select(
        "line", (F.col("before") + F.col("place")).alias("rank"), "cid", "ids", "v", "queries", "length")


def fit_window(known: DataFrame, ranks: DataFrame, k: int, sample: int = SAMPLE, target: float = TARGET) -> int:
    """Positions within which the sample's true neighbours stand on their nearest curve."""
    asked = known.where("queries > 0")
    total = asked.count()
    cut = int(min(1.0, sample / max(total, 1)) * (1 << 30))
    chosen = asked.where(F.pmod(F.xxhash64("cid", F.lit(3)), F.lit(1 << 30)) < cut).select("cid", "v").collect()
    if not chosen:
        return 0
    queries = [(r["cid"], np.array(r["v"], np.float64)) for r in chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, cid = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "cid"))
            vectors = batch.column(batch.schema.get_field_index("v"))
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                mine = [q for q in queries if len(q[1]) == n]
                if mine:
                    scores = np.array([q[1] for q in mine]) @ _matrix(vectors.take(pa.array(own)), int(n)).astype(np.float64).T
                    rows, cols = _top(scores, cid[own], k + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array([q[0] for q in mine])[rows]), pa.array(cid[own][cols]), pa.array(scores[rows, cols])],
                        ["query", "cid", "score"])

    best = first_k(known.select("cid", "v", "length").mapInArrow(run, "query long, cid long, score double"),
                   ["query"], [F.desc("score"), F.asc("cid")], k + 1).select("query", "cid")
    best, _ = materialize(best, "truth")  # sample x (k + 1) rows
    needed = best.select("cid").unionByName(best.select(F.col("query").alias("cid"))).distinct()
    at = {}
    for r in ranks.select("line", "cid", "rank").join(F.broadcast(needed), "cid").collect():
        at.setdefault(r["cid"], {})[r["line"]] = r["rank"]
    gaps = [min(abs(at[r["cid"]][line] - at[r["query"]][line]) for line in at[r["query"]]) for r in best.collect()]
    return int(np.quantile(gaps, target)) + 1


def search(vectors: DataFrame, is_query: Column, k: int = 20, window: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best by inner product among all other rows."""
    vectors = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("v")) & F.exists("v", lambda x: x != 0))
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    known, _ = materialize(classes(vectors, is_query, k), "classes")
    radius = known.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()[0] or 1.0
    ranks = _ordered(known, radius)
    window = fit_window(known, ranks, k) if window is None else window

    here = F.floor(F.col("rank") / BLOCK)
    asked = ranks.where("queries > 0").select(
        F.col("line").alias("qline"), F.col("rank").alias("qrank"), F.col("cid").alias("query"), F.col("v").alias("qv"), F.floor(F.col("rank") / QUERY_BLOCK).alias("qgroup"),
        F.explode(F.sequence(F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / BLOCK), F.floor((F.col("rank") + window) / BLOCK))).alias("qblock"))
    # a block meets the query groups whose windows can touch it
    first = F.floor(F.greatest(here * BLOCK - window, F.lit(0)) / QUERY_BLOCK)
    last = F.floor((here * BLOCK + BLOCK - 1 + window) / QUERY_BLOCK)
    top = ranks.groupBy("line").agg(F.floor(F.max("rank") / QUERY_BLOCK).alias("top"))  # a few rows
    blocks = ranks.join(F.broadcast(top), "line").select(
        "line", "rank", "cid", "ids", "v", here.alias("block"), F.explode(F.sequence(first, F.least(last, F.col("top")))).alias("group"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            length = len(left.column("v")[0])
            rank, cid = left.column("rank").to_numpy(), left.column("cid").to_numpy()
            v = _matrix(left.column("v"), length).astype(np.float64)
            for lo in range(0, right.num_rows, 512):
                part = right.slice(lo, 512)
                scores = _matrix(part.column("qv"), length).astype(np.float64) @ v.T
                scores[np.abs(part.column("qrank").to_numpy()[:, None] - rank[None, :]) > window] = -np.inf
                rows, cols = _top(scores, cid, k + 1)
                out.append(pa.table({"query": part.column("query").take(pa.array(rows)), "cid": pa.array(cid[cols]),
                                     "ids": left.column("ids").take(pa.array(cols)), "score": pa.array(scores[rows, cols])}))
        none = pa.schema([("query", pa.int64()), ("cid", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])
        return pa.concat_tables([t.cast(none) for t in out]) if out else none.empty_table()

    found = blocks.groupBy("line", "block", "group").cogroup(asked.groupBy("qline", "qblock", "qgroup")).applyInArrow(
        compare, "query long, cid long, ids array<long>, score double")
    best = first_k(found.dropDuplicates(["query", "cid"]), ["query"], [F.desc("score"), F.asc("cid")], k + 1)
    lists = best.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list(F.transform(
        "ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("id")))))), 1, k + 1).alias("best"))
    # every query row of a class takes the class's list, without itself
    lists = known.where("queries > 0").select("ka", "kb", "queries", F.col("cid").alias("query")).join(lists, "query").drop("query")
    lists, _ = materialize(lists, "lists")
    rows = vectors.where(is_query).select("vec_id", F.xxhash64("v").alias("ka"), F.xxhash64(F.lit(1), "v").alias("kb"))
    total = lists.agg(F.sum("queries")).first()[0] or 0
    own = join_hot(rows, lists, ["ka", "kb"], "queries", total)
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("vec_id")), 1, k)
    return own.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))


def ann_digest(embeddings: DataFrame) -> DataFrame:
    """The contract's columns: ids divisible by 20 ask for their 20 nearest."""
    vectors = embeddings.select("vec_id", F.col("embedding").alias("v"))
    return search(vectors, F.pmod("vec_id", F.lit(20)) == 0, 20)
