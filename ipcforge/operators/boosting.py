"""M2-M4: gradient-boosted regression trees on weighted feature cells.

Features are quantised once, and rows that fall into the same bins become one
cell with its number of rows, sum and sum of squares of the target.  For
squared loss a cell is as good as its rows, so growing the trees costs the same
however many rows there are, up to the number of different cells.

All candidates grow in one barrier stage over few partitions: every task
keeps its cells in memory, and per level all tasks exchange the sums per
(node, feature, bin) through files of the shared checkpoint folder (:class:`FileExchange`; a barrier call
waits a whole second, and a tree needs one per level) and choose the same splits from the totals.  Validation cells
are routed along, so the error of every prefix of trees comes with them.  After
``TREES_PER_STAGE`` trees the stage ends and the trees go to the driver (their size
does not depend on the data); the next stage starts from them, so a lost
executor costs at most one stage.  The stage needs ``partitions`` free slots at once.

Boosting follows Spark ML's squared loss: the first tree fits the target and
counts fully, each later tree fits twice the residual and counts with the learning rate.
"""

from __future__ import annotations

import base64
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, keyword_only
from pyspark.ml import Model
from pyspark.ml.param.shared import HasLabelCol, HasMaxIter, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove_path, shared_path
from ..sources import files
from .target_stats import encode_with

BINS = 64
CELLS_PER_TASK = 50_000
TREES_PER_STAGE = 250
_NONE = -1


# ---------------------------------------------------------------- quantisation


def feature_borders(train: DataFrame, features: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """At most ``bins - 1`` ascending borders per feature: approximate quantiles of the training rows, in one pass."""
    shares = [i / bins for i in range(1, bins)]
    row = train.agg(*[F.percentile_approx(F.col(c).cast("double"), shares).alias(c) for c in features]).first()
    return {c: sorted(set(row[c] or [])) for c in features}


def bin_of(column: Column, borders: list[float]) -> Column:
    """Number of borders below the value (NaN: all of them)."""
    if not borders:
        return F.lit(0)
    x = column.cast("double")
    return F.size(F.filter(F.array(*[F.lit(float(b)) for b in borders]), lambda b: b < x))


def feature_cells(train: DataFrame, val: DataFrame, features: list[str], target: str) -> DataFrame:
    """One row per combination of bins: rows, sum of the target in training; rows, sum and sum of squares in validation."""
    y = F.col(target).cast("double")
    names = ["w", "s", "vw", "vs", "vq"]

    def side(df: DataFrame, mine: list[str]) -> DataFrame:
        values = {"w": F.count(target), "s": F.sum(y), "vw": F.count(target), "vs": F.sum(y), "vq": F.sum(y * y)}
        cells = df.where(F.col(target).isNotNull()).groupBy(*features).agg(*[values[m].cast("double").alias(m) for m in mine])
        return cells.select(*features, *[F.col(m) if m in mine else F.lit(0.0).alias(m) for m in names])

    both = side(train, ["w", "s"]).unionByName(side(val, ["vw", "vs", "vq"]))
    return both.groupBy(*features).agg(*[F.sum(m).alias(m) for m in names])


# ---------------------------------------------------------------- trees


@dataclass
class TreeConfig:
    """One candidate: which of the cells' features it sees, depth and learning rate."""

    features: list[int]
    depth: int
    rate: float


@dataclass
class Trees:
    """Binary trees as arrays (trees x nodes); the children of node i are 2i+1 and 2i+2; feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    rate: float
    errors: list[float] = field(default_factory=list)  # validation error of every prefix

    @classmethod
    def none(cls, cfg: TreeConfig) -> Trees:
        n = (1 << (cfg.depth + 1)) - 1
        return cls(np.zeros((0, n), np.int16), np.zeros((0, n), np.int16), np.zeros((0, n)), cfg.rate)

    def __len__(self) -> int:
        return len(self.feature)

    def weight(self, tree: int) -> float:
        return 1.0 if tree == 0 else self.rate

    def prefix(self, n: int) -> Trees:
        return Trees(self.feature[:n], self.bin[:n], self.value[:n], self.rate, self.errors[:n])

    def add(self, feature: np.ndarray, bin: np.ndarray, value: np.ndarray, error: float) -> None:
        self.feature = np.vstack([self.feature, feature])
        self.bin = np.vstack([self.bin, bin])
        self.value = np.vstack([self.value, value])
        self.errors.append(error)

    def leaf_values(self, tree: int, bins: np.ndarray) -> np.ndarray:
        """Value of one tree for rows of bins (n x features)."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        feature, cut = self.feature[tree], self.bin[tree]
        for _ in range(int(np.log2(len(feature) + 1)) - 1):
            f = feature[at]
            inner = f != _NONE
            if not inner.any():
                break
            right = bins[rows, np.where(inner, f, 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return self.value[tree][at]

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """Sum over all trees; equal rows of bins are computed once."""
        different, place = np.unique(bins, axis=0, return_inverse=True)
        out = np.zeros(len(different))
        for t in range(len(self)):
            out += self.weight(t) * self.leaf_values(t, different)
        return out[place.reshape(-1)]


def best_splits(hist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, bin, marks, values) per node for sums (node, feature, bin, [rows, target]).

    The split with the greatest fall of variance, the first of equal ones;
    unmarked nodes have none.  ``values`` is the mean of (node, left, right).
    """
    left = hist.cumsum(axis=2)
    whole = left[:, :1, -1:, :]
    right = whole - left
    ok = (left[..., 0] > 0.5) & (right[..., 0] > 0.5)  # whole numbers of rows

    def part(x: np.ndarray) -> np.ndarray:
        return x[..., 1] ** 2 / np.where(x[..., 0] > 0.5, x[..., 0], 1.0)

    base = part(whole)
    gain = np.where(ok, part(left) + part(right) - base, -np.inf).reshape(len(hist), -1)
    at = gain.argmax(axis=1)
    rows = np.arange(len(hist))
    marks = gain[rows, at] > 1e-12 * np.maximum(base.reshape(-1), 1.0)
    f, b = np.divmod(at, hist.shape[2])

    def mean(x: np.ndarray) -> np.ndarray:
        return x[:, 1] / np.where(x[:, 0] > 0.5, x[:, 0], 1.0)

    return f, b, marks, np.stack([mean(whole[:, 0, 0]), mean(left[rows, f, b]), mean(right[rows, f, b])])


class Grower:
    """Cells of one task and the state of all candidates over them."""

    def __init__(self, bins: np.ndarray, sums: np.ndarray, width: int, configs: list[TreeConfig], trees: list[Trees], exchange):
        order = np.lexsort(bins.T[::-1]) if len(bins) else np.zeros(0, np.int64)  # the same whatever order they came in
        self.bins, sums = bins[order], sums[order]
        self.w, self.s, self.vw, self.vs, self.vq = sums.T
        self.columns = [np.ascontiguousarray(self.bins[:, f], np.int64) for f in range(bins.shape[1])]
        self.width, self.configs, self.trees, self.exchange = width, configs, trees, exchange
        self.now = [t.predict(self.bins) for t in trees]

    def histogram(self, cfg: TreeConfig, node: np.ndarray, nodes: int, target: np.ndarray) -> np.ndarray:
        """(node, feature, bin, [rows, target]) of the cells; node -1 is not counted."""
        out = np.zeros((nodes, len(cfg.features), self.width, 2))
        live = np.flatnonzero((node >= 0) & (self.w > 0))
        base, w, t = node[live] * self.width, self.w[live], target[live]
        for i, f in enumerate(cfg.features):
            key = base + self.columns[f][live]
            size = nodes * self.width
            out[:, i, :, 0] = np.bincount(key, w, size).reshape(nodes, -1)
            out[:, i, :, 1] = np.bincount(key, t, size).reshape(nodes, -1)
        return out

    def grow(self) -> None:
        """One more tree for every candidate."""
        n = len(self.w)
        grown = []
        for cfg, trees, now in zip(self.configs, self.trees, self.now):
            size = (1 << (cfg.depth + 1)) - 1
            target = self.s if not len(trees) else 2 * (self.s - self.w * now)
            grown.append({"target": target, "feature": np.full(size, _NONE), "bin": np.zeros(size, np.int64), "value": np.zeros(size),
                          "place": np.zeros(n, np.int64), "open": np.zeros(1, np.int64)})
        for level in range(max(c.depth for c in self.configs)):
            active = [(c, g) for c, g in zip(self.configs, grown) if level < c.depth and len(g["open"])]
            if not active:
                break
            hists, slots = [], []
            for cfg, g in active:
                slot_of = np.full(len(g["feature"]), -1)
                slot_of[g["open"]] = np.arange(len(g["open"]))
                slots.append(slot_of[g["place"]])
                hists.append(self.histogram(cfg, slots[-1], len(g["open"]), g["target"]))
            for (cfg, g), slot, hist in zip(active, slots, self.exchange(hists)):
                f, b, marks, values = best_splits(hist)
                g["value"][g["open"]] = values[0]
                f = np.array(cfg.features)[f]
                for i in np.flatnonzero(marks):
                    node = g["open"][i]
                    g["feature"][node], g["bin"][node] = f[i], b[i]
                    g["value"][2 * node + 1], g["value"][2 * node + 2] = values[1, i], values[2, i]
                moving = np.flatnonzero((slot >= 0) & marks[slot])
                node = g["place"][moving]
                right = self.bins[moving, g["feature"][node]] > g["bin"][node]
                g["place"][moving] = 2 * node + 1 + right
                split = g["open"][marks]
                g["open"] = np.sort(np.concatenate([2 * split + 1, 2 * split + 2]))
        errors = []
        for i, (g, trees) in enumerate(zip(grown, self.trees)):
            self.now[i] = self.now[i] + trees.weight(len(trees)) * g["value"][g["place"]]
            now = self.now[i]
            errors.append(np.array([(self.vw * now * now - 2 * now * self.vs + self.vq).sum(), self.vw.sum()]))
        for g, trees, (sse, count) in zip(grown, self.trees, self.exchange(errors)):
            trees.add(g["feature"], g["bin"], g["value"], float(sse / count) if count else float("nan"))


class FileExchange:
    """Every task's bytes for every task of a barrier stage, as files of a folder that all of them see.

    The first step is a barrier call, which starts all tasks together and gives an attempt of the stage
    a folder of its own.  A file appears whole; who has read a step of all tasks knows that all have read
    the step before it, so that one's own file of that step goes.
    """

    def __init__(self, context: BarrierTaskContext, folder: str, store: dict[str, str]):
        self.mine, self.step = context.partitionId(), 0
        names = context.allGather(uuid.uuid4().hex)
        self.parts = len(names)
        self.fs, base = files.filesystem_of(folder, store)
        self.base = f"{base}/{names[0]}"
        self.fs.create_dir(self.base, recursive=True)

    def _path(self, step: int, part: int) -> str:
        return f"{self.base}/{step}-{part}"

    def all_of(self, data: bytes) -> list[bytes]:
        """The tasks' bytes of this step, in the tasks' order."""
        path = self._path(self.step, self.mine)
        whole = path if self.fs.type_name == "s3" else f"{path}.part"  # an object is whole when it is seen
        with self.fs.open_output_stream(whole) as out:
            out.write(data)
        if whole != path:
            self.fs.move(whole, path)
        found = [data if p == self.mine else self._wait(self._path(self.step, p)) for p in range(self.parts)]
        if self.step:
            self.fs.delete_file(self._path(self.step - 1, self.mine))
        self.step += 1
        return found

    def _wait(self, path: str) -> bytes:
        """A file's bytes once it is there; if its task fails, Spark ends this one with the stage."""
        pause = 0.0005
        while True:
            try:
                with self.fs.open_input_stream(path) as fh:
                    return fh.read()
            except FileNotFoundError:
                time.sleep(pause)
                pause = min(pause * 1.5, 0.05)


def _exchange_over(context: BarrierTaskContext, parts: int, folder: str | None = None, store: dict[str, str] | None = None):
    """Totals over all tasks of a list of arrays, added in the tasks' order; without a folder by barrier calls."""
    if parts == 1:
        return lambda arrays: arrays
    if folder is None:
        gather = lambda data: [base64.b64decode(m) for m in context.allGather(base64.b64encode(data).decode())]
    else:
        gather = FileExchange(context, folder, store or {}).all_of

    def exchange(arrays: list[np.ndarray]) -> list[np.ndarray]:
        flat = np.concatenate([a.ravel() for a in arrays])
        total = np.zeros_like(flat)
        for m in gather(flat.tobytes()):
            total += np.frombuffer(m)
        cut = np.cumsum([a.size for a in arrays])[:-1]
        return [t.reshape(a.shape) for t, a in zip(np.split(total, cut), arrays)]

    return exchange


def _exchange_folder(spark, store: dict[str, str]) -> str | None:
    """A new folder for a growth's exchanges, or None where tasks cannot open the checkpoint folder's file system."""
    folder = files._qualified(spark, shared_path(spark, "exchange", uuid.uuid4().hex))[0]
    try:
        files.filesystem_of(folder, store)
    except (OSError, ValueError):
        return None
    return folder


_TREE_ROWS = "candidate int, tree int, feature array<int>, bin array<int>, value array<double>, error double"


def grow_trees(cells: DataFrame, features: list[str], configs: list[TreeConfig], max_iter: int, partitions: int,
               bins: int = BINS, per_stage: int = TREES_PER_STAGE, enough=None) -> list[Trees]:
    """All candidates' trees over a table of cells; ``enough(trees)`` may end the growth between stages."""
    spread = cells.repartition(partitions, *features)
    models = [Trees.none(c) for c in configs]
    names = [f.name for f in spread.schema.fields]
    spark = cells.sparkSession
    store = files.store_settings(spark)
    folder = _exchange_folder(spark, store) if partitions > 1 else None
    while len(models[0]) < max_iter and not (enough and len(models[0]) and all(enough(t) for t in models)):
        rounds = min(per_stage, max_iter - len(models[0]))
        start = models  # a new list per stage: what a task gets

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            context = BarrierTaskContext.get()
            grower = Grower(*arrays_of(list(batches)), bins, configs, start, _exchange_over(context, partitions, folder, store))
            first = len(start[0])
            for _ in range(rounds):
                grower.grow()
            if context.partitionId() == 0:
                rows = [(i, t, trees.feature[t].tolist(), trees.bin[t].tolist(), trees.value[t].tolist(), trees.errors[t])
                        for i, trees in enumerate(grower.trees) for t in range(first, len(trees))]
                types = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                                                 ["candidate", "tree", "feature", "bin", "value", "error"])

        def arrays_of(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
            if not batches:
                return np.zeros((0, len(features)), np.int64), np.zeros((0, 5))
            table = pa.Table.from_batches(batches)
            column = lambda c: table.column(names.index(c)).to_numpy()
            return (np.stack([column(c) for c in features], axis=1).astype(np.int64),
                    np.stack([column(c) for c in ("w", "s", "vw", "vs", "vq")], axis=1))

        found = spread.mapInArrow(run, _TREE_ROWS, barrier=True).collect()  # of the size of the trees
        models = [Trees(t.feature, t.bin, t.value, t.rate, list(t.errors)) for t in models]
        for r in sorted(found, key=lambda r: (r["candidate"], r["tree"])):
            models[r["candidate"]].add(np.array(r["feature"]), np.array(r["bin"]), np.array(r["value"]), r["error"])
    if folder:
        remove_path(spark, folder)
    return models


def kept_trees(errors: list[float], tolerance: float | None) -> int:
    """M3: how many trees stay.

    None keeps all, 0 those up to the lowest validation error; above 0 the count ends
    at the first tree that lowers the lowest error by less than that share of it.
    """
    if tolerance is None:
        return len(errors)
    if not tolerance:
        return int(np.nanargmin(errors)) + 1 if not np.isnan(errors).all() else len(errors)
    best, n = errors[0], 1
    for m, error in enumerate(errors[1:], 2):
        if best - error < tolerance * max(error, 0.01):
            break
        best, n = error, m
    return n


# ---------------------------------------------------------------- the model


class _Writer(MLWriter):
    def __init__(self, model: CellTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={
            "borders": {c: [float(b) for b in v] for c, v in m.borders.items()}, "cats": m.cats, "mean": m.mean, "rate": m.trees.rate})
        t = m.trees
        rows = [(i, t.feature[i].tolist(), t.bin[i].tolist(), t.value[i].tolist(), t.errors[i]) for i in range(len(t))]
        schema = "tree int, feature array<int>, bin array<int>, value array<double>, error double"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/trees")
        if m.cats:
            m.stats.write.parquet(f"{path}/categories")


class _Reader(MLReader):
    def load(self, path: str) -> CellTreesModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r["tree"])
        arrays = [np.array([r[c] for r in rows]) for c in ("feature", "bin", "value")]
        trees = Trees(*arrays, meta["rate"], [r["error"] for r in rows])
        stats = spark.read.parquet(f"{path}/categories") if meta["cats"] else None
        model = CellTreesModel(trees=trees, borders=meta["borders"], cats=meta["cats"], mean=meta["mean"], stats=stats)
        DefaultParamsReader.getAndSetParams(model, meta)
        model._resetUid(meta["uid"])
        return model


class CellTreesModel(Model, HasLabelCol, HasPredictionCol, HasMaxIter, MLReadable, MLWritable):
    """M4: encodes, quantises and scores rows.

    ``borders`` are in the order of the trees' features; a feature named
    ``<c>_ts`` of a categorical ``c`` is its target statistic.  The
    statistics are a table, so a model that was not saved needs the table it was fitted with.
    """

    @keyword_only
    def __init__(self, *, trees: Trees, borders: dict[str, list[float]], cats: list[str], mean: float, stats: DataFrame | None = None):
        super().__init__()
        self.trees, self.borders, self.cats, self.mean, self.stats = trees, borders, cats, mean, stats
        self._setDefault(predictionCol="prediction", labelCol="y", maxIter=1000)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    def predict_bins(self, columns: list[Column]) -> Column:
        """Prediction from the bins of the features, in the order of ``borders``."""
        trees = self.trees

        def score(*bins: pd.Series) -> pd.Series:
            return pd.Series(trees.predict(np.stack([b.to_numpy() for b in bins], axis=1)))

        return F.pandas_udf(score, "double")(*columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = dataset.columns
        df = encode_with(dataset, self.stats, self.cats, self.mean) if self.cats else dataset
        bins = [bin_of(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), b) for c, b in self.borders.items()]
        return df.withColumn(self.getPredictionCol(), self.predict_bins(bins)).select(*[f"`{n}`" for n in names], self.getPredictionCol())
