"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, remove_path  # noqa: F401

# A key counts as hot when it holds at least this share of all rows, so there
# are never more hot keys than its inverse: that bounds every broadcast below.
HOT_SHARE = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_hot(big: DataFrame, small: DataFrame, keys: Sequence[str], weight: str, total: int) -> DataFrame:
    """Inner equi-join of ``big`` with one narrow row per key, safe for hot keys.

    ``weight`` in ``small`` is the number of ``big`` rows of the key and
    ``total`` their sum.  Keys with a ten-thousandth of all rows or more
    (at most ``HOT_SHARE`` of them, whatever the size of the data) are
    broadcast, so their rows stay where they are; all other keys are shuffled
    and none of them can fill a task.
    """
    keys = list(keys)
    is_hot = F.col(weight) * F.lit(HOT_SHARE) >= F.lit(total)
    hot, cold = small.where(is_hot).drop(weight), small.where(~is_hot).drop(weight)
    there = big.join(F.broadcast(hot), keys, "inner")
    rest = big.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, "inner")
    return there.unionByName(rest)


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object kept by a Python worker across tasks (caches, loaded vocabularies).

    Functions of this package are shipped by value, so module globals would be
    rebuilt for every task; the holder lives in ``sys.modules`` instead.
    """
    holder = sys.modules.setdefault("_ipcforge_worker_state", types.ModuleType("_ipcforge_worker_state"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


class RecentCache:
    """A bounded cache in two generations: entries that are not asked for again leave with the older one."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self._old: dict = {}

    def turn(self) -> None:
        """Begin a new generation when the young one is full."""
        if len(self.young) > self.limit:
            self._old, self.young = self.young, {}

    def missing(self, keys: set) -> list:
        """The keys that have no entry; all others are in ``young`` afterwards."""
        young, old, new = self.young, self._old, []
        for key in keys.difference(young):
            if key in old:
                young[key] = old[key]
            else:
                new.append(key)
        return new


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 byte offsets of its rows (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + n + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 19, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``most`` bytes in at most ``rows`` rows (at least one row each)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(n, lo + rows, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def texts(col: pa.Array) -> list[str]:
    """A string column as Python strings (null: empty)."""
    return [t if t is not None else "" for t in col.to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizing mix of 64-bit values (splitmix64 constants), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
