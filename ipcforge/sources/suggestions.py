"""S3: suggestion files ingested as they come, without rewriting the history.

Beside the compacted table of :func:`files.ingest_lst` (the base) lie
batches: the lines of the files that came or changed since, and the listing
(path, modification time, length) of what each batch read.  A call lists the folder,
leaves out what an earlier listing holds, and reads the contents of the rest only.
A batch counts when its listing is complete, so a call that fails is simply repeated.

A file that replaces another of its name gives a newer line for the same application
number; readers take the newest line of the batches, else that of the base.
Only batches are merged at reading, the base is neither scanned for it nor
shuffled when it is bucketed (:class:`Suggestions` goes into the document join as it is).
:func:`compact` folds the batches into a new base from time to time.

A file that is replaced within the resolution of the store's modification times by one
of equal length is not seen as new; a removed file keeps its line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import files

# Beside the base's files; Spark's readers skip names with an underscore.
FOLDER = "_batches"
LISTING = "path string, modificationTime timestamp, length long"
LINES = "application_key string, ai_line string, modified timestamp, path string"
# Paths that one read is given; bounds what the driver holds of a listing.
PATHS_PER_READ = 10_000


@dataclass
class Suggestions:
    """The base table and the newest line per application number of the batches."""

    base: DataFrame
    newer: DataFrame

    def lines(self) -> DataFrame:
        """(application_key, ai_line) of both; the newer line wins."""
        kept = self.base.join(self.newer, "application_key", "left_anti")
        return kept.select("application_key", "ai_line").unionByName(self.newer)


@dataclass
class Ingested:
    batch: int | None  # None: nothing new
    n_files: int


def _path(out_path: str, *parts: str) -> str:
    return "/".join([out_path.rstrip("/"), FOLDER, *parts])


def _batches(spark: SparkSession, out_path: str) -> list[int]:
    """Numbers of the complete batches, ascending."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_path(out_path, "listing"))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [st.getPath() for st in fs.listStatus(root)]
    return sorted(int(p.getName()) for p in found if p.getName().isdigit() and fs.exists(p.suffix("/_SUCCESS")))


def _read(spark: SparkSession, out_path: str, kind: str, schema: str) -> DataFrame:
    paths = [_path(out_path, kind, str(n)) for n in _batches(spark, out_path)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def listing(spark: SparkSession, lst_dir: str) -> DataFrame:
    """(path, modificationTime, length) of all suggestion files; no contents are read."""
    if not files._qualified(spark, lst_dir)[1]:
        return spark.createDataFrame([], LISTING)
    return files.lst_files(spark, lst_dir).select("path", "modificationTime", "length")


def start(spark: SparkSession, lst_dir: str, out_path: str, buckets: int | None = None) -> Suggestions:
    """The first ingest: a base of all files there are, and its listing."""
    # listed before it is read: what comes in between is read again by the next batch
    seen = cut_lineage(listing(spark, lst_dir), "listing")
    files.write_lines(spark, files.scan_lst(spark, lst_dir), out_path, buckets,
                      beside=lambda staged: seen.write.parquet(_path(staged, "listing", "0")))
    return read(spark, out_path)


def _in_parts(paths: Iterator, size: int) -> Iterator[list[str]]:
    while part := [r["path"] for r in islice(paths, size)]:
        yield part


def ingest_new(spark: SparkSession, lst_dir: str, out_path: str) -> Ingested:
    """Read the files that no batch has read in their present state, as one more batch."""
    done = _batches(spark, out_path)
    if not done:
        raise ValueError(f"{out_path} holds no suggestion table that was started with its listing")
    new = listing(spark, lst_dir).join(_read(spark, out_path, "listing", LISTING), ["path", "modificationTime", "length"], "left_anti")
    new = cut_lineage(new, "listing")
    count = new.count()
    if not count:
        return Ingested(None, 0)
    batch, (base, _) = done[-1] + 1, files._qualified(spark, lst_dir)
    target = _path(out_path, "lines", str(batch))
    mode = "overwrite"  # what a failed call left
    for paths in _in_parts(new.select("path").toLocalIterator(), PATHS_PER_READ):
        # characters that a reader would take for a pattern stand for themselves
        plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
        rows = spark.read.format("binaryFile").load(plain).select(
            files.key_of_lst(base).alias("application_key"), files.line_of_lst().alias("ai_line"),
            F.col("modificationTime").alias("modified"), "path")
        rows.write.mode(mode).parquet(target)
        mode = "append"
    new.write.mode("overwrite").parquet(_path(out_path, "listing", str(batch)))
    return Ingested(batch, count)


def read(spark: SparkSession, out_path: str) -> Suggestions:
    """Base (bucketed if it was written so) and batches."""
    try:
        base = files.lst_table(spark, out_path)
    except ValueError:  # without buckets
        base = spark.read.parquet(out_path)
    lines = _read_lines(spark, out_path)
    newest = F.max_by("ai_line", F.struct("modified", "path")).alias("ai_line")
    return Suggestions(base, lines.groupBy("application_key").agg(newest))


def _read_lines(spark: SparkSession, out_path: str) -> DataFrame:
    paths = [_path(out_path, "lines", str(n)) for n in _batches(spark, out_path) if n]
    return spark.read.schema(LINES).parquet(*paths) if paths else spark.createDataFrame([], LINES)


def compact(spark: SparkSession, out_path: str) -> Suggestions:
    """A new base of base and batches, in as many buckets as before; the listings become one."""
    try:
        buckets = files._stored_buckets(spark, out_path)
    except ValueError:
        buckets = None
    seen = cut_lineage(_read(spark, out_path, "listing", LISTING).groupBy("path").agg(
        F.max_by(F.struct("modificationTime", "length"), "modificationTime").alias("s")).select("path", "s.*"), "listing")
    files.write_lines(spark, read(spark, out_path).lines(), out_path, buckets,
                      beside=lambda staged: seen.write.parquet(_path(staged, "listing", "0")))
    return read(spark, out_path)
