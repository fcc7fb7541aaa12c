"""Incremental preparation where suggestion files may come after their documents.

Two file streams, archives and suggestion files, meet in keyed state: per
application number the state holds the newest line so far and the documents that
wait for one.  A document leaves when its line is there, whichever came first; one that
has waited for ``deadline`` seconds is given up (like a document without a
suggestion in the batch job) and leaves the state.  Documents with a parse error or without an
application number pass at once.

The documents of one application number are dealt over ``salts`` groups and its line
goes to each of them, so a number with very many waiting documents is not one group.
State lives in the stream's checkpoint under ``spark.checkpoint.dir``: a restarted
stream goes on with the documents that wait.  It holds one line per application
number and salt, and what waits.

As with all of Spark's file streams a file is taken once: a suggestion file that is
rewritten under its name is not read again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.wide import encode_wide, route_wide
from ..session import shared_path
from ..sources import files
from ..sources.xmldocs import with_parse_status
from .bulletins import BINARY_FILE_SCHEMA, archive_stream

STATE = "line string, modified double, waiting string"
RELEASED = "document string, ai_line string"
SALTS = 8


def suggestion_stream(spark: SparkSession, lst_dir: str, max_files_per_trigger: int = 10_000) -> DataFrame:
    """Streaming (application_key, ai_line, modified) of suggestion files as they arrive."""
    base, _ = files._qualified(spark, lst_dir)
    found = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*" + files.LST_SUFFIX)
             .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files_per_trigger).load(lst_dir))
    return found.select(files.key_of_lst(base).alias("application_key"), files.line_of_lst().alias("ai_line"),
                        F.col("modificationTime").cast("double").alias("modified"))


def _release(deadline: float):
    """The state function: (key, salt) -> documents that have their line."""

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        line, modified, held = state.get if state.exists else (None, -1.0, "[]")
        now = time.time()
        waiting = [(d, until) for d, until in json.loads(held) if until > now]
        ready = []
        if not state.hasTimedOut:
            for pdf in pdfs:
                for document, passes, text, at in zip(pdf["document"], pdf["passes"], pdf["ai_line"], pdf["modified"]):
                    if document is None:
                        if at >= modified:
                            line, modified = text, at
                    elif passes:
                        ready.append((document, None))
                    else:
                        waiting.append((document, now + deadline))
        if line is not None:
            ready += [(d, line) for d, _ in waiting]
            waiting = []
        if line is None and not waiting:
            if state.exists:
                state.remove()
        else:
            state.update((line, modified, json.dumps(waiting)))
            if waiting:
                state.setTimeoutDuration(max(1, int((min(u for _, u in waiting) - now) * 1000)))
        if ready:
            yield pd.DataFrame(ready, columns=["document", "ai_line"])

    return run


def release_documents(docs: DataFrame, lines: DataFrame, deadline: float, salts: int = SALTS) -> DataFrame:
    """Streaming documents (with parse status) joined to their line, as soon as both are there."""
    n_salts = F.lit(salts)
    passes = F.col("doc_status") != "ok"
    names = ["application_key", "salt", "document", "passes", "ai_line", "modified"]
    left = docs.select(
        # a key of its own for what waits for nothing
        F.when(passes, F.concat(F.lit("\x00"), F.xxhash64("bulletin_code", "source_file").cast("string")))
        .otherwise(F.col("application_key")).alias("application_key"),
        F.pmod(F.xxhash64("source_file"), n_salts).cast("int").alias("salt"),
        F.to_json(F.struct(*docs.columns)).alias("document"), passes.alias("passes"),
        F.lit(None).cast("string").alias("ai_line"), F.lit(None).cast("double").alias("modified"))
    right = lines.select("application_key", F.explode(F.sequence(F.lit(0), n_salts - 1)).alias("salt"),
                         F.lit(None).cast("string").alias("document"), F.lit(False).alias("passes"), "ai_line", "modified")
    met = left.select(*names).unionByName(right.select(*names)).groupBy("application_key", "salt").applyInPandasWithState(
        _release(deadline), RELEASED, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
    return met.select(F.from_json("document", docs.schema.simpleString()).alias("d"), "ai_line").select("d.*", "ai_line")


def start_late_stream(spark: SparkSession, pub_dir: str, lst_dir: str, out_path: str, deadline: float,
                      name: str = "late_prep", lst_prefix: str = "lst/", available_now: bool = True,
                      partitions: int | None = None, salts: int = SALTS, encode: bool = True) -> StreamingQuery:
    """Start the preparation; ``deadline`` is in seconds.  Output is one folder per epoch (``bulletins.read_stream_output``)."""
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = with_parse_status(files.read_archive_documents(files.archive_ranges(archive_stream(spark, pub_dir)), n))
    joined = release_documents(docs, suggestion_stream(spark, lst_dir), deadline, salts)

    def write(batch: DataFrame, epoch_id: int) -> None:
        wide = route_wide(batch, lst_prefix)
        (encode_wide(wide) if encode else wide).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")

    # Timeouts are looked at with the next files: without data there is no further batch, so a query that takes what there is ends.
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    writer = (joined.writeStream.queryName(name).outputMode("append")
              .option("checkpointLocation", shared_path(spark, "streams", name)).foreachBatch(write))
    if not available_now:
        return writer.trigger(processingTime="1 minute").start()
    try:
        spark.conf.set(setting, "false")  # the query keeps the settings it started with
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(setting, before)
