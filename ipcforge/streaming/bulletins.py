"""Incremental preparation: new monthly archives -> wide rows, as a stream.

``readStream`` over the archive folder (``binaryFile``, only the ``path``
column, so archive bytes are not loaded by the source) picks up every new
``*.zip`` once; each micro-batch goes through the same operators as the
batch job (range listing -> spread -> read + parse -> join with the
suggestion table -> wide rows).
The sink is ``foreachBatch`` writing each epoch to its own folder with
overwrite, so a retried epoch rewrites the same files (idempotent) and the
stream's progress lives in a checkpoint under the session's shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.wide import build_wide, encode_wide
from ..session import materialize, remove_path, shared_path
from ..sources.files import archive_ranges, read_archive_documents

# Fixed value: the schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def archive_stream(spark: SparkSession, pub_dir: str, max_files_per_trigger: int = 4) -> DataFrame:
    """Streaming (bulletin_code, path) of ``<pub_dir>/YYYYMM.zip`` files as they arrive."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", "*.zip")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(pub_dir)
    )
    code = F.regexp_extract("path", r"/(\d{6})\.zip$", 1)
    return files.select(code.alias("bulletin_code"), "path").where(F.col("bulletin_code") != "")


def _process_batch(lst: DataFrame, out_path: str, lst_prefix: str, partitions: int, encode: bool):
    def run(batch: DataFrame, epoch_id: int) -> None:
        docs, path = materialize(read_archive_documents(archive_ranges(batch), partitions), "parsed_docs")
        try:
            wide = build_wide(docs, lst, lst_prefix)
            out = encode_wide(wide) if encode else wide
            out.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")
        finally:
            remove_path(batch.sparkSession, path)

    return run


def start_prep_stream(spark: SparkSession, pub_dir: str, lst: DataFrame, out_path: str,
                      name: str = "bulletin_prep", lst_prefix: str = "lst/", available_now: bool = True,
                      partitions: int | None = None, encode: bool = True) -> StreamingQuery:
    """Start the incremental prep; ``lst`` is the compacted (application_key, ai_line) table."""
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = (
        archive_stream(spark, pub_dir)
        .writeStream.queryName(name)
        .option("checkpointLocation", shared_path(spark, "streams", name))
        .foreachBatch(_process_batch(lst, out_path, lst_prefix, n, encode))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_stream_output(spark: SparkSession, out_path: str) -> DataFrame:
    """All wide rows written so far by the stream (one folder per epoch)."""
    return spark.read.option("basePath", out_path).parquet(f"{out_path.rstrip('/')}/epoch=*").drop("epoch")
