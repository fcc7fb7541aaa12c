"""Spark session and cluster-safety helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; they are set only where the session does not
# already define them, so a cluster's own configuration always wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: the planner's static estimate is off,
    # AQE converts a join to broadcast once the shuffled side is known small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str = "ipcforge", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Builder used by tests, the bench and command-line runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    running = SparkSession.getActiveSession()
    if running is None:
        b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = b.getOrCreate()
    # set by the cluster, by spark-submit or by the user of a running session
    given = {k for k, _ in spark.sparkContext.getConf().getAll()} | set(_set_in_session(spark))
    for k, v in DEFAULT_CONF.items():
        if k not in given:
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    ensure_checkpoint_dir(spark)
    return spark


def _set_in_session(spark: SparkSession) -> list[str]:
    """SQL settings that this session has a value of its own for."""
    return [r["key"] for r in spark.sql("SET").collect()]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint directory: ``spark.checkpoint.dir`` from the session.

    A cluster names a shared folder there; only when it is unset (tests,
    local runs) a private scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # Executors cannot share a machine-local folder: a lost executor's
            # checkpoint files would be lost with it.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) on a cluster")
        configured = tempfile.mkdtemp(prefix="ipcforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *[p.strip("/") for p in parts]])


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialize ``df`` as a parquet table in the shared checkpoint folder.

    Used for tables that later plans read more than once.  The write runs
    the plan once (task retries are handled by the output committer, so it
    survives executor loss; never ``localCheckpoint``) and the re-reads get
    column pruning and filter pushdown, which an RDD checkpoint does not:
    the month-set pass of the split reads one column, not the whole table.
    """
    return materialize(df, name)[0]


def materialize(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """:func:`cut_lineage` that also returns the table's path (for :func:`remove_path`)."""
    spark = df.sparkSession
    path = shared_path(spark, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _written.append(path)
    return spark.read.parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table once no plan reads it any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _written:
        _written.remove(path)


# Intermediate tables of this process that are still there.  A query returns a
# plan that reads its tables, so only the caller knows when they can go.
_written: list[str] = []


def release_tables(spark: SparkSession) -> int:
    """Delete all intermediate tables written by this process; call it when no plan reads them any more."""
    paths = list(_written)
    for path in paths:
        remove_path(spark, path)
    return len(paths)
