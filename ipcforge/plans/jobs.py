"""The three composite jobs: prep -> train -> select.

Each job is a Python function over a ``SparkSession``; the driver only plans
and resolves a handful of scalars (the month to use, the promotion flag).
All data work — unzip, parse, joins, explode, aggregates, model fits — runs
in executor tasks.  State written by a job (datasets, runs, versions,
registry, aliases) is written to new locations and never overwrites a path
that the same plan reads.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import dataset_name
from ..operators import months as month_ops
from ..operators import registry as reg
from ..operators.long import wide_to_long
from ..operators.model import DEFAULT_MAX_ITER, DEFAULT_TOLERANCE, train_candidates
from ..operators.split import split_long
from ..operators.wide import build_wide, encode_wide
from ..session import materialize, remove_path
from ..sources.files import list_object_keys, replace_folder, scan_bulletin_documents, scan_lst
from ..sources.suggestions import Suggestions

RUNS_SCHEMA = (
    "candidate_name string, ord int, run_id string, model_name string, model_version string, "
    "val_rmse double, val_mae double, n_train long, n_val long, model_key string, meta_key string, input_key string, "
    "training_last_month_resolved string, months_window int, n_trees int"
)
REGISTRY_SCHEMA = (
    "slot string, candidate_name string, model_name string, model_version string, run_id string, "
    "val_rmse double, val_mae double, input_key string, source_model_key string, promoted_at_utc timestamp"
)
VERSIONS_SCHEMA = "model_name string, model_version string, run_id string"
ALIASES_SCHEMA = "model_name string, alias string, model_version string"


def _join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *[p.strip("/") for p in parts]])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def resolve_or_raise(available: DataFrame, requested: str, what: str) -> str:
    """the resolved month, or an error that says why there is none."""
    req = available.sparkSession.createDataFrame([(requested,)], "requested string")
    row = month_ops.resolve_month(available, req).first()
    if row["status"] == "no_data":
        raise ValueError(f"there are no {what} to choose a month from")
    if row["status"] == "bad_format":
        raise ValueError(f"the month must be 'last' or six digits, not {requested!r}")
    if row["status"] == "not_found":
        raise ValueError(f"month {requested} is not among the {what}, which go from {row['first_month']} to {row['last_month']}")
    if not re.fullmatch("[0-9]{4}(0[1-9]|1[0-2])", row["resolved"]):
        raise ValueError(f"{row['resolved']} is not a calendar month")
    return row["resolved"]


# ---------------------------------------------------------------- prep


@dataclass
class PrepResult:
    resolved_month: str
    window: list[str]
    output_path: str | None
    rows: int
    good: int = 0
    error: int = 0
    files_found: dict[str, int] = field(default_factory=dict)  # documents per archive of the window, wanted or not


def prep_job(spark: SparkSession, pub_dir: str, lst_source: str | DataFrame | Suggestions, out_dir: str,
             training_last_month: str, months: int, lst_prefix: str = "lst/",
             encode: bool = True) -> PrepResult:
    """O4 -> F1 -> S1/S2 -> D6 -> K1.

    ``lst_source`` is a directory of ``*.LST`` files, an already compacted
    (application_key, ai_line) DataFrame (see ``ingest_lst``) or an ingested store
    (``suggestions.read``).  The dataset is
    written beside its place and moved there when it is complete and has rows;
    a failing or empty run leaves an earlier dataset as it is.
    """
    keys = list_object_keys(spark, pub_dir, "*.zip")
    available = month_ops.list_bulletins(keys, "")
    resolved = resolve_or_raise(available, training_last_month, "bulletin archives")
    start = spark.createDataFrame([(resolved,)], "last_month string")
    window = month_ops.month_window(start, months)
    window_codes = [r["bulletin_code"] for r in window.orderBy("pos").collect()]  # n scalars
    lst = scan_lst(spark, lst_source) if isinstance(lst_source, str) else lst_source
    path = _join(out_dir, dataset_file(spark, resolved, months))
    staged = _join(out_dir, f"_staged-{uuid.uuid4().hex}")
    # The document join reads the documents several times: parse them once.
    docs, docs_path = materialize(scan_bulletin_documents(spark, pub_dir, window), "parsed_docs")
    try:
        # one row per archive of the window
        found = {r["bulletin_code"]: r["count"] for r in docs.groupBy("bulletin_code").count().collect()}
        seen = Observation()  # counted by the write itself
        wide = build_wide(docs, lst, lst_prefix).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("error").isNull(), 1)).alias("good"), F.count("error").alias("error"))
        (encode_wide(wide) if encode else wide).write.parquet(staged)
        counts = seen.get
        n = counts["rows"]
        if n:
            replace_folder(spark, staged, path)
    finally:
        remove_path(spark, docs_path)
        remove_path(spark, staged)
    return PrepResult(resolved, window_codes, path if n else None, n, counts["good"], counts["error"], {c: found.get(c, 0) for c in window_codes})


def dataset_file(spark: SparkSession, last_month: str, months: int) -> str:
    """K2 for one month."""
    return spark.range(1).select(dataset_name(F.lit(last_month), months).alias("n")).first()["n"]


TRAINING_COLUMNS = ["application_number", "bulletin_code", "expert_ipc_canon", "ai_ipc_canon", "ai_scores"]


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """Read a prepared dataset (native or '|'-encoded lists); a missing training column is an error."""
    wide = spark.read.parquet(path)
    missing = [c for c in TRAINING_COLUMNS if c not in wide.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return wide


# ---------------------------------------------------------------- train


def list_folder_keys(spark: SparkSession, base: str) -> DataFrame:
    """Names one level below ``base`` (datasets, not their part files)."""
    p, fs = _fs(spark, base)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return spark.createDataFrame([(n,) for n in names], "key string")


def train_job(spark: SparkSession, data_dir: str, models_dir: str, training_last_month: str, months: int,
              max_iter: int = DEFAULT_MAX_ITER, candidates: list[str] | None = None,
              model_name: str = reg.MODEL_NAME, tolerance: float | None = DEFAULT_TOLERANCE) -> DataFrame:
    """S6/F6 -> S7 -> D1 -> W2 -> P10 -> M1..M6 -> K3/K4/M7.

    One job trains all candidates over one split table written to the shared folder
    (removed after the fits).
    """
    available = month_ops.list_datasets(list_folder_keys(spark, data_dir), "")
    resolved = resolve_or_raise(available, training_last_month, "prepared datasets")
    input_key = _join(data_dir, dataset_file(spark, resolved, months))
    # written once: the split reads it for the months and for the rows
    long, long_path = materialize(wide_to_long(read_wide(spark, input_key)), "long")
    split, split_path = materialize(split_long(long), "split")
    remove_path(spark, long_path)
    try:
        runs = train_candidates(split, max_iter=max_iter, names=candidates, model_dir=models_dir, input_key=input_key,
                                last_month=resolved, months_window=months, tolerance=tolerance, model_name=model_name)
        versions = read_table(spark, _join(models_dir, "versions"), VERSIONS_SCHEMA)
        # a few rows, kept as the job's result: one new folder per round
        runs_path = _join(models_dir, "runs", f"round={uuid.uuid4().hex}")
        reg.register_versions(versions, runs).write.parquet(runs_path)
    finally:
        # The split table is read by every fit and by nothing after them.
        remove_path(spark, split_path)
    runs = spark.read.parquet(runs_path)
    new_versions = runs.select("model_name", "model_version", "run_id")
    write_table(versions.unionByName(new_versions), _join(models_dir, "versions"))
    write_results(runs, _join(models_dir, "results"))
    write_meta(spark, runs)
    return runs


def write_results(runs: DataFrame, results_dir: str) -> None:
    """K3: one JSON result per candidate (a directory per name)."""
    for row in runs.select("candidate_name").collect():  # one row per candidate
        one = runs.where(F.col("candidate_name") == row["candidate_name"])
        one.coalesce(1).write.mode("overwrite").json(_join(results_dir, row["candidate_name"]))


def write_meta(spark: SparkSession, runs: DataFrame) -> None:
    """K3: metrics, parameters and model key of every candidate, one JSON file beside its model."""
    maps = reg.run_metrics_map(runs).join(runs.select("run_id", "meta_key", "model_key", "model_name", "model_version"), "run_id")
    for r in maps.collect():  # one row per candidate
        meta = {k: r[k] for k in ("candidate_name", "run_id", "model_name", "model_version", "model_key")}
        p, fs = _fs(spark, r["meta_key"])
        fh = fs.create(p, True)
        fh.write(bytearray(json.dumps(meta | {"metrics": dict(r["metrics"]), "config": dict(r["params"])}, sort_keys=True).encode()))
        fh.close()


def read_results(spark: SparkSession, results_dir: str, names: list[str] | None = None) -> DataFrame:
    """The named candidates' results; a missing one is an error."""
    names = names or [c[0] for c in reg.CANDIDATES]
    paths = [_join(results_dir, n) for n in names]
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"these candidates have no result yet: {missing}")
    return spark.read.schema(RUNS_SCHEMA).json(paths)


# ---------------------------------------------------------------- versioned tables


def _versions_of(spark: SparkSession, base: str, complete: bool = True) -> list[int]:
    """Version numbers below ``base``, ascending; with ``complete`` False those of crashed writes too."""
    p, fs = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        nm = st.getPath().getName()
        if nm.startswith("v=") and nm[2:].isdigit() and (not complete or fs.exists(st.getPath().suffix("/_SUCCESS"))):
            out.append(int(nm[2:]))
    return sorted(out)


def read_table(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """Latest committed version of a small state table, or an empty table."""
    vs = _versions_of(spark, base)
    if not vs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_join(base, f"v={vs[-1]}"))


# Writers of one table that may take the same number at once.
WRITE_TRIES = 10


def write_table(df: DataFrame, base: str) -> str:
    """Write the next version (never overwrites the version the plan reads); a number taken meanwhile is left to its writer."""
    for _ in range(WRITE_TRIES):
        vs = _versions_of(df.sparkSession, base, complete=False)  # a crashed write keeps its number
        path = _join(base, f"v={(vs[-1] + 1) if vs else 1}")
        try:
            df.write.mode("errorifexists").parquet(path)
            return path
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
    raise OSError(f"no free version number under {base} after {WRITE_TRIES} tries")


# ---------------------------------------------------------------- select


def select_job(spark: SparkSession, models_dir: str, prod_dir: str, margin: str | float = "0.0") -> dict:
    """S8 -> A9 -> S9 -> J6/A11 -> M8 -> K5."""
    runs = read_results(spark, _join(models_dir, "results"))
    best = reg.best_candidate(runs)
    registry = read_table(spark, _join(prod_dir, "registry"), REGISTRY_SCHEMA)
    decision = reg.promotion_decision(best, registry, margin)
    d = decision.first()
    # The keys of the result.
    result = {
        "best_new": {k: d[k] for k in runs.columns},
        "current_champion": None if d["champion_name"] is None else {
            "candidate_name": d["champion_name"], "val_rmse": d["champion_rmse"], "model_version": d["champion_version"],
        },
        "promote": bool(d["promote"]),
        "reason": d["reason"],
    }
    if d["promote"]:
        reg.check_promotable(decision)
        # The candidate folder is rewritten by the next training round, so the
        # promoted model gets its own versioned place.  The alias comes last:
        # whoever follows it finds model and registry in place.
        if not d["model_key"] or not path_exists(spark, d["model_key"]):
            raise FileNotFoundError(f"the model to promote is not at {d['model_key']}")
        from pyspark.ml import PipelineModel

        target = _join(prod_dir, "models", f"{d['model_name']}_v{d['model_version']}")
        PipelineModel.load(d["model_key"]).write().overwrite().save(target)
        PipelineModel.load(target)  # readable, or the promotion ends here
        result["registry_path"] = write_table(reg.rotate_slots(registry, decision), _join(prod_dir, "registry"))
        aliases = read_table(spark, _join(prod_dir, "aliases"), ALIASES_SCHEMA)
        write_table(reg.set_alias(aliases, decision), _join(prod_dir, "aliases"))
        result["promoted_model_key"] = target
    return json.loads(json.dumps(result, default=str))
