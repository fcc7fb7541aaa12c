"""Run results and model registry as tables (no tracking server, no polling).

* ``runs``: one row per trained candidate (K3, P14).
* ``versions``: (model_name, model_version, run_id) — a new version per run
  is assigned in the same write as the run (M7); lookup by run id is a join
  (J7).
* ``registry``: (slot, ...) with slots 'champion' and 'previous' (K5, S9).
* ``aliases``: (model_name, alias, model_version) upserted (M8).

All of these tables have a handful of rows per training round; the
operators are still plain aggregates/joins so they work on any history size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# The candidate grid (name, order for ties, depth, rate, parts).
CANDIDATES = [
    ("v1_reg_base", 1, 6, 0.05, True),
    ("v1_reg_shallow", 2, 4, 0.05, True),
    ("v1_reg_no_ipc_parts", 3, 6, 0.05, False),
]
# The alias the promotion points at, and the slot names.
# MODEL_NAME is the default registry name; the jobs take it as an argument.
MODEL_NAME = "ipc_regressor"
ALIAS = "airflow"
CHAMPION, PREVIOUS = "champion", "previous"

RUN_COLUMNS = [
    "candidate_name", "ord", "run_id", "model_name", "model_version", "val_rmse", "val_mae",
    "n_train", "n_val", "model_key", "meta_key", "input_key", "training_last_month_resolved", "months_window",
]


def candidate_config(name: str) -> dict:
    """Hyper-parameters of a named candidate; unknown names are an error."""
    for cand, ord_, depth, rate, parts in CANDIDATES:
        if cand == name:
            return {"name": cand, "ord": ord_, "depth": depth, "learning_rate": rate, "use_ipc_parts": parts}
    raise ValueError(f"no candidate is called {name!r}; known: {[c[0] for c in CANDIDATES]}")


def candidate_grid(spark) -> DataFrame:
    """D4 as a 3-row table."""
    return spark.createDataFrame(
        CANDIDATES, "candidate_name string, ord int, depth int, learning_rate double, use_ipc_parts boolean"
    )


def runs_from_metrics(metrics: DataFrame, input_key: str = "", last_month: str | None = None,
                      months_window: int | None = None, models_prefix: str = "models/",
                      model_name: str = MODEL_NAME, round_id: str | None = None) -> DataFrame:
    """K3: shape per-candidate metrics (candidate_name, ord, val_rmse, val_mae, n_train, n_val) as runs.

    ``round_id`` is new for every training round, so the run ids of two
    rounds over the same data differ.
    """
    name = F.col("candidate_name")
    round_id = round_id or uuid.uuid4().hex
    run_id = F.substr(F.sha2(F.concat_ws("|", F.lit(round_id), name), 256), F.lit(1), F.lit(32))
    return metrics.select(
        name, F.col("ord").cast("int").alias("ord"),
        run_id.alias("run_id"),
        F.lit(model_name).alias("model_name"),
        F.lit(None).cast("string").alias("model_version"),
        F.col("val_rmse").cast("double").alias("val_rmse"),
        F.col("val_mae").cast("double").alias("val_mae"),
        F.col("n_train").cast("long").alias("n_train"),
        F.col("n_val").cast("long").alias("n_val"),
        F.concat(F.lit(models_prefix), F.lit("candidates/"), name).alias("model_key"),
        F.concat(F.lit(models_prefix), F.lit("candidates/"), name, F.lit("_meta.json")).alias("meta_key"),
        F.lit(input_key).alias("input_key"),
        F.lit(last_month).cast("string").alias("training_last_month_resolved"),
        F.lit(months_window).cast("int").alias("months_window"),
    )


def _rmse_order(c: str = "val_rmse") -> Column:
    bad = F.col(c).isNull() | F.isnan(F.col(c))
    return F.struct(bad.alias("bad"), F.col(c).alias("v"), F.col("ord").alias("ord"))


def best_candidate(runs: DataFrame) -> DataFrame:
    """The run with the lowest val_rmse; ties go to the lower ``ord``; NULL/NaN last.

    ``min_by`` is one aggregate (partial per partition), no sort of the runs.
    """
    best = runs.agg(F.min_by(F.struct(*runs.columns), _rmse_order()).alias("b"))
    return best.select("b.*")


def promotion_decision(best: DataFrame, registry: DataFrame, margin: float | str = 0.0) -> DataFrame:
    """Best candidate left-joined to the (zero or one) current champion.

    promote = no champion, or ``new < champion * (1 - margin)`` (strict).
    """
    try:
        m = float(str(margin).strip())
    except ValueError as exc:
        raise ValueError(f"the promotion margin must be a number, not {margin!r}") from exc
    # An aggregate without keys: exactly one row, also if the registry held
    # several champions (the latest promoted one counts) or none.
    latest = F.struct(F.col("promoted_at_utc"), F.col("model_version").cast("int").alias("version"))
    held = F.when(F.col("slot") == CHAMPION, F.struct(F.col("val_rmse"), F.col("candidate_name"), F.col("model_version")))
    champ = registry.agg(
        F.max_by(held, F.when(F.col("slot") == CHAMPION, latest)).alias("c"),
        F.count(F.when(F.col("slot") == CHAMPION, 1)).alias("n_champions"),
    ).select(
        F.col("c.val_rmse").alias("champion_rmse"), F.col("c.candidate_name").alias("champion_name"),
        F.col("c.model_version").alias("champion_version"), "n_champions",
    )
    j = best.join(F.broadcast(champ), F.lit(True), "left")
    threshold = F.col("champion_rmse") * F.lit(1.0 - m)
    no_champ = F.col("n_champions") == 0
    # Spark orders NaN above all numbers; a comparison with NaN is no improvement.
    known = ~F.isnan("val_rmse") & ~F.isnan(threshold)
    better = F.coalesce(known & (F.col("val_rmse") < threshold), F.lit(False))
    promote = F.when(no_champ, F.lit(True)).otherwise(better)
    reason = F.when(no_champ, F.lit("no_current_champion")).otherwise(
        F.format_string("new_rmse=%s threshold=%s", F.col("val_rmse").cast("string"), threshold.cast("string"))
    )
    return j.select(
        *best.columns, "champion_rmse", "champion_name", "champion_version",
        threshold.alias("threshold"), promote.alias("promote"),
        F.when(no_champ, F.lit("no_current_champion")).otherwise(F.lit("threshold")).alias("reason_code"),
        reason.alias("reason"),
    )


def rotate_slots(registry: DataFrame, decision: DataFrame) -> DataFrame:
    """K5: the next registry state (a new table; the current one is never overwritten).

    On promotion: old champion -> 'previous', candidate -> 'champion';
    the old 'previous' survives only when there was no champion.  Without
    promotion the state is unchanged.
    """
    promote = decision.select("promote")
    reg = registry.join(F.broadcast(promote), F.lit(True), "left")
    had_champion = F.max(F.when(F.col("slot") == CHAMPION, 1)).over(Window.partitionBy())
    reg = reg.withColumn("_had_champion", F.coalesce(had_champion, F.lit(0)) == 1)
    kept = reg.where(
        ~F.coalesce(F.col("promote"), F.lit(False))
        | (F.col("slot") == CHAMPION)
        | ((F.col("slot") == PREVIOUS) & ~F.col("_had_champion"))
    ).withColumn(
        "slot",
        F.when(F.coalesce(F.col("promote"), F.lit(False)) & (F.col("slot") == CHAMPION), F.lit(PREVIOUS)).otherwise(F.col("slot")),
    ).drop("promote", "_had_champion")
    cols = registry.columns
    new_champ = decision.where(F.col("promote")).select(
        F.lit(CHAMPION).alias("slot"), "candidate_name", "model_name", "model_version", "run_id", "val_rmse",
        "val_mae", "input_key", F.col("model_key").alias("source_model_key"),
        F.current_timestamp().alias("promoted_at_utc"),
    )
    return kept.select(*cols).unionByName(new_champ.select(*cols))


def check_promotable(decision: DataFrame) -> None:
    """Promotion of a run without a registered version is an error (one-row check)."""
    bad = decision.where(F.col("promote") & F.col("model_version").isNull()).select("candidate_name").take(1)
    if bad:
        raise ValueError(f"{bad[0]['candidate_name']} cannot be promoted: its run is not registered")


def register_versions(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Give every run without a version the next version number of its model.

    next = max(existing) + row_number() in candidate order.  The number is
    looked up by run id among the versions of this write only, so a run id
    that an earlier round used cannot multiply rows; a run that has a version keeps it.
    """
    latest = versions.groupBy("model_name").agg(F.max(F.col("model_version").cast("int")).alias("_max"))
    new = runs.where(F.col("model_version").isNull()).join(latest, "model_name", "left")
    w = Window.partitionBy("model_name").orderBy("ord", "run_id")
    next_version = (F.coalesce(F.col("_max"), F.lit(0)) + F.row_number().over(w)).cast("string")
    return new.withColumn("model_version", next_version).select(*runs.columns).unionByName(
        runs.where(F.col("model_version").isNotNull()))


def set_alias(aliases: DataFrame, decision: DataFrame, alias: str = ALIAS) -> DataFrame:
    """M8: point ``alias`` at the promoted version (upsert: anti-join + union)."""
    new = decision.where(F.col("promote")).select(
        "model_name", F.lit(alias).alias("alias"), "model_version"
    )
    kept = aliases.join(new.select("model_name", "alias"), ["model_name", "alias"], "left_anti")
    return kept.unionByName(new)


def run_metrics_map(runs: DataFrame, train_frac: float = 2.0 / 3.0, seed: int = 42) -> DataFrame:
    """Metric and parameter bundles per run as map columns.

    Parameters: what identifies the run, the split share, the seed, and the
    candidate's configuration.
    """
    known = {c[0]: c for c in CANDIDATES}
    of = lambda i: F.coalesce(*[
        F.when(F.col("candidate_name") == n, F.lit(str(c[i]).lower() if isinstance(c[i], bool) else str(c[i]))) for n, c in known.items()])
    config = {"train_frac": F.lit(str(round(train_frac, 6))), "random_state": F.lit(str(seed)), "depth": of(2),
              "learning_rate": of(3), "use_ipc_parts": of(4)}
    return runs.select(
        "run_id", "candidate_name",
        F.create_map(
            F.lit("val_rmse"), F.col("val_rmse"), F.lit("val_mae"), F.col("val_mae"),
            F.lit("n_train"), F.col("n_train").cast("double"), F.lit("n_val"), F.col("n_val").cast("double"),
        ).alias("metrics"),
        F.create_map(
            F.lit("candidate_name"), F.col("candidate_name"), F.lit("input_key"), F.col("input_key"),
            F.lit("training_last_month_resolved"), F.col("training_last_month_resolved"),
            F.lit("months_window"), F.col("months_window").cast("string"),
            *[x for k, v in config.items() for x in (F.lit(k), v)],
        ).alias("params"),
    )
