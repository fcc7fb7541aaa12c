"""M1-M6, K4: candidate regressors.

Gradient-boosted trees (squared loss) on the long table's features.  The
categorical code parts become ordered target statistics (:mod:`target_stats`), all
features are quantised once, and the trees of all candidates grow together on
the weighted feature cells (:mod:`boosting`).  A fit grows ``max_iter`` trees and
keeps the prefix of them with the lowest squared error on the validation rows; nothing
is fitted twice.  Only a caller who gives a ``tolerance`` above 0 lets the growth end earlier.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, remove_path
from . import boosting, target_stats
from .features import feature_columns, fill_features, project_features
from .metrics import error_metrics
from .registry import CANDIDATES, MODEL_NAME, candidate_config, runs_from_metrics

# The most trees a fit may grow, the training library's own default; callers may lower it.
DEFAULT_MAX_ITER = 1000
# Share of the validation error by which a further tree must lower it; 0: the growth does not end early.
DEFAULT_TOLERANCE = 0.0


def _partitions(cells: int, session) -> int:
    """Tasks that grow the trees: all run at once, so never more than the session has slots for."""
    return max(1, min(session.sparkContext.defaultParallelism, -(-cells // boosting.CELLS_PER_TASK)))


def train_models(train: DataFrame, val: DataFrame, configs: list[dict], max_iter: int = DEFAULT_MAX_ITER, target: str = "y",
                 tolerance: float | None = DEFAULT_TOLERANCE, bins: int = boosting.BINS,
                 partitions: int | None = None) -> list[tuple[PipelineModel, dict]]:
    """M1+M2+M3+M4+M5: fit all candidates over one table of cells and evaluate each on the validation rows.

    ``tolerance`` 0 grows ``max_iter`` trees and keeps the best prefix, None keeps all of them.
    """
    spark = train.sparkSession
    num, cats = feature_columns(any(c["use_ipc_parts"] for c in configs))
    prepare = lambda df: fill_features(project_features(df, bool(cats), target))
    train, val = prepare(train), prepare(val)
    head = train.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(target).cast("double")).alias("mean")).first()
    mean = float(head["mean"] or 0.0)
    stats, written = None, []
    if cats:
        stats, _ = materialize(target_stats.category_stats(train, cats, target), "categories")  # the model reads it
        train = target_stats.ordered_stats(train, cats, target, mean, head["rows"])
        val = target_stats.encode_with(val, stats, cats, mean)
    features = num + [f"{c}_ts" for c in cats]
    train, path = materialize(train.select(*features, target), "encoded")
    written.append(path)
    borders = boosting.feature_borders(train, features, bins)
    binned = lambda df: df.select(*[boosting.bin_of(F.col(c), borders[c]).alias(c) for c in features], target)
    val, path = materialize(binned(val), "validation")
    written.append(path)
    cells, path = materialize(boosting.feature_cells(binned(train), val, features, target), "cells")
    written.append(path)
    n_features = [len(feature_columns(c["use_ipc_parts"])[0]) + (len(cats) if c["use_ipc_parts"] else 0) for c in configs]
    # the features of a candidate without code parts come first
    trees = boosting.grow_trees(
        cells, features, [boosting.TreeConfig(list(range(n)), int(c["depth"]), float(c["learning_rate"])) for n, c in zip(n_features, configs)],
        max_iter, partitions or _partitions(cells.count(), spark), bins,
        enough=(lambda t: boosting.kept_trees(t.errors, tolerance) < len(t)) if tolerance else None)
    out = []
    for cfg, n, grown in zip(configs, n_features, trees):
        own = cats if cfg["use_ipc_parts"] else []
        model = boosting.CellTreesModel(trees=grown.prefix(boosting.kept_trees(grown.errors, tolerance)),
                                        borders={c: borders[c] for c in features[:n]}, cats=own, mean=mean, stats=stats if own else None)
        model._set(labelCol=target, maxIter=int(max_iter))
        pred = val.select(target, model.predict_bins([F.col(c) for c in features[:n]]).alias("prediction"))
        m = error_metrics(pred, label=target, prediction="prediction").first()
        out.append((PipelineModel([model]), {
            "val_rmse": float(m["val_rmse"]) if m["val_rmse"] is not None else float("nan"),
            "val_mae": float(m["val_mae"]) if m["val_mae"] is not None else float("nan"),
            "n_val": int(m["n_rows"]),
            "n_trees": model.getNumTrees,
        }))
    for path in written:
        remove_path(spark, path)
    return out


def train_regressor(train: DataFrame, val: DataFrame, cfg: dict, max_iter: int = DEFAULT_MAX_ITER,
                    target: str = "y", tolerance: float | None = DEFAULT_TOLERANCE) -> tuple[PipelineModel, dict]:
    """:func:`train_models` for one candidate."""
    return train_models(train, val, [cfg], max_iter, target, tolerance)[0]


def train_candidates(split: DataFrame, max_iter: int = DEFAULT_MAX_ITER, names: list[str] | None = None,
                     model_dir: str | None = None, input_key: str = "", last_month: str | None = None,
                     months_window: int | None = None, target: str = "y", tolerance: float | None = DEFAULT_TOLERANCE,
                     model_name: str = MODEL_NAME) -> DataFrame:
    """M6: the same split data, all candidate configurations in one fit, one run row each.

    ``split`` should be materialized by the caller (checkpoint or written
    table) because it is read more than once.  Models are saved under
    ``model_dir/<candidate>`` when given (K4).
    """
    spark = split.sparkSession
    train = split.where(F.col("split") == "train")
    val = split.where(F.col("split") == "val")
    counts = split.groupBy("split").count().collect()
    n = {r["split"]: int(r["count"]) for r in counts}
    if not n.get("train"):
        raise ValueError("training split is empty (fewer than two months of data?)")
    if not n.get("val"):
        raise ValueError("validation split is empty")
    prefix = (model_dir.rstrip("/") + "/") if model_dir else "models/"
    configs = [candidate_config(name) for name in names or [c[0] for c in CANDIDATES]]
    rows = []
    for cfg, (model, metrics) in zip(configs, train_models(train, val, configs, max_iter, target, tolerance)):
        if model_dir:
            model.write().overwrite().save(f"{prefix}candidates/{cfg['name']}")
        rows.append((cfg["name"], cfg["ord"], metrics["val_rmse"], metrics["val_mae"], n["train"], n["val"], metrics["n_trees"]))
    metrics_df = spark.createDataFrame(
        rows, "candidate_name string, ord int, val_rmse double, val_mae double, n_train long, n_val long, n_trees int"
    )
    runs = runs_from_metrics(metrics_df, input_key=input_key, last_month=last_month,
                             months_window=months_window, models_prefix=prefix, model_name=model_name)
    return runs.join(metrics_df.select("candidate_name", "n_trees"), "candidate_name")
