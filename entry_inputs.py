"""Inputs of the registered registry checks: three fixed scorers and a champion.

Everything comes from per-month sums of one pass over the long table; the
split, the metrics and the registry then work on a row per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ipcforge.operators.registry import CHAMPION, MODEL_NAME, runs_from_metrics
from ipcforge.operators.split import month_split


def fixed_predictions() -> dict[str, Column]:
    """The scorers: ai_score / 100, 1 / rank, 0.25."""
    return {
        "v1_reg_base": F.coalesce(F.col("ai_score"), F.lit(0.0)) / 100.0,
        "v1_reg_shallow": F.lit(1.0) / F.col("rank"),
        "v1_reg_no_ipc_parts": F.lit(0.25),
    }


def month_sums(long: DataFrame) -> DataFrame:
    """One row per month: rows, sums of y and y squared, squared and absolute errors of every scorer."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("y1"), F.sum(F.col("y") * F.col("y")).alias("y2")]
    for i, p in enumerate(fixed_predictions().values()):
        d = F.col("y") - p
        aggs += [F.sum(d * d).alias(f"se{i}"), F.sum(F.abs(d)).alias(f"ae{i}")]
    return long.groupBy("bulletin_code").agg(*aggs)


def split_sums(sums: DataFrame) -> DataFrame:
    """The month rows with their side of the split."""
    return sums.join(F.broadcast(month_split(sums).select("bulletin_code", "split")), "bulletin_code", "left")


def _side(which: str, col: str) -> Column:
    return F.sum(F.when(F.col("split") == which, F.col(col)))


def side_counts(split: DataFrame) -> DataFrame:
    return split.agg(F.coalesce(_side("train", "n"), F.lit(0)).alias("n_train"), F.coalesce(_side("val", "n"), F.lit(0)).alias("n_val"))


def fixed_candidate_runs(split: DataFrame, round_id: str = "round-1") -> DataFrame:
    """Runs of the three fixed scorers, one row each."""
    names = list(fixed_predictions())
    aggs = [_side("train", "n").alias("n_train"), _side("val", "n").alias("n_val")]
    for i in range(len(names)):
        aggs += [_side("val", f"se{i}").alias(f"se{i}"), _side("val", f"ae{i}").alias(f"ae{i}")]
    rows = F.array(*[
        F.struct(F.lit(name).alias("candidate_name"), F.lit(i + 1).alias("ord"),
                 F.sqrt(F.col(f"se{i}") / F.col("n_val")).alias("val_rmse"), (F.col(f"ae{i}") / F.col("n_val")).alias("val_mae"))
        for i, name in enumerate(names)
    ])
    metrics = split.agg(*aggs).select(F.explode(rows).alias("r"), "n_train", "n_val").select("r.*", "n_train", "n_val")
    return runs_from_metrics(metrics, input_key="derived", round_id=round_id)


def mean_predictor_champion(split: DataFrame) -> DataFrame:
    """A champion state derived from the data: the train-mean predictor, version 1.

    avg((y - m)^2) over val = E[y^2] - 2 m E[y] + m^2 with m the train mean.
    """
    agg = split.agg(
        (_side("train", "y1") / _side("train", "n")).alias("m"),
        (_side("val", "y1") / _side("val", "n")).alias("ey"),
        (_side("val", "y2") / _side("val", "n")).alias("ey2"),
    )
    rmse = F.sqrt(F.greatest(F.lit(0.0), F.col("ey2") - 2 * F.col("m") * F.col("ey") + F.col("m") * F.col("m")))
    return agg.select(
        F.lit(CHAMPION).alias("slot"),
        F.lit("mean_predictor").alias("candidate_name"),
        F.lit(MODEL_NAME).alias("model_name"),
        F.lit("1").alias("model_version"),
        F.lit("seed").alias("run_id"),
        rmse.alias("val_rmse"),
        F.lit(None).cast("double").alias("val_mae"),
        F.lit("derived").alias("input_key"),
        F.lit(None).cast("string").alias("source_model_key"),
        F.lit(None).cast("timestamp").alias("promoted_at_utc"),
    )


def seed_versions(split: DataFrame) -> DataFrame:
    """Existing registry versions before this round: the mean-predictor champion (version 1)."""
    return mean_predictor_champion(split).select("model_name", "model_version", "run_id")
