"""Error metrics in one aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def error_metrics(df: DataFrame, label: str = "y", prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """val_rmse, val_mae, n_rows (per group when ``by`` is given); partial aggregation."""
    diff = F.col(label).cast("double") - F.col(prediction).cast("double")
    aggs = [
        F.sqrt(F.avg(diff * diff)).alias("val_rmse"),
        F.avg(F.abs(diff)).alias("val_mae"),
        F.count(F.lit(1)).alias("n_rows"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def evaluate_split(split: DataFrame, prediction: Column, label: str = "y") -> DataFrame:
    """M5 for a prediction column: val_rmse, val_mae on 'val' rows, n_train, n_val in one pass."""
    is_val = F.col("split") == "val"
    diff = F.col(label).cast("double") - prediction.cast("double")
    return split.agg(
        F.sqrt(F.avg(F.when(is_val, diff * diff))).alias("val_rmse"),
        F.avg(F.when(is_val, F.abs(diff))).alias("val_mae"),
        F.count(F.when(F.col("split") == "train", 1)).alias("n_train"),
        F.count(F.when(is_val, 1)).alias("n_val"),
    )


def evaluate_by_month(long: DataFrame, prediction: Column, label: str = "y") -> DataFrame:
    """The result of :func:`evaluate_split` from one pass over the long rows.

    Errors are summed per month first; the split and the averages then work on
    a row per month, and the long rows are never joined.  The month rows are written once: the
    split needs only their codes, and Spark would make the long rows again for those.
    """
    from ..session import cut_lineage
    from .split import month_split

    diff = F.col(label).cast("double") - prediction.cast("double")
    sums = cut_lineage(long.groupBy("bulletin_code").agg(
        F.count(F.lit(1)).alias("n"), F.count(diff).alias("known"), F.sum(diff * diff).alias("se"), F.sum(F.abs(diff)).alias("ae")), "month_errors")
    split = sums.join(F.broadcast(month_split(sums).select("bulletin_code", "split")), "bulletin_code", "left")
    side = lambda which, c: F.sum(F.when(F.col("split") == which, F.col(c)))
    return split.agg(
        F.sqrt(side("val", "se") / side("val", "known")).alias("val_rmse"),
        (side("val", "ae") / side("val", "known")).alias("val_mae"),
        F.coalesce(side("train", "n"), F.lit(0)).alias("n_train"),
        F.coalesce(side("val", "n"), F.lit(0)).alias("n_val"),
    )
