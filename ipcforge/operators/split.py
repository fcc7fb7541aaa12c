"""Time split of the long table by month.

The month index is computed on the distinct month set (tiny) and joined
back; the facts are never ordered by a global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .months import month_codes, sorted_months

# Fixed value: share of the months used for training.
TRAIN_FRAC = 2.0 / 3.0


def month_split(long: DataFrame, train_frac: float = TRAIN_FRAC) -> DataFrame:
    """(bulletin_code, month_idx, n_months, n_train_months, split) for every month present.

    The first ``floor(n * frac)`` months (1-based idx <= that) are 'train'.
    """
    from pyspark.sql import Window

    # Both windows run over the distinct month set only (one row per month).
    with_n = sorted_months(month_codes(long)).withColumn("n_months", F.count(F.lit(1)).over(Window.partitionBy()))
    n_train = F.floor(F.col("n_months").cast("double") * F.lit(train_frac)).cast("int")
    return with_n.select(
        "bulletin_code",
        F.col("pos").alias("month_idx"),
        F.col("n_months").cast("int").alias("n_months"),
        n_train.alias("n_train_months"),
        F.when(F.col("pos") <= n_train, F.lit("train")).otherwise(F.lit("val")).alias("split"),
    )


def split_long(long: DataFrame, train_frac: float = TRAIN_FRAC) -> DataFrame:
    """Long rows with a ``split`` column; NULL months get NULL (in neither side).

    A value that is not a six-digit code counts as missing.  The month
    dimension is broadcast: its domain bounds it (``month_codes``), and a month
    holding a third of the rows never lands in one join task.
    ``long`` should be a written table: it is read once for the month set and
    once for the join.
    """
    dim = month_split(long, train_frac).select("bulletin_code", "split")
    return long.join(F.broadcast(dim), "bulletin_code", "left")


def split_filter(split: DataFrame, which: str) -> DataFrame:
    """rows of one side ('train' or 'val')."""
    return split.where(F.col("split") == which)


def split_counts(split: DataFrame) -> DataFrame:
    """N rows per split side (NULL = month missing)."""
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
