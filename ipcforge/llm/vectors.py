"""Helpers of the two vector searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, and all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def first_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key; partitions cut their own rows to ``k`` per key before the shuffle."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= k)
