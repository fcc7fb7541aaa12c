"""M1: ordered target statistics of categorical columns.

A training row's category becomes the smoothed mean of the target over the
rows of that category that come earlier in a fixed random order, so no row
sees its own target.  All other rows get the mean over all training rows of the
category.  No label reaches the driver: statistics stay a table.

The order is that of a row hash.  A category's rows are cut into slots of hash
ranges, as many as bound a slot by about ``SLOT_ROWS`` rows: sums per (category, slot) give
what lies in earlier slots, a window within the slot the rest.  So a category
with a third of all rows is spread over many tasks.  Equal rows are peers: none
of them sees another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import MISSING_CATEGORY

SLOT_ROWS = 50_000
# Weight of the overall mean, in rows.
PRIOR_ROWS = 1.0
# Copies of a category's statistics in the join with rows to be encoded.
SALTS = 32
_BITS = 62


def smoothed_mean(total: Column, n: Column, mean: float) -> Column:
    """(total + prior) / (n + weight of the prior); missing counts are 0, so an unknown category gets the mean."""
    zero = F.lit(0.0)
    return (F.coalesce(total, zero) + F.lit(PRIOR_ROWS * mean)) / (F.coalesce(n.cast("double"), zero) + F.lit(PRIOR_ROWS))


def category(c: str) -> Column:
    """A categorical column as read by the statistics; missing values are a category of their own."""
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY))


def category_stats(train: DataFrame, cats: list[str], target: str) -> DataFrame:
    """(field, category, n, total) over the rows with a target."""
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), category(c).alias("category")) for c in cats])).alias("f")
    return (train.where(F.col(target).isNotNull()).select(fields, F.col(target).alias("y")).groupBy("f.field", "f.category")
            .agg(F.count("y").alias("n"), F.sum(F.col("y").cast("double")).alias("total")))


def ordered_stats(train: DataFrame, cats: list[str], target: str, mean: float, rows: int) -> DataFrame:
    """``train`` with ``<c>_ts`` per categorical column; ``rows`` is the number of its rows."""
    slots = max(1, -(-rows // SLOT_ROWS))
    order = F.shiftrightunsigned(F.xxhash64(*train.columns), 64 - _BITS)
    df = train.withColumn("__order", order).withColumn("__slot", F.floor(F.col("__order") / F.lit(float(1 << _BITS)) * F.lit(slots)))
    for c in cats:
        keys = ["__category", "__slot"]
        df = df.withColumn("__category", category(c))
        per_slot = df.groupBy(*keys).agg(F.count(target).alias("__n"), F.sum(F.col(target).cast("double")).alias("__t"))
        earlier = Window.partitionBy("__category").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
        before = per_slot.select(*keys, F.sum("__n").over(earlier).alias("__n0"), F.sum("__t").over(earlier).alias("__t0"))
        within = Window.partitionBy(*keys).orderBy("__order").rangeBetween(Window.unboundedPreceding, -1)
        df = df.withColumn("__n1", F.count(target).over(within)).withColumn("__t1", F.sum(F.col(target).cast("double")).over(within))
        zero = F.lit(0.0)
        n = F.coalesce("__n0", F.lit(0)) + F.col("__n1")
        t = F.coalesce("__t0", zero) + F.coalesce("__t1", zero)
        df = df.join(before, keys).withColumn(f"{c}_ts", smoothed_mean(t, n, mean)).drop("__category", "__n0", "__t0", "__n1", "__t1")
    return df.drop("__order", "__slot")


def encode_with(df: DataFrame, stats: DataFrame, cats: list[str], mean: float) -> DataFrame:
    """``df`` with ``<c>_ts`` from full statistics.

    One equi-join per column; statistics are copied per salt, so the rows of
    a category that holds a third of the table lie in ``SALTS`` tasks.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS))
    df = df.withColumn("__salt", salt)
    copies = stats.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    for c in cats:
        side = copies.where(F.col("field") == c).select(F.col("category").alias("__category"), "__salt", F.col("n").alias("__n"), F.col("total").alias("__t"))
        df = (df.withColumn("__category", category(c)).join(side, ["__category", "__salt"], "left")
              .withColumn(f"{c}_ts", smoothed_mean(F.col("__t"), F.col("__n"), mean)).drop("__category", "__n", "__t"))
    return df.drop("__salt")
