"""Month axis operators: listings, latest month, validation, windows.

Month codes are ``YYYYMM`` text; they sort lexically = chronologically.  All
month sets are tiny (one row per calendar month), so they are aggregated
first (partial aggregation before the shuffle) and only then ordered or
joined back; AQE turns the join with such a set into a broadcast at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bulletin_code_from_key, check_folder, dataset_code_from_key, month_series
from ..functions.months import MONTH_CODE_RE


def list_bulletins(keys: DataFrame, prefix: str = "pub/") -> DataFrame:
    """Distinct month codes of ``<prefix>YYYYMM.zip`` keys, with ascending position."""
    p = check_folder(prefix)
    codes = keys.select(bulletin_code_from_key("key", p).alias("bulletin_code"))
    return sorted_months(codes)


def list_datasets(keys: DataFrame, prefix: str = "dataprep/") -> DataFrame:
    """Distinct month codes of prepared datasets, with ascending position."""
    p = check_folder(prefix)
    codes = keys.select(dataset_code_from_key("key", p).alias("bulletin_code"))
    return sorted_months(codes)


def distinct_months(df: DataFrame, col: str = "bulletin_code") -> DataFrame:
    """A1: distinct non-NULL month codes."""
    return df.select(F.col(col).alias("bulletin_code")).where(F.col("bulletin_code").isNotNull()).distinct()


def sorted_months(df: DataFrame, col: str = "bulletin_code") -> DataFrame:
    """O1: distinct months with their 1-based ascending position.

    The window has no partition key on purpose: it runs over the distinct
    month set (tens to hundreds of rows), never over the facts.
    """
    months = distinct_months(df, col)
    return months.withColumn("pos", F.row_number().over(Window.orderBy("bulletin_code")).cast("int"))


def month_range(df: DataFrame, col: str = "bulletin_code") -> DataFrame:
    """A2/A3: one row (first_month, last_month, n_months)."""
    m = F.col(col)
    return df.where(m.isNotNull()).agg(
        F.min(m).alias("first_month"),
        F.max(m).alias("last_month"),
        F.count_distinct(m).alias("n_months"),
    )


def resolve_month(available: DataFrame, requested: DataFrame, col: str = "requested") -> DataFrame:
    """validate requested months against an available listing.

    Returns ``requested``, ``resolved`` and ``status`` per request:
    'ok', 'no_data' (listing empty), 'bad_format', 'not_found'.  ``last``
    resolves to the newest available month.
    """
    rng = month_range(available).select("first_month", "last_month", "n_months")
    req = requested.select(F.col(col).alias("requested"))
    found = available.select(F.col("bulletin_code").alias("requested")).distinct().withColumn("found", F.lit(True))
    # ``rng`` is one aggregated row: a broadcast of proven size 1.
    joined = req.join(F.broadcast(rng), F.lit(True), "left")
    joined = joined.join(found, "requested", "left")
    r = F.col("requested")
    status = (
        F.when(F.coalesce(F.col("n_months"), F.lit(0)) == 0, F.lit("no_data"))
        .when(r == "last", F.lit("ok"))
        .when(~r.rlike(MONTH_CODE_RE) | r.isNull(), F.lit("bad_format"))
        .when(F.col("found").isNull(), F.lit("not_found"))
        .otherwise(F.lit("ok"))
    )
    resolved = F.when(status == "ok", F.when(r == "last", F.col("last_month")).otherwise(r))
    return joined.select(
        "requested", resolved.alias("resolved"), status.alias("status"), "first_month", "last_month"
    )


def month_window(last_month: DataFrame, n: int, col: str = "last_month") -> DataFrame:
    """The ``n`` calendar months ending at each ``last_month`` (gaps included).

    Returns (last_month, pos, bulletin_code) with pos 1 = newest.
    """
    return last_month.select(
        F.col(col).alias("last_month"),
        F.posexplode(month_series(col, n)).alias("pos", "bulletin_code"),
    ).withColumn("pos", (F.col("pos") + 1).cast("int"))


def month_codes(df: DataFrame, col: str = "bulletin_code") -> DataFrame:
    """Distinct six-digit codes: at most a million rows of six characters, whatever the data.

    This domain bound is why month sets may be broadcast below.
    """
    return distinct_months(df, col).where(F.col("bulletin_code").rlike(MONTH_CODE_RE))


def window_filter(df: DataFrame, window: DataFrame, col: str = "bulletin_code") -> DataFrame:
    """keep rows whose month is in the window (LEFT SEMI join, before any file is opened).

    The month set is broadcast (:func:`month_codes` bounds it), so the
    filtered rows are never shuffled by month and a month holding a third of
    the rows stays spread.
    """
    months = month_codes(window).select(F.col("bulletin_code").alias(col))
    return df.join(F.broadcast(months), col, "left_semi")
