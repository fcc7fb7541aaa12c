"""Feature selection and missing-value filling for the regressors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Feature lists of the candidates.
BASE_NUMERIC = ["ai_score", "rank"]
PART_NUMERIC = ["main_group", "subgroup"]
PART_CATEGORICAL = ["section", "class2", "subclass"]
MISSING_CATEGORY = "NA"


def feature_columns(use_ipc_parts: bool) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names for a candidate."""
    if use_ipc_parts:
        return BASE_NUMERIC + PART_NUMERIC, list(PART_CATEGORICAL)
    return list(BASE_NUMERIC), []


def fill_features(df: DataFrame) -> DataFrame:
    """P10: numeric NULL -> 0, categorical NULL -> 'NA' (decided by declared type)."""
    numeric = [c for c in BASE_NUMERIC + PART_NUMERIC if c in df.columns]
    cats = [c for c in PART_CATEGORICAL if c in df.columns]
    return df.na.fill(0, numeric).na.fill(MISSING_CATEGORY, cats)


def project_features(df: DataFrame, use_ipc_parts: bool, target: str = "y", keep: tuple[str, ...] = ()) -> DataFrame:
    """The candidate's feature columns (plus the target and any ``keep`` columns)."""
    num, cat = feature_columns(use_ipc_parts)
    return df.select(*keep, *num, *cat, F.col(target))
