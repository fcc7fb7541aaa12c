"""Wide table -> long training rows, and the label / rank operators.

``wide_to_long`` is a single narrow stage: decode (if needed) -> positional
zip of codes and scores -> ``posexplode`` -> projections.  No shuffle, no
Python; the explode order comes from the arrays, so ``rank`` needs no window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    code_parts,
    decode_code_list,
    decode_score_list,
    expert_main_groups,
    label_match,
    main_group_of,
    zip_scores,
)

LONG_COLUMNS = [
    "patent_id", "bulletin_code", "ipc_code", "ipc_main", "ai_score", "rank", "y",
    "section", "class2", "subclass", "main_group", "subgroup",
]


def wide_to_long(wide: DataFrame) -> DataFrame:
    """One row per (document, AI code); accepts native or '|'-encoded lists."""
    types = {f.name: f.dataType for f in wide.schema.fields}
    expert = decode_code_list("expert_ipc_canon", types["expert_ipc_canon"])
    codes = decode_code_list("ai_ipc_canon", types["ai_ipc_canon"], positional=True)
    scores = decode_score_list("ai_scores", types["ai_scores"])
    exploded = wide.select(
        F.col("application_number").alias("patent_id"),
        "bulletin_code",
        expert.alias("expert"),
        # once per document, below the explode (not once per suggested code)
        expert_main_groups(expert).alias("expert_main"),
        F.posexplode(zip_scores(codes, scores)).alias("pos", "item"),
    )
    with_code = exploded.select(
        "patent_id", "bulletin_code", "expert", "expert_main", "pos",
        F.col("item.code").alias("ipc_code"), F.col("item.score").alias("ai_score"),
    )
    parts = code_parts("ipc_code")
    return with_code.select(
        "patent_id",
        "bulletin_code",
        "ipc_code",
        main_group_of("ipc_code").alias("ipc_main"),
        F.col("ai_score").cast("double").alias("ai_score"),
        (F.col("pos") + 1).cast("int").alias("rank"),
        label_match("ipc_code", "expert", "expert_main").alias("y"),
        parts["section"].alias("section"),
        parts["class2"].alias("class2"),
        parts["subclass"].alias("subclass"),
        parts["main_group"].alias("main_group"),
        parts["subgroup"].alias("subgroup"),
    )


def top_k_codes(long: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best-ranked AI codes of every patent (rank comes from the list)."""
    return long.where(F.col("rank") <= k)


def label_distribution_by_month(long: DataFrame) -> DataFrame:
    """Rows per (bulletin_code, y): partial aggregation before the shuffle."""
    return long.groupBy("bulletin_code", "y").agg(F.count(F.lit(1)).alias("n_rows"))


def _marked_codes(wide: DataFrame) -> DataFrame:
    """Every AI code with whether it, or its main group, is among the document's expert codes.

    Both lists are on the same row, so membership is tested below the
    explode: one narrow stage, no join, and a missing month or number does not
    matter.
    """
    types = {f.name: f.dataType for f in wide.schema.fields}
    expert = decode_code_list("expert_ipc_canon", types["expert_ipc_canon"])
    codes = decode_code_list("ai_ipc_canon", types["ai_ipc_canon"], positional=True)
    coded = F.filter(codes, lambda c: c.isNotNull() & (c != ""))
    lists = wide.select(
        F.col("application_number").alias("patent_id"), "bulletin_code", "source_file",
        expert.alias("expert"), expert_main_groups(expert).alias("expert_main"),
        # exploded as an expression: for a column Spark would add a test of its size and so decode the list twice
        F.posexplode(coded).alias("pos", "ipc_code"),
    )
    items = lists.withColumn("ipc_main", main_group_of("ipc_code"))
    return items.select(
        "patent_id", "bulletin_code", "source_file", (F.col("pos") + 1).cast("int").alias("rank"), "ipc_code", "ipc_main",
        F.coalesce(F.array_contains("expert", F.col("ipc_code")), F.lit(False)).alias("exact"),
        F.coalesce(F.array_contains("expert_main", F.col("ipc_main")), F.lit(False)).alias("main"),
    )


def exact_match_semi(wide: DataFrame) -> DataFrame:
    """AI codes that are in the document's expert set."""
    return _marked_codes(wide).where("exact").drop("exact", "main")


def main_match_semi(wide: DataFrame) -> DataFrame:
    """AI codes whose main group is among the expert main groups (not exact hits)."""
    return _marked_codes(wide).where("main AND NOT exact").drop("exact", "main")


def unmatched_anti(wide: DataFrame) -> DataFrame:
    """AI codes with neither an exact nor a main-group hit (the y = 0 rows)."""
    return _marked_codes(wide).where("NOT exact AND NOT main").drop("exact", "main")
