"""Standard inputs of the registered queries, derived from a table directory.

``sf_dir`` holds the given parquet tables; the bulletin documents and the
suggestion files are derived from ``orders``/``lineitem`` (see
:mod:`ipcforge.sources.tables`) and then go through the same operators as
real archives and files would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import first_ai_line
from ..operators.long import wide_to_long
from ..operators.wide import build_wide
from ..session import cut_lineage
from ..sources import tables
from ..sources.xmldocs import parse_patent_xml


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.code_lines(spark, sf_dir)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.bulletin_documents(spark, sf_dir, lines(spark, sf_dir))


def suggestion_lines(spark: SparkSession, sf_dir: str, all_orders: bool = False) -> DataFrame:
    """(application_key, ai_line): S4 applied to every derived suggestion file."""
    files = tables.ai_files(lines(spark, sf_dir), all_orders)
    return files.select("application_key", first_ai_line("text").alias("ai_line"))


def parsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed documents, written once: the document join reads them several times."""
    return cut_lineage(parse_patent_xml(documents(spark, sf_dir)), "parsed_docs")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 on the derived documents and suggestion files (native list columns)."""
    return build_wide(parsed_documents(spark, sf_dir), suggestion_lines(spark, sf_dir))


def wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table written once (as the prep job writes it)."""
    return cut_lineage(wide(spark, sf_dir), "wide")


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_long(wide(spark, sf_dir))


def long_table(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named long columns (all if none) written once, for plans that read them twice."""
    found = long(spark, sf_dir)
    return cut_lineage(found.select(*columns) if columns else found, "long")
