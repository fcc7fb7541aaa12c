"""Per-document XML parsing with error isolation.

Built-in ``xpath`` fails the whole job on one malformed document and cannot
tell an absent element from an empty one, so this is the single place where
Python runs inside tasks: an Arrow-batched ``mapInPandas`` that parses each
document with ElementTree and returns a status column instead of raising.
Spark partitions and shuffles the documents; the Python part is per row.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values: (element anywhere below the root, its child) of the bulletin document.
PATENT_NUMBER_PATH = ("B110", None)
APPLICATION_NUMBER_PATH = ("B210", None)
BULLETIN_DATE_PATH = ("B480", "date")
IPC_TEXT_PATH = ("classification-ipcr", "text")

PARSED_FIELDS = (
    "patent_number string, application_number string, bulletin_date string, "
    "ipc_texts array<string>, parse_error string"
)


def _below(root: ET.Element, path: tuple[str, str | None]) -> Iterator[ET.Element]:
    """``.//name`` or ``.//name/child``, in the document's order."""
    name, child = path
    for node in root.iter(name):
        if node is not root:
            if child is None:
                yield node
            else:
                yield from node.findall(child)


def _first_text(root: ET.Element, path: tuple[str, str | None]) -> str | None:
    for node in _below(root, path):
        return node.text or ""
    return None


def parse_document(data: bytes | str | None) -> tuple:
    """One document -> (patent_number, application_number, date, texts, error)."""
    try:
        if data is None:
            raise ValueError("document is empty")
        if isinstance(data, str):
            data = data.encode("utf-8")
        root = ET.fromstring(data)
        return (
            _first_text(root, PATENT_NUMBER_PATH),
            _first_text(root, APPLICATION_NUMBER_PATH),
            _first_text(root, BULLETIN_DATE_PATH),
            [node.text for node in _below(root, IPC_TEXT_PATH)],
            None,
        )
    except Exception as exc:  # noqa: BLE001 - one bad document must not fail the job
        return (None, None, None, [], str(exc) or type(exc).__name__)


def _parse_batches(keep: list[str], xml_col: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [parse_document(x) for x in pdf[xml_col]]
            out = pdf[keep].copy()
            out["patent_number"] = [r[0] for r in rows]
            out["application_number"] = [r[1] for r in rows]
            out["bulletin_date"] = [r[2] for r in rows]
            out["ipc_texts"] = [r[3] for r in rows]
            out["parse_error"] = [r[4] for r in rows]
            yield out

    return run


def parse_patent_xml(docs: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Parse ``docs[xml_col]`` (string or binary); other columns pass through."""
    keep = [c for c in docs.columns if c != xml_col]
    pass_schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != xml_col
    )
    schema = f"{pass_schema}, {PARSED_FIELDS}" if pass_schema else PARSED_FIELDS
    return docs.mapInPandas(_parse_batches(keep, xml_col), schema)


def with_parse_status(parsed: DataFrame) -> DataFrame:
    """F3 helper: 'malformed' | 'blank' (no application number) | 'ok'."""
    from ..functions.text import py_strip

    app = F.nullif(py_strip(F.coalesce("application_number", F.lit(""))), F.lit(""))
    return parsed.withColumn(
        "doc_status",
        F.when(F.col("parse_error").isNotNull(), F.lit("malformed"))
        .when(app.isNull(), F.lit("blank"))
        .otherwise(F.lit("ok")),
    ).withColumn("application_key", F.when(F.col("doc_status") == "ok", app))
