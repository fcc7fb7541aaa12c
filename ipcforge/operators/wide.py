"""D6 and friends: the wide table (one row per bulletin document).

Plan shape: parsed documents --left join (application key)--> first AI line
per suggestion file, then one projection routes every row (good / blank
application number / malformed).  Key-less error rows take part in no join;
hot application keys are salted (:func:`doc_lst_join`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from ..functions import (
    decode_code_list,
    decode_score_list,
    encode_code_list,
    encode_score_list,
    expert_codes,
    has_ai_items,
    check_folder,
    parse_ai_line,
)
from ..sources.suggestions import Suggestions
from ..sources.xmldocs import with_parse_status

# Fixed value: error text of a document without application number.
BLANK_APPLICATION_ERROR = "application_number is empty"

WIDE_SCHEMA = StructType(
    [
        StructField("source_file", StringType()),
        StructField("patent_number", StringType()),
        StructField("application_number", StringType()),
        StructField("bulletin_date", StringType()),
        StructField("expert_ipc_count", IntegerType()),
        StructField("expert_ipc_canon", ArrayType(StringType())),
        StructField("lst_key", StringType()),
        StructField("lst_found", BooleanType()),
        StructField("ai_ipc_count", IntegerType()),
        StructField("ai_ipc_raw", ArrayType(StringType())),
        StructField("ai_ipc_canon", ArrayType(StringType())),
        StructField("ai_scores", ArrayType(DoubleType())),
        StructField("bulletin_code", StringType()),
        StructField("error", StringType()),
    ]
)
WIDE_COLUMNS = [f.name for f in WIDE_SCHEMA.fields]
LIST_COLUMNS = ("expert_ipc_canon", "ai_ipc_raw", "ai_ipc_canon", "ai_scores")


# A key is split when it holds at least this share of the documents, so there
# are at most as many such keys as its inverse, whatever the size of the data.
HOT_SHARE = 10_000
# Documents per salt of a split key.
SALT_ROWS = 10_000


def doc_lst_join(docs: DataFrame, lst: DataFrame | Suggestions, hot_share: int = HOT_SHARE, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Documents (with ``application_key``) left-joined to their AI line.

    Inner-join semantics for the good documents come from the later
    ``size(ai) > 0`` filter; error rows have no key, match nothing and pass
    through, dealt over the tasks by a key of their own.

    One partial aggregate over the key column finds the hot application numbers
    (at most ``hot_share``, by arithmetic).  Without any, which is the rule, the
    plan is one join with one scan of either side, and a bucketed suggestion table is not
    shuffled.  Else the documents of hot keys are dealt over
    ``ceil(n / salt_rows)`` salts, their lines are repeated once per salt and
    joined on (key, salt), so no task gets all of them.  ``docs`` is read
    more than once and should be a written table.

    :class:`Suggestions` are joined as they lie: the base first, then the newer
    lines, which win.
    """
    key = F.col("application_key")
    sides = [lst.base, lst.newer] if isinstance(lst, Suggestions) else [lst]
    tables = [t.select(F.col("application_key").alias("_line_key"), F.col("ai_line").alias("_line"), F.lit(True).alias("_there"))
              for t in sides]
    names = [*docs.columns, "ai_line"]
    # a name with NUL is no file's, so these keys match nothing
    own = F.coalesce(key, F.concat(F.lit("\x00"), F.xxhash64(*docs.columns).cast("string")))
    total = docs.count()  # of a written table: from its footers
    counts = docs.where(key.isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.where((F.col("_n") > salt_rows) & (F.col("_n") * hot_share >= total)).collect()

    def joined(rows: DataFrame, lines: list[DataFrame], salted: bool) -> DataFrame:
        rows = rows.withColumn("ai_line", F.lit(None).cast("string"))
        for table in lines:
            same = F.col("_key") == F.col("_line_key")
            same = same & (F.col("_salt") == F.col("_line_salt")) if salted else same
            rows = rows.join(table, same, "left").withColumn("ai_line", F.when(F.col("_there"), F.col("_line")).otherwise(F.col("ai_line")))
            rows = rows.drop("_line_key", "_line", "_there", "_line_salt")
        return rows.select(*names)

    keyed = docs.withColumn("_key", own)
    if not found:
        return joined(keyed, tables, False)
    hot = F.broadcast(docs.sparkSession.createDataFrame(
        [(r["application_key"], -(-r["_n"] // salt_rows)) for r in found], "_hot_key string, _salts int"))
    marked = keyed.join(hot, F.col("_key") == F.col("_hot_key"), "left")
    dealt = marked.where(F.col("_hot_key").isNotNull()).withColumn("_salt", F.pmod(F.xxhash64("source_file"), F.col("_salts")).cast("int"))
    copies = [t.join(hot, F.col("_line_key") == F.col("_hot_key")).select(
        "_line_key", "_line", "_there", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_line_salt")) for t in tables]
    cold = joined(marked.where(F.col("_hot_key").isNull()), tables, False)
    return cold.unionByName(joined(dealt, copies, True))


def build_wide(parsed_docs: DataFrame, lst: DataFrame | Suggestions, lst_prefix: str = "lst/") -> DataFrame:
    """Parsed documents + (application_key, ai_line) -> wide rows (native arrays).

    ``parsed_docs`` comes from :func:`parse_patent_xml` (bulletin_code,
    source_file, patent_number, application_number, bulletin_date, ipc_texts,
    parse_error).  They are read twice (:func:`doc_lst_join`), so pass a
    written table (``prep_job`` does).
    """
    return route_wide(doc_lst_join(with_parse_status(parsed_docs), lst), lst_prefix)


def route_wide(joined: DataFrame, lst_prefix: str = "lst/") -> DataFrame:
    """F2/F3 and the wide columns of documents with parse status and ``ai_line``."""
    prefix = check_folder(lst_prefix)
    joined = joined.withColumn("expert", expert_codes("ipc_texts"))
    # good documents without any AI suggestion are dropped (cheap test
    # first, so the pushed-down filter does not repeat the parse).
    kept = joined.where((F.col("doc_status") != "ok") | has_ai_items("ai_line")).withColumn(
        "ai", F.when(F.col("doc_status") == "ok", parse_ai_line("ai_line"))
    )

    status = F.col("doc_status")
    good, blank = status == "ok", status == "blank"
    keeps_doc = good | blank
    empty_s = F.array().cast("array<string>")
    empty_d = F.array().cast("array<double>")
    expert = F.when(keeps_doc, F.col("expert")).otherwise(empty_s)
    return kept.select(
        F.col("source_file"),
        F.when(keeps_doc, F.col("patent_number")).alias("patent_number"),
        F.when(keeps_doc, F.col("application_number")).alias("application_number"),
        F.when(keeps_doc, F.col("bulletin_date")).alias("bulletin_date"),
        F.size(expert).cast("int").alias("expert_ipc_count"),
        expert.alias("expert_ipc_canon"),
        F.when(good, F.concat(F.lit(prefix), "application_key", F.lit(".LST"))).alias("lst_key"),
        good.alias("lst_found"),
        F.when(good, F.size("ai")).otherwise(0).cast("int").alias("ai_ipc_count"),
        F.when(good, F.transform("ai", lambda x: x["raw"])).otherwise(empty_s).alias("ai_ipc_raw"),
        F.when(good, F.transform("ai", lambda x: x["canon"])).otherwise(empty_s).alias("ai_ipc_canon"),
        F.when(good, F.transform("ai", lambda x: x["score"])).otherwise(empty_d).alias("ai_scores"),
        F.col("bulletin_code"),
        F.when(good, F.lit(None).cast("string"))
        .when(blank, F.lit(BLANK_APPLICATION_ERROR))
        .otherwise(F.col("parse_error"))
        .alias("error"),
    )


def encode_wide(wide: DataFrame) -> DataFrame:
    """The four list columns flattened to '|'-joined strings."""
    return wide.select(
        *[
            (encode_score_list(c) if c == "ai_scores" else encode_code_list(c)).alias(c)
            if c in LIST_COLUMNS
            else F.col(c)
            for c in wide.columns
        ]
    )


def decode_wide(wide: DataFrame) -> DataFrame:
    """Accept native or interchange list columns, return native arrays."""
    types = {f.name: f.dataType for f in wide.schema.fields}
    out = []
    for c in wide.columns:
        if c == "ai_scores":
            out.append(decode_score_list(c, types[c]).alias(c))
        elif c in LIST_COLUMNS:
            # the suggestion lists stay aligned with their scores
            out.append(decode_code_list(c, types[c], positional=c.startswith("ai_")).alias(c))
        else:
            out.append(F.col(c))
    return wide.select(*out)


def error_kind(error: str = "error") -> F.Column:
    """Parser wording differs between engines; compare the kind of error only."""
    e = F.col(error)
    return (
        F.when(e.isNull(), F.lit(None).cast("string"))
        .when(e == BLANK_APPLICATION_ERROR, F.lit("blank_application"))
        .otherwise(F.lit("malformed"))
    )


def bulletin_counts(wide: DataFrame) -> DataFrame:
    """Rows per bulletin and in total (``bulletin_code`` NULL = total)."""
    return (
        wide.rollup("bulletin_code")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(F.when(F.col("error").isNull(), 1)).alias("n_good"),
            F.count(F.col("error")).alias("n_error"),
        )
    )
