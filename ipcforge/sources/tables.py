"""Patent inputs derived from the given ``orders`` / ``lineitem`` tables.

No bulletin archives or suggestion files ship with the test data, so the
inputs of the pipeline are derived deterministically from the TPC-H-like
tables (one order = one patent; its 'R' lines are the expert codes, the other
lines the ranked AI suggestions).  The derivation is plain DataFrame work:
two hash aggregates by ``l_orderkey`` (the few items of an order are sorted
inside the aggregate) and one join with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_code_of

# Fixed values of the derivation (shared with the SQL oracle).
SECTIONS = "ABCDEFGH"
MALFORMED_EVERY = 89
BLANK_APPLICATION_EVERY = 97
NO_AI_FILE_EVERY = 11
UNSCORED_LINE = 7
CODELESS_EVERY = 13
CODELESS_ITEM = "20060101"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed value: order of the lines inside an order (line number first).
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")


def code_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: its code text and expected canonical code.

    The position of a line inside its order is not materialised here: the
    aggregates by order sort their collected items by ``LINE_ORDER`` (a few
    items per order), so the facts are never globally sorted by a window.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, "l_returnflag")
    sec = F.substr(F.lit(SECTIONS), (F.col("l_orderkey") % 8).cast("int") + 1, F.lit(1))
    mg = (F.lit(31) + F.col("l_partkey") % 3).cast("string")
    sg = F.lpad(((F.col("l_suppkey") % 3) * 10).cast("string"), 2, "0")
    sc = F.when(
        F.col("l_linenumber") != UNSCORED_LINE,
        F.concat(
            F.col("l_quantity").cast("int").cast("string"),
            F.lit("."),
            F.lpad((F.col("l_linenumber") * 13).cast("string"), 2, "0"),
        ),
    )
    lines = li.select(
        "l_orderkey", "l_returnflag", *LINE_ORDER,
        sec.alias("sec"), mg.alias("mg"), sg.alias("sg"), sc.alias("sc"),
    )
    variant = F.col("l_linenumber") % 4
    raw = (
        F.when(variant == 0, F.concat("sec", F.lit("01K "), "mg", F.lit("/"), "sg"))
        .when(variant == 1, F.concat(F.lower("sec"), F.lit("01k"), "mg", F.lit("/"), "sg"))
        .when(variant == 2, F.concat("sec", F.lit("01K  00"), "mg", F.lit(" / "), "sg"))
        .otherwise(F.concat("sec", F.lit("01K "), "mg", F.lit("/"), "sg", F.lit(" 20060101AFI")))
    )
    return lines.withColumn("raw_code", raw).withColumn(
        "want", F.concat("sec", F.lit("01K "), "mg", F.lit("/"), "sg")
    )


def _by_key(df: DataFrame, key: str) -> DataFrame:
    """Hash-distribute rows by the grouping key before a collect-type aggregate.

    Map-side partial aggregation cannot shrink a collected list, so the rows
    are shuffled as they are (explicit partition count, kept by AQE) and the
    aggregate runs after the exchange in one stage, on every core.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key)


def _ordered_concat(item: Column, sep: str) -> Column:
    """Items of one order joined in ``LINE_ORDER`` (hash aggregate, no global sort).

    ``sort_array`` compares the (never NULL) structs with the native ordering;
    ``array_sort`` would call its comparator lambda per comparison.
    """
    key = F.struct(*[F.col(c) for c in LINE_ORDER])
    collected = F.collect_list(F.struct(key.alias("k"), item.alias("v")))
    return F.array_join(F.transform(F.sort_array(collected), lambda x: x["v"]), sep)


def ai_files(lines: DataFrame, all_orders: bool = False) -> DataFrame:
    """(application_key, text): the suggestion file of every order with AI lines.

    Orders whose key is a multiple of 11 have no file, unless ``all_orders``.  The text has a header
    line before the ``AI_IPC:`` line, like the real files.
    """
    # every 13th part gives an item that is a bare date: it has a score but no code
    raw = F.when(F.col("l_partkey") % CODELESS_EVERY == 0, F.lit(CODELESS_ITEM)).otherwise(F.col("raw_code"))
    item = F.when(F.col("sc").isNull(), raw).otherwise(F.concat(raw, F.lit(" ("), "sc", F.lit("%)")))
    ai = lines.where((F.col("l_returnflag") != "R") & (F.lit(all_orders) | (F.col("l_orderkey") % NO_AI_FILE_EVERY != 0)))
    # Grouped by the text key itself: the join on application_key that
    # follows then reuses this hash partitioning instead of shuffling again.
    keyed = ai.withColumn("application_key", F.col("l_orderkey").cast("string"))
    per_order = _by_key(keyed, "application_key").groupBy("application_key").agg(
        _ordered_concat(item, ";").alias("items")
    )
    key = F.col("application_key")
    text = F.concat(F.lit("APPLICATION "), key, F.lit("\r\nAI_IPC:"), "items", F.lit(";\n"))
    return per_order.select(key, text.alias("text"))


def bulletin_documents(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """(bulletin_code, source_file, xml): one bulletin document per order.

    Every 89th document is malformed (an unclosed element) and every 97th has
    an empty application number.
    """
    node = F.concat(
        F.lit("<classification-ipcr><text>"), F.col("raw_code"), F.lit("</text></classification-ipcr>")
    )
    expert = (
        lines.where(F.col("l_returnflag") == "R")
        .transform(lambda df: _by_key(df, "l_orderkey"))
        .groupBy("l_orderkey")
        .agg(_ordered_concat(node, "").alias("ex"))
    )
    # Both join sides are hash-distributed by the order key with the same
    # explicit count: the join needs no further exchange and its output keeps
    # that many partitions (AQE keeps explicit counts), so the documents are
    # already spread for the per-document parse that follows.
    orders = _by_key(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    ok = F.col("o_orderkey")
    key = ok.cast("string")
    xml = F.concat(
        F.lit("<ru-patent-document><SDOBI><B100><B110>RU"), key,
        F.lit("</B110></B100><B200><B210>"),
        F.when(ok % BLANK_APPLICATION_EVERY == 0, F.lit("")).otherwise(key),
        F.lit("</B210></B200><B400><B480><date>"),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.lit("</date></B480></B400>"),
        F.coalesce("ex", F.lit("")),
        F.when(ok % MALFORMED_EVERY == 0, F.lit("<broken>")).otherwise(F.lit("")),
        F.lit("</SDOBI></ru-patent-document>"),
    )
    code = month_code_of("o_orderdate")
    docs = orders.join(expert, orders.o_orderkey == expert.l_orderkey, "left")
    out = docs.select(
        code.alias("bulletin_code"),
        F.concat(code, F.lit("/"), key, F.lit("/Document.xml")).alias("source_file"),
        xml.alias("xml"),
    )
    return out


def _later(code: Column) -> Column:
    """The same month twenty years later."""
    return F.concat((F.substr(code, F.lit(1), F.lit(4)).cast("int") + 20).cast("string"), F.substr(code, F.lit(5), F.lit(2)))


def bulletin_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys of a bulletin bucket, one or two per order, with junk names mixed in.

    Used to exercise the listing rules at the scale of the data.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    code = month_code_of("o_orderdate")
    k = F.col("o_orderkey") % 7
    later = _later(code)  # months that no valid key has: accepting such a key would show
    junk = (
        F.when(k == 1, F.concat(F.lit("pub/x/"), later, F.lit(".zip")))
        .when(k == 2, F.concat(F.lit("pub/"), later, F.lit(".ZIP")))
        .when(k == 3, F.concat(F.lit("pub/"), F.substr(code, F.lit(1), F.lit(4)), F.lit(".zip")))
        .when(k == 4, F.concat(F.lit("pub/"), F.translate(code, "0123456789", "abcdefghij"), F.lit(".zip")))
        .when(k == 5, F.concat(F.lit("lst/"), F.col("o_orderkey").cast("string"), F.lit(".LST")))
        .otherwise(F.concat(F.lit("pub/"), code, F.lit("/"), F.col("o_orderkey").cast("string"), F.lit("Document.xml")))
    )
    good = o.where(F.col("o_orderkey") % 5 != 0).select(F.concat(F.lit("pub/"), code, F.lit(".zip")).alias("key"))
    return good.unionByName(o.select(junk.alias("key")))


def dataset_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys of a prepared-dataset prefix, derived from the orders."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    code = month_code_of("o_orderdate")
    n = (F.col("o_orderkey") % 12 + 1).cast("string")
    later = _later(code)
    k = F.col("o_orderkey") % 6
    key = (
        F.when(k == 0, F.concat(F.lit("dataprep/ipc_with_ai_"), code, F.lit("_last_"), n, F.lit(".parquet")))
        .when(k == 1, F.concat(F.lit("dataprep/ipc_with_ai_"), F.substr(code, F.lit(1), F.lit(4)), F.lit("_last_"), n, F.lit(".parquet")))
        .when(k == 2, F.concat(F.lit("dataprep/ipc_with_ai_"), later, F.lit("_last_.parquet")))
        .when(k == 3, F.concat(F.lit("dataprep/old/ipc_with_ai_"), later, F.lit("_last_"), n, F.lit(".parquet")))
        .when(k == 4, F.concat(F.lit("dataprep/ipc_with_ai_"), later, F.lit("_last_"), n, F.lit(".csv")))
        .otherwise(F.concat(F.lit("dataprep/ipc_with_ai_"), code, F.lit("_last_"), n, F.lit(".parquet")))
    )
    return o.select(key.alias("key"))
