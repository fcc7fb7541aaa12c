"""

``entry(spark)`` runs the flagship query (label distribution per bulletin
month) on sf0.001.  ``queries()`` registers one DataFrame query per operator
an independent DuckDB query that computes the expected result from the base
columns of ``orders`` / ``lineitem`` (it never repeats our regexes).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ipcforge.functions import (  # noqa: E402
    canonicalize_code,
    code_parts,
    dataset_name,
    expert_codes,
    main_group_of,
    month_code_of,
    parse_ai_line,
)
from ipcforge.operators import long as long_ops  # noqa: E402
from ipcforge.operators import months as month_ops  # noqa: E402
from ipcforge.operators import registry as reg_ops  # noqa: E402
from ipcforge.operators.features import fill_features, project_features  # noqa: E402
from ipcforge.operators.metrics import evaluate_by_month  # noqa: E402
from ipcforge.operators.split import month_split, split_counts, split_long  # noqa: E402
from ipcforge.operators.wide import bulletin_counts, encode_wide, error_kind  # noqa: E402
from ipcforge.plans import derived  # noqa: E402
from ipcforge.session import cut_lineage, shared_path  # noqa: E402
from ipcforge.sources import tables  # noqa: E402
import entry_inputs as inputs  # noqa: E402

FLAGSHIP_SF = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: rows per (bulletin month, label) of the long training table."""
    return long_ops.label_distribution_by_month(derived.long(spark, FLAGSHIP_SF))


# --------------------------------------------------------------------------
# Spark queries
# --------------------------------------------------------------------------


def q_label_distribution_by_month(spark, sf):
    return long_ops.label_distribution_by_month(derived.long(spark, sf))


def q_wide_to_long(spark, sf):
    return derived.long(spark, sf)


def q_wide_to_long_encoded(spark, sf):
    """Same rows through the '|'-encoded interchange form (P4 -> P5/P6 -> D1)."""
    return long_ops.wide_to_long(encode_wide(derived.wide(spark, sf)))


def q_build_wide(spark, sf):
    enc = encode_wide(derived.wide(spark, sf))
    return enc.withColumn("error_kind", error_kind()).drop("error")


def q_doc_lst_join(spark, sf):
    """J1 alone: good documents matched to their suggestion line (inner join)."""
    from ipcforge.operators.wide import doc_lst_join
    from ipcforge.sources.xmldocs import with_parse_status

    docs = with_parse_status(derived.parsed_documents(spark, sf)).where(F.col("doc_status") == "ok")
    joined = doc_lst_join(docs.select("source_file", "application_key"), derived.suggestion_lines(spark, sf))
    return joined.where(F.col("ai_line").isNotNull()).select("source_file", "application_key", "ai_line")


def q_read_wide(spark, sf):
    """The interchange form written and read back, with the columns that training takes."""
    import uuid

    from ipcforge.plans.jobs import TRAINING_COLUMNS, read_wide

    path = shared_path(spark, "tables", f"wide-{uuid.uuid4().hex}")
    encode_wide(derived.wide(spark, sf)).write.parquet(path)
    return read_wide(spark, path).select(*TRAINING_COLUMNS)


def q_train_candidates(spark, sf):
    """M1-M6: three boosted candidates, the number of trees decided by the validation rows.

    The derived labels hold no signal, so the target is one that score and
    rank decide.  Error values are the engine's own; what SQL can know is
    compared: names, order, row counts, and that every candidate's error is
    below half of the train mean's.
    """
    from ipcforge.operators.model import train_candidates

    target = F.when(F.col("ai_score") > 25, 1.0).when(F.col("rank") <= 2, 0.5).otherwise(0.0)
    long = cut_lineage(derived.long(spark, sf).withColumn("y", target), "long")
    runs = train_candidates(cut_lineage(split_long(long)))
    mean = inputs.mean_predictor_champion(inputs.split_sums(inputs.month_sums(long))).select(F.col("val_rmse").alias("mean_rmse"))
    return runs.join(F.broadcast(mean), F.lit(True)).select(
        "candidate_name", "ord", "n_train", "n_val",
        (F.col("val_rmse") < F.col("mean_rmse") * 0.5).alias("beats_mean"), (F.col("n_trees") > 0).alias("has_trees"))


def q_archive_documents(spark, sf):
    """The documents written as monthly archives and read back by the data source."""
    import uuid

    from ipcforge.sources import archives
    from ipcforge.sources.xmldocs import with_parse_status

    folder = shared_path(spark, "tables", f"archives-{uuid.uuid4().hex}")
    archives.write_archives(derived.documents(spark, sf), folder)
    archives.register(spark)
    docs = with_parse_status(spark.read.format(archives.FORMAT).options(**archives.archive_options(spark, folder)).load())
    ex = expert_codes("ipc_texts")
    return docs.select("bulletin_code", "source_file", "application_key", F.col("doc_status").alias("status"),
                       F.size(ex).cast("int").alias("expert_ipc_count"), F.array_join(ex, "|").alias("expert_ipc_canon"))


def q_train_candidates_label(spark, sf):
    """The same fits on the derived labels, which hold no signal: a candidate that is fitted and cut right stays near the train mean."""
    from ipcforge.operators.model import train_candidates

    long = cut_lineage(derived.long(spark, sf), "long")
    runs = train_candidates(cut_lineage(split_long(long)))
    mean = inputs.mean_predictor_champion(inputs.split_sums(inputs.month_sums(long))).select(F.col("val_rmse").alias("mean_rmse"))
    return runs.join(F.broadcast(mean), F.lit(True)).select(
        "candidate_name", "ord", "n_train", "n_val",
        (F.col("val_rmse") < F.col("mean_rmse") * 1.3).alias("near_mean"), (F.col("n_trees") > 0).alias("has_trees"))


def q_train_select_jobs(spark, sf):
    """K1, S6, S7, K3, K4, S8, S9, K5 through the jobs: a written dataset, one training round, one selection."""
    import uuid

    from ipcforge.plans import jobs

    root = shared_path(spark, "tables", f"jobs-{uuid.uuid4().hex}")
    wide = derived.wide_table(spark, sf)
    last = month_ops.month_range(wide).first()["last_month"]
    encode_wide(wide).write.parquet(f"{root}/dataprep/{jobs.dataset_file(spark, last, 12)}")
    jobs.train_job(spark, f"{root}/dataprep", f"{root}/models", "last", 12, max_iter=10)
    result = jobs.select_job(spark, f"{root}/models", f"{root}/prod")
    runs = jobs.read_results(spark, f"{root}/models/results")
    saved = [r["model_key"] for r in runs.select("model_key").collect() if jobs.path_exists(spark, r["model_key"])]  # one per candidate
    registry = jobs.read_table(spark, f"{root}/prod/registry", jobs.REGISTRY_SCHEMA)
    champion = registry.where(F.col("slot") == "champion").agg(F.count(F.lit(1)).alias("n_champions"), F.max("run_id").alias("run"))
    return runs.join(F.broadcast(champion), F.lit(True)).select(
        "candidate_name", "ord", "model_version", "n_train", "n_val", "training_last_month_resolved", "n_champions",
        F.col("model_key").isin(saved).alias("model_saved"), F.lit(result["promote"]).alias("promoted"),
        (F.col("run") == F.lit(result["best_new"]["run_id"])).alias("best_is_champion"))


def q_bulletin_counts(spark, sf):
    return bulletin_counts(derived.wide(spark, sf))


def q_parse_ai_line(spark, sf):
    files = derived.suggestion_lines(spark, sf, all_orders=True)
    items = files.select("application_key", F.posexplode(parse_ai_line("ai_line")).alias("pos", "it"))
    return items.select(
        "application_key",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("it.raw").alias("raw"),
        F.col("it.canon").alias("canon"),
        F.col("it.score").alias("score"),
    )


def _code_variants(cl: DataFrame) -> DataFrame:
    sec, mg, sg = F.col("sec"), F.col("mg"), F.col("sg")
    variants = F.array(
        F.col("raw_code"),
        F.concat(sec, F.lit("01K "), F.lpad(mg, 6, "0"), F.lit("/"), sg),
        F.concat(sec, F.lit("01K 0000 "), mg, F.lit("/"), sg),
        F.concat(mg, sg, sg, sg),
        F.concat(F.lower(sec), F.lit("01k\t"), mg, F.lit("/"), sg, F.lit("\n")),
        F.concat(sec, F.lit("01K "), mg, F.lit("/"), sg, F.lit(" (2006.01)")),
        F.concat(F.lit("  "), sec, F.lit("01K"), mg, F.lit(" /"), sg),
        F.concat(sec, F.lit("01K "), mg, F.lit("/"), sg),
    )
    return cl.select("l_orderkey", "l_linenumber", F.posexplode(variants).alias("variant", "raw"))


def q_canonicalize_code(spark, sf):
    v = _code_variants(derived.lines(spark, sf))
    return v.select("l_orderkey", "l_linenumber", F.col("variant").cast("int").alias("variant"),
                    canonicalize_code("raw").alias("canon"))


def q_expert_codes(spark, sf):
    parsed = derived.parsed_documents(spark, sf)  # a malformed document has an empty list, as in the wide table
    ex = expert_codes("ipc_texts")
    return parsed.select(
        "source_file",
        F.size(ex).cast("int").alias("expert_ipc_count"),
        F.array_join(ex, "|").alias("expert_ipc_canon"),
    )


def q_code_parts(spark, sf):
    cl = derived.lines(spark, sf)
    parts = code_parts("raw_code")
    return cl.select(
        "l_orderkey", "l_linenumber",
        main_group_of("raw_code").alias("ipc_main"),
        parts["section"].alias("section"), parts["class2"].alias("class2"),
        parts["subclass"].alias("subclass"), parts["main_group"].alias("main_group"),
        parts["subgroup"].alias("subgroup"),
    )


def q_exact_match_semi(spark, sf):
    return long_ops.exact_match_semi(derived.wide(spark, sf))


def q_main_match_semi(spark, sf):
    return long_ops.main_match_semi(derived.wide(spark, sf))


def q_unmatched_anti(spark, sf):
    return long_ops.unmatched_anti(derived.wide(spark, sf))


def q_top_k_codes(spark, sf):
    return long_ops.top_k_codes(derived.long(spark, sf), k=2)


def q_month_split(spark, sf):
    return month_split(derived.long(spark, sf))


def q_split_counts(spark, sf):
    return split_counts(split_long(derived.long_table(spark, sf, "bulletin_code")))


def q_evaluate_fixed_predictor(spark, sf):
    m = evaluate_by_month(derived.long(spark, sf), inputs.fixed_predictions()["v1_reg_base"])
    return m.select(F.round("val_rmse", 6).alias("val_rmse"), F.round("val_mae", 6).alias("val_mae"),
                    "n_train", "n_val")


_FEATURES = ("patent_id", "bulletin_code", "ai_score", "rank", "main_group", "subgroup", "section", "class2", "subclass", "y")


def q_fill_features(spark, sf):
    return fill_features(split_long(derived.long_table(spark, sf))).select("split", *_FEATURES)


def q_project_features(spark, sf):
    return project_features(derived.long(spark, sf), use_ipc_parts=True, keep=("patent_id", "bulletin_code"))


def q_list_bulletins(spark, sf):
    return month_ops.list_bulletins(tables.bulletin_keys(spark, sf), "pub/")


def q_list_datasets(spark, sf):
    return month_ops.list_datasets(tables.dataset_keys(spark, sf), "dataprep/")


def q_month_range(spark, sf):
    return month_ops.month_range(derived.long(spark, sf))


def _order_months(spark, sf) -> DataFrame:
    o = tables.read_table(spark, sf, "orders")
    return o.select(month_code_of("o_orderdate").alias("bulletin_code"))


def q_month_window(spark, sf):
    starts = month_ops.distinct_months(_order_months(spark, sf)).withColumnRenamed("bulletin_code", "last_month")
    return month_ops.month_window(starts, 3)


def q_window_filter(spark, sf):
    docs = derived.documents(spark, sf).select("bulletin_code", "source_file")
    latest = month_ops.month_range(docs).select("last_month")
    window = month_ops.month_window(latest, 10)
    kept = month_ops.window_filter(docs, window)
    return kept.groupBy("bulletin_code").agg(F.count(F.lit(1)).alias("n_docs"))


def q_resolve_month(spark, sf):
    available = month_ops.list_bulletins(tables.bulletin_keys(spark, sf), "pub/")
    m = month_ops.distinct_months(_order_months(spark, sf)).select(F.col("bulletin_code").alias("m"))
    shifted = F.format_string("%d%s", F.substr("m", F.lit(1), F.lit(4)).cast("int") + 10, F.substr("m", F.lit(5), F.lit(2)))
    requests = (
        m.select(F.col("m").alias("requested"))
        .unionByName(m.select(shifted.alias("requested")))
        .unionByName(m.select(F.substr("m", F.lit(1), F.lit(5)).alias("requested")))
        .unionByName(month_ops.month_range(m, "m").select(F.lit("last").alias("requested")))
    )
    return month_ops.resolve_month(available, requests).select("requested", "resolved", "status")


def q_dataset_name(spark, sf):
    o = tables.read_table(spark, sf, "orders")
    pairs = o.select(month_code_of("o_orderdate").alias("bulletin_code"),
                     (F.col("o_orderkey") % 12 + 1).cast("int").alias("n")).distinct()
    return pairs.select("bulletin_code", "n", dataset_name("bulletin_code", "n").alias("dataset_name"))


def _r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


def _split_sums(spark, sf) -> DataFrame:
    """A row per month, written once: all registry checks start from it."""
    return inputs.split_sums(cut_lineage(inputs.month_sums(derived.long(spark, sf)), "month_sums"))


def q_candidate_grid(spark, sf):
    """The candidate grid with the rows that each candidate trains and validates on."""
    counts = inputs.side_counts(_split_sums(spark, sf))  # one row
    return reg_ops.candidate_grid(spark).join(F.broadcast(counts), F.lit(True))


def q_candidate_metrics(spark, sf):
    runs = inputs.fixed_candidate_runs(_split_sums(spark, sf))
    return runs.select("candidate_name", "ord", *_r6("val_rmse", "val_mae"), "n_train", "n_val")


def q_best_candidate(spark, sf):
    best = reg_ops.best_candidate(inputs.fixed_candidate_runs(_split_sums(spark, sf)))
    return best.select("candidate_name", "ord", *_r6("val_rmse", "val_mae"), "n_train", "n_val")


def q_promotion_decision(spark, sf):
    split = _split_sums(spark, sf)
    runs, champion = inputs.fixed_candidate_runs(split), inputs.mean_predictor_champion(split)
    decision = reg_ops.promotion_decision(reg_ops.best_candidate(runs), champion, margin=0.0)
    return decision.select(
        "candidate_name", *_r6("val_rmse", "champion_rmse", "threshold"), "promote", "reason_code"
    )


def q_promotion_cases(spark, sf):
    """No champion, a tie, a positive margin, NaN on either side, two champion rows."""
    split = _split_sums(spark, sf)
    best = reg_ops.best_candidate(inputs.fixed_candidate_runs(split))
    champion = inputs.mean_predictor_champion(split)
    nan = F.lit(float("nan"))
    same = champion.drop("val_rmse").join(F.broadcast(best.select("val_rmse")), F.lit(True))
    older = same.withColumn("model_version", F.lit("0"))
    cases = {
        "no_champion": (best, champion.where(F.lit(False)), 0.0),
        "tie": (best, same, 0.0),
        "margin": (best, champion, 0.05),
        "nan_champion": (best, champion.withColumn("val_rmse", nan), 0.0),
        "nan_candidate": (best.withColumn("val_rmse", nan), champion, 0.0),
        "two_champions": (best, champion.unionByName(older), 0.0),
    }
    out = None
    for name, (new, held, margin) in cases.items():
        one = reg_ops.promotion_decision(new, held, margin).select(F.lit(name).alias("case"), "promote", "reason_code")
        out = one if out is None else out.unionByName(one)
    return out


def _registered(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Registered runs, champion and decision, a few rows, written once."""
    split = _split_sums(spark, sf)
    champion = cut_lineage(inputs.mean_predictor_champion(split), "champion")
    versions = champion.select("model_name", "model_version", "run_id")
    runs = cut_lineage(reg_ops.register_versions(versions, inputs.fixed_candidate_runs(split)), "runs")
    return runs, champion, reg_ops.promotion_decision(reg_ops.best_candidate(runs), champion, margin=0.0)


def q_rotate_slots(spark, sf):
    _, champion, decision = _registered(spark, sf)
    state = reg_ops.rotate_slots(champion, decision)
    return state.select("slot", "candidate_name", *_r6("val_rmse"), "model_version")


def q_register_version(spark, sf):
    """Two training rounds over the same data."""
    split = cut_lineage(_split_sums(spark, sf), "split_sums")
    versions = inputs.seed_versions(split)
    first = reg_ops.register_versions(versions, inputs.fixed_candidate_runs(split, "round-1"))
    known = versions.unionByName(first.select("model_name", "model_version", "run_id"))
    second = reg_ops.register_versions(known, inputs.fixed_candidate_runs(split, "round-2"))
    cols = ["candidate_name", "model_name", "model_version"]
    return first.select(F.lit(1).alias("round"), *cols).unionByName(second.select(F.lit(2).alias("round"), *cols))


def q_set_alias(spark, sf):
    _, champion, decision = _registered(spark, sf)
    aliases = champion.select("model_name", F.explode(F.array(F.lit("airflow"), F.lit("baseline"))).alias("alias"),
                              "model_version")
    return reg_ops.set_alias(aliases, decision)


def q_run_metrics_map(spark, sf):
    m = reg_ops.run_metrics_map(inputs.fixed_candidate_runs(_split_sums(spark, sf)))
    both = F.map_concat(F.transform_values("metrics", lambda k, v: F.round(v, 6).cast("string")), "params")
    return m.select("candidate_name", F.explode(both).alias("entry", "value"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "label_distribution_by_month": q_label_distribution_by_month,
    "wide_to_long": q_wide_to_long,
    "wide_to_long_encoded": q_wide_to_long_encoded,
    "build_wide": q_build_wide,
    "bulletin_counts": q_bulletin_counts,
    "doc_lst_join": q_doc_lst_join,
    "parse_ai_line": q_parse_ai_line,
    "canonicalize_code": q_canonicalize_code,
    "expert_codes": q_expert_codes,
    "code_parts": q_code_parts,
    "exact_match_semi": q_exact_match_semi,
    "main_match_semi": q_main_match_semi,
    "unmatched_anti": q_unmatched_anti,
    "top_k_codes": q_top_k_codes,
    "month_split": q_month_split,
    "split_counts": q_split_counts,
    "read_wide": q_read_wide,
    "project_features": q_project_features,
    "candidate_grid": q_candidate_grid,
    "promotion_cases": q_promotion_cases,
    "evaluate_fixed_predictor": q_evaluate_fixed_predictor,
    "fill_features": q_fill_features,
    "list_bulletins": q_list_bulletins,
    "list_datasets": q_list_datasets,
    "month_range": q_month_range,
    "month_window": q_month_window,
    "window_filter": q_window_filter,
    "resolve_month": q_resolve_month,
    "dataset_name": q_dataset_name,
    "candidate_metrics": q_candidate_metrics,
    "best_candidate": q_best_candidate,
    "promotion_decision": q_promotion_decision,
    "rotate_slots": q_rotate_slots,
    "register_version": q_register_version,
    "set_alias": q_set_alias,
    "run_metrics_map": q_run_metrics_map,
    "train_candidates": q_train_candidates,
    "train_candidates_label": q_train_candidates_label,
    "archive_documents": q_archive_documents,
    "train_select_jobs": q_train_select_jobs,
}


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the training-data subpackage, where it is installed."""
    try:
        import corpus_pipeline
        from ipcforge.llm import queries as llm_queries
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "ipcforge.llm"):
            raise
        return {}, {}
    oracle = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}, {**llm_queries.ORACLES, **oracle}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_llm()[0]}


# --------------------------------------------------------------------------
# DuckDB oracle: expected values from the base columns
# --------------------------------------------------------------------------

_BASE = """
lines AS (
  SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey,
    row_number() OVER (PARTITION BY l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'E' ELSE 'A' END
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS pos,
    substr('ABCDEFGH', CAST(l_orderkey % 8 AS INTEGER) + 1, 1) AS sec,
    CAST(31 + l_partkey % 3 AS VARCHAR) AS mg,
    lpad(CAST((l_suppkey % 3) * 10 AS VARCHAR), 2, '0') AS sg,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE concat(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), '.',
      lpad(CAST(l_linenumber * 13 AS VARCHAR), 2, '0')) END AS sc
  FROM lineitem),
codes AS (
  SELECT *, concat(sec, '01K ', mg, '/', sg) AS want, concat(sec, '01K ', mg, '/00') AS want_main,
    CASE l_linenumber % 4
      WHEN 0 THEN concat(sec, '01K ', mg, '/', sg)
      WHEN 1 THEN concat(lower(sec), '01k', mg, '/', sg)
      WHEN 2 THEN concat(sec, '01K  00', mg, ' / ', sg)
      ELSE concat(sec, '01K ', mg, '/', sg, ' 20060101AFI') END AS raw_code
  FROM lines),
patents AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k, strftime(o_orderdate, '%Y%m') AS bulletin_code,
    strftime(o_orderdate, '%Y%m%d') AS bulletin_date,
    concat(strftime(o_orderdate, '%Y%m'), '/', CAST(o_orderkey AS VARCHAR), '/Document.xml') AS source_file,
    CASE WHEN o_orderkey % 89 = 0 THEN 'malformed' WHEN o_orderkey % 97 = 0 THEN 'blank'
         WHEN o_orderkey % 11 = 0 THEN 'no_ai' ELSE 'ok' END AS status
  FROM orders),
expert AS (SELECT DISTINCT l_orderkey, want, want_main FROM codes WHERE l_returnflag = 'R'),
ai_all AS (
  SELECT l_orderkey, CASE WHEN coded THEN raw_code ELSE '20060101' END AS raw_code, CASE WHEN coded THEN want END AS want,
    want_main, sec, mg, sg, sc, CAST(sc AS DOUBLE) AS score, pos, coded,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY pos) AS INTEGER) AS place
  FROM (SELECT *, l_partkey % 13 <> 0 AS coded FROM codes WHERE l_returnflag <> 'R')),
ai AS (
  SELECT a.*, CAST(row_number() OVER (PARTITION BY a.l_orderkey ORDER BY a.pos) AS INTEGER) AS rank,
    p.k AS patent_id, p.bulletin_code, p.source_file
  FROM ai_all a JOIN patents p ON p.o_orderkey = a.l_orderkey WHERE p.status = 'ok' AND a.coded),
long AS (
  SELECT patent_id, bulletin_code, want AS ipc_code, want_main AS ipc_main, score AS ai_score, rank,
    CAST(CASE WHEN EXISTS (SELECT 1 FROM expert e WHERE e.l_orderkey = ai.l_orderkey AND e.want = ai.want) THEN 1.0
         WHEN EXISTS (SELECT 1 FROM expert e WHERE e.l_orderkey = ai.l_orderkey AND e.want_main = ai.want_main) THEN 0.5
         ELSE 0.0 END AS DOUBLE) AS y,
    sec AS section, '01' AS class2, 'K' AS subclass, CAST(mg AS INTEGER) AS main_group, CAST(sg AS INTEGER) AS subgroup,
    l_orderkey, source_file
  FROM ai),
months AS (
  SELECT bulletin_code, CAST(row_number() OVER (ORDER BY bulletin_code) AS INTEGER) AS month_idx,
    CAST(count(*) OVER () AS INTEGER) AS n_months
  FROM (SELECT DISTINCT bulletin_code FROM long)),
split_dim AS (
  SELECT *, CAST(floor(n_months * (CAST(2 AS DOUBLE) / 3)) AS INTEGER) AS n_train_months,
    CASE WHEN month_idx <= CAST(floor(n_months * (CAST(2 AS DOUBLE) / 3)) AS INTEGER) THEN 'train' ELSE 'val' END AS split
  FROM months),
split AS (SELECT l.*, d.split FROM long l LEFT JOIN split_dim d USING (bulletin_code))
"""

_WIDE = """
, good AS (
  SELECT p.source_file, concat('RU', p.k) AS patent_number, p.k AS application_number, p.bulletin_date,
    (SELECT CAST(count(*) AS INTEGER) FROM expert e WHERE e.l_orderkey = p.o_orderkey) AS expert_ipc_count,
    coalesce((SELECT string_agg(e.want, '|' ORDER BY e.want) FROM expert e WHERE e.l_orderkey = p.o_orderkey), '') AS expert_ipc_canon,
    concat('lst/', p.k, '.LST') AS lst_key, true AS lst_found,
    CAST(count(*) AS INTEGER) AS ai_ipc_count,
    string_agg(a.raw_code, '|' ORDER BY a.place) AS ai_ipc_raw,
    string_agg(coalesce(a.want, ''), '|' ORDER BY a.place) AS ai_ipc_canon,
    string_agg(coalesce(CAST(a.score AS VARCHAR), ''), '|' ORDER BY a.place) AS ai_scores,
    p.bulletin_code, CAST(NULL AS VARCHAR) AS error_kind
  FROM patents p JOIN ai_all a ON a.l_orderkey = p.o_orderkey
  WHERE p.status = 'ok'
  GROUP BY p.o_orderkey, p.k, p.source_file, p.bulletin_date, p.bulletin_code),
blank AS (
  SELECT p.source_file, concat('RU', p.k) AS patent_number, '' AS application_number, p.bulletin_date,
    (SELECT CAST(count(*) AS INTEGER) FROM expert e WHERE e.l_orderkey = p.o_orderkey) AS expert_ipc_count,
    coalesce((SELECT string_agg(e.want, '|' ORDER BY e.want) FROM expert e WHERE e.l_orderkey = p.o_orderkey), '') AS expert_ipc_canon,
    CAST(NULL AS VARCHAR) AS lst_key, false AS lst_found, 0 AS ai_ipc_count, '' AS ai_ipc_raw, '' AS ai_ipc_canon,
    '' AS ai_scores, p.bulletin_code, 'blank_application' AS error_kind
  FROM patents p WHERE p.status = 'blank'),
bad AS (
  SELECT p.source_file, CAST(NULL AS VARCHAR) AS patent_number, CAST(NULL AS VARCHAR) AS application_number,
    CAST(NULL AS VARCHAR) AS bulletin_date, 0 AS expert_ipc_count, '' AS expert_ipc_canon,
    CAST(NULL AS VARCHAR) AS lst_key, false AS lst_found, 0 AS ai_ipc_count, '' AS ai_ipc_raw, '' AS ai_ipc_canon,
    '' AS ai_scores, p.bulletin_code, 'malformed' AS error_kind
  FROM patents p WHERE p.status = 'malformed'),
wide_rows AS (SELECT * FROM good UNION ALL SELECT * FROM blank UNION ALL SELECT * FROM bad)
"""

_LONG_COLS = ("patent_id, bulletin_code, ipc_code, ipc_main, ai_score, rank, y, section, class2, subclass, "
              "main_group, subgroup")


def _sql(body: str) -> str:
    return "WITH " + _BASE.strip() + "\n" + body


# Fixed scorers of the registry checks (same in entry_inputs).
_CAND = """
cand AS (
  SELECT 'v1_reg_base' AS candidate_name, 1 AS ord,
    sqrt(avg(CASE WHEN split = 'val' THEN pow(y - coalesce(ai_score, 0) / 100.0, 2) END)) AS val_rmse,
    avg(CASE WHEN split = 'val' THEN abs(y - coalesce(ai_score, 0) / 100.0) END) AS val_mae,
    count(CASE WHEN split = 'train' THEN 1 END) AS n_train, count(CASE WHEN split = 'val' THEN 1 END) AS n_val
  FROM split
  UNION ALL
  SELECT 'v1_reg_shallow', 2,
    sqrt(avg(CASE WHEN split = 'val' THEN pow(y - 1.0 / rank, 2) END)),
    avg(CASE WHEN split = 'val' THEN abs(y - 1.0 / rank) END),
    count(CASE WHEN split = 'train' THEN 1 END), count(CASE WHEN split = 'val' THEN 1 END)
  FROM split
  UNION ALL
  SELECT 'v1_reg_no_ipc_parts', 3,
    sqrt(avg(CASE WHEN split = 'val' THEN pow(y - 0.25, 2) END)),
    avg(CASE WHEN split = 'val' THEN abs(y - 0.25) END),
    count(CASE WHEN split = 'train' THEN 1 END), count(CASE WHEN split = 'val' THEN 1 END)
  FROM split),
best AS (SELECT * FROM cand ORDER BY val_rmse, ord LIMIT 1),
champ AS (
  SELECT sqrt(avg(CASE WHEN split = 'val' THEN pow(y - (SELECT avg(y) FROM split WHERE split = 'train'), 2) END)) AS champion_rmse
  FROM split)
"""


def _cand_sql(body: str) -> str:
    return "WITH " + _BASE.strip() + ",\n" + _CAND.strip() + "\n" + body


_ORACLE = {
    "label_distribution_by_month": _sql(
        "SELECT bulletin_code, y, count(*) AS n_rows FROM long GROUP BY bulletin_code, y"),
    "wide_to_long": _sql(f"SELECT {_LONG_COLS} FROM long"),
    "wide_to_long_encoded": _sql(f"SELECT {_LONG_COLS} FROM long"),
    "build_wide": _sql(_WIDE + "SELECT * FROM wide_rows"),
    "read_wide": _sql(_WIDE + "SELECT application_number, bulletin_code, expert_ipc_canon, ai_ipc_canon, ai_scores FROM wide_rows"),
    "doc_lst_join": _sql("""
SELECT p.source_file, p.k AS application_key,
  concat('AI_IPC:', string_agg(CASE WHEN a.sc IS NULL THEN a.raw_code ELSE concat(a.raw_code, ' (', a.sc, '%)') END,
    ';' ORDER BY a.place), ';') AS ai_line
FROM patents p JOIN ai_all a ON a.l_orderkey = p.o_orderkey
WHERE p.status = 'ok'
GROUP BY p.source_file, p.k
"""),
    "bulletin_counts": _sql("""
, wide AS (
  SELECT bulletin_code, 1 AS good FROM patents p WHERE status = 'ok' AND EXISTS (SELECT 1 FROM ai_all a WHERE a.l_orderkey = p.o_orderkey)
  UNION ALL SELECT bulletin_code, 0 FROM patents WHERE status IN ('blank', 'malformed'))
SELECT bulletin_code, count(*) AS n_rows, count(CASE WHEN good = 1 THEN 1 END) AS n_good,
  count(CASE WHEN good = 0 THEN 1 END) AS n_error
FROM wide GROUP BY ROLLUP (bulletin_code)
"""),
    "parse_ai_line": _sql("""
SELECT CAST(l_orderkey AS VARCHAR) AS application_key, place AS rank, raw_code AS raw, want AS canon, score FROM ai_all
"""),
    "canonicalize_code": _sql("""
SELECT l_orderkey, l_linenumber, variant, canon FROM (
  SELECT l_orderkey, l_linenumber, 0 AS variant, want AS canon FROM codes
  UNION ALL SELECT l_orderkey, l_linenumber, 1, want FROM codes
  UNION ALL SELECT l_orderkey, l_linenumber, 2, concat(sec, '01K 0000 ', mg, '/', sg) FROM codes
  UNION ALL SELECT l_orderkey, l_linenumber, 3, CAST(NULL AS VARCHAR) FROM codes
  UNION ALL SELECT l_orderkey, l_linenumber, 4, want FROM codes
  UNION ALL SELECT l_orderkey, l_linenumber, 5, concat(want, ' (2006.01)') FROM codes
  UNION ALL SELECT l_orderkey, l_linenumber, 6, want FROM codes
  UNION ALL SELECT l_orderkey, l_linenumber, 7, want FROM codes)
"""),
    "expert_codes": _sql("""
SELECT p.source_file,
  CASE WHEN p.status = 'malformed' THEN 0 ELSE
    (SELECT CAST(count(*) AS INTEGER) FROM expert e WHERE e.l_orderkey = p.o_orderkey) END AS expert_ipc_count,
  CASE WHEN p.status = 'malformed' THEN '' ELSE
    coalesce((SELECT string_agg(e.want, '|' ORDER BY e.want) FROM expert e WHERE e.l_orderkey = p.o_orderkey), '') END AS expert_ipc_canon
FROM patents p
"""),
    "code_parts": _sql("""
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber % 4 WHEN 1 THEN concat(lower(sec), '01k', mg, '/00')
    WHEN 2 THEN concat(sec, '01K  00', mg, '/00') ELSE want_main END AS ipc_main,
  CASE WHEN l_linenumber % 4 = 3 THEN NULL WHEN l_linenumber % 4 = 1 THEN lower(sec) ELSE sec END AS section,
  CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE '01' END AS class2,
  CASE WHEN l_linenumber % 4 = 3 THEN NULL WHEN l_linenumber % 4 = 1 THEN 'k' ELSE 'K' END AS subclass,
  CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE CAST(mg AS INTEGER) END AS main_group,
  CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE CAST(sg AS INTEGER) END AS subgroup
FROM codes
"""),
    "exact_match_semi": _sql("""
SELECT patent_id, bulletin_code, source_file, rank, want AS ipc_code, want_main AS ipc_main FROM ai
WHERE EXISTS (SELECT 1 FROM expert e WHERE e.l_orderkey = ai.l_orderkey AND e.want = ai.want)
"""),
    "main_match_semi": _sql("""
SELECT patent_id, bulletin_code, source_file, rank, want AS ipc_code, want_main AS ipc_main FROM ai
WHERE EXISTS (SELECT 1 FROM expert e WHERE e.l_orderkey = ai.l_orderkey AND e.want_main = ai.want_main)
  AND NOT EXISTS (SELECT 1 FROM expert e WHERE e.l_orderkey = ai.l_orderkey AND e.want = ai.want)
"""),
    "unmatched_anti": _sql("""
SELECT patent_id, bulletin_code, source_file, rank, want AS ipc_code, want_main AS ipc_main FROM ai
WHERE NOT EXISTS (SELECT 1 FROM expert e WHERE e.l_orderkey = ai.l_orderkey AND e.want_main = ai.want_main)
"""),
    "top_k_codes": _sql(f"SELECT {_LONG_COLS} FROM long WHERE rank <= 2"),
    "month_split": _sql("SELECT bulletin_code, month_idx, n_months, n_train_months, split FROM split_dim"),
    "split_counts": _sql("SELECT split, count(*) AS n_rows FROM split GROUP BY split"),
    "evaluate_fixed_predictor": _sql("""
SELECT round(sqrt(avg(CASE WHEN split = 'val' THEN pow(y - coalesce(ai_score, 0) / 100.0, 2) END)), 6) AS val_rmse,
  round(avg(CASE WHEN split = 'val' THEN abs(y - coalesce(ai_score, 0) / 100.0) END), 6) AS val_mae,
  count(CASE WHEN split = 'train' THEN 1 END) AS n_train, count(CASE WHEN split = 'val' THEN 1 END) AS n_val
FROM split
"""),
    "fill_features": _sql("""
SELECT split, patent_id, bulletin_code, coalesce(ai_score, 0) AS ai_score, rank, coalesce(main_group, 0) AS main_group,
  coalesce(subgroup, 0) AS subgroup, coalesce(section, 'NA') AS section, coalesce(class2, 'NA') AS class2,
  coalesce(subclass, 'NA') AS subclass, y
FROM split
"""),
    "project_features": _sql("""
SELECT patent_id, bulletin_code, ai_score, rank, main_group, subgroup, section, class2, subclass, y FROM long
"""),
    "candidate_grid": _sql("""
SELECT g.*, count(CASE WHEN split = 'train' THEN 1 END) AS n_train, count(CASE WHEN split = 'val' THEN 1 END) AS n_val
FROM split, (VALUES ('v1_reg_base', CAST(1 AS INTEGER), CAST(6 AS INTEGER), CAST(0.05 AS DOUBLE), true),
  ('v1_reg_shallow', 2, 4, 0.05, true), ('v1_reg_no_ipc_parts', 3, 6, 0.05, false))
  AS g(candidate_name, ord, depth, learning_rate, use_ipc_parts)
GROUP BY ALL
"""),
    "train_candidates": _cand_sql("""
SELECT candidate_name, CAST(ord AS INTEGER) AS ord, n_train, n_val, true AS beats_mean, true AS has_trees FROM cand
"""),
    "archive_documents": _sql("""
SELECT p.bulletin_code, p.source_file, CASE WHEN p.status IN ('ok', 'no_ai') THEN p.k END AS application_key,
  CASE WHEN p.status = 'no_ai' THEN 'ok' ELSE p.status END AS status,
  CASE WHEN p.status = 'malformed' THEN 0 ELSE
    (SELECT CAST(count(*) AS INTEGER) FROM expert e WHERE e.l_orderkey = p.o_orderkey) END AS expert_ipc_count,
  CASE WHEN p.status = 'malformed' THEN '' ELSE
    coalesce((SELECT string_agg(e.want, '|' ORDER BY e.want) FROM expert e WHERE e.l_orderkey = p.o_orderkey), '') END AS expert_ipc_canon
FROM patents p
"""),
    "train_candidates_label": _cand_sql("""
SELECT candidate_name, CAST(ord AS INTEGER) AS ord, n_train, n_val, true AS near_mean, true AS has_trees FROM cand
"""),
    "train_select_jobs": _cand_sql("""
SELECT candidate_name, CAST(ord AS INTEGER) AS ord, CAST(ord AS VARCHAR) AS model_version, n_train, n_val,
  (SELECT max(bulletin_code) FROM patents) AS training_last_month_resolved, CAST(1 AS BIGINT) AS n_champions,
  true AS model_saved, true AS promoted, true AS best_is_champion
FROM cand
"""),
    "promotion_cases": _cand_sql("""
SELECT 'no_champion' AS "case", true AS promote, 'no_current_champion' AS reason_code FROM best
UNION ALL SELECT 'tie', false, 'threshold' FROM best
UNION ALL SELECT 'margin', b.val_rmse < c.champion_rmse * (1.0 - 0.05), 'threshold' FROM best b, champ c
UNION ALL SELECT 'nan_champion', false, 'threshold' FROM best
UNION ALL SELECT 'nan_candidate', false, 'threshold' FROM best
UNION ALL SELECT 'two_champions', b.val_rmse < c.champion_rmse, 'threshold' FROM best b, champ c
"""),
    "list_bulletins": """
SELECT bulletin_code, CAST(row_number() OVER (ORDER BY bulletin_code) AS INTEGER) AS pos
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS bulletin_code FROM orders WHERE o_orderkey % 5 <> 0)
""",
    "list_datasets": """
SELECT bulletin_code, CAST(row_number() OVER (ORDER BY bulletin_code) AS INTEGER) AS pos
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS bulletin_code FROM orders WHERE o_orderkey % 6 IN (0, 5))
""",
    "month_range": _sql("""
SELECT min(bulletin_code) AS first_month, max(bulletin_code) AS last_month, count(DISTINCT bulletin_code) AS n_months
FROM long
"""),
    "month_window": """
SELECT m AS last_month, CAST(p AS INTEGER) AS pos,
  strftime(CAST(strptime(m || '01', '%Y%m%d') AS DATE) - to_months(CAST(p - 1 AS INTEGER)), '%Y%m') AS bulletin_code
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS m FROM orders), generate_series(1, 3) AS g(p)
""",
    "window_filter": """
WITH d AS (SELECT strftime(o_orderdate, '%Y%m') AS bulletin_code, date_trunc('month', o_orderdate) AS ms FROM orders)
SELECT bulletin_code, count(*) AS n_docs FROM d
WHERE ms > (SELECT max(ms) FROM d) - INTERVAL 10 MONTH
GROUP BY bulletin_code
""",
    "resolve_month": """
WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS m FROM orders),
avail AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS c FROM orders WHERE o_orderkey % 5 <> 0),
req AS (
  SELECT m AS requested FROM m
  UNION ALL SELECT concat(CAST(CAST(substr(m, 1, 4) AS INTEGER) + 10 AS VARCHAR), substr(m, 5, 2)) FROM m
  UNION ALL SELECT substr(m, 1, 5) FROM m
  UNION ALL SELECT 'last')
SELECT requested,
  CASE WHEN requested = 'last' THEN (SELECT max(c) FROM avail)
       WHEN requested IN (SELECT c FROM avail) THEN requested END AS resolved,
  CASE WHEN requested = 'last' THEN 'ok'
       WHEN NOT regexp_full_match(requested, '[0-9]{6}') THEN 'bad_format'
       WHEN requested IN (SELECT c FROM avail) THEN 'ok' ELSE 'not_found' END AS status
FROM req
""",
    "dataset_name": """
SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS bulletin_code, CAST(o_orderkey % 12 + 1 AS INTEGER) AS n,
  concat('ipc_with_ai_', strftime(o_orderdate, '%Y%m'), '_last_', CAST(o_orderkey % 12 + 1 AS VARCHAR), '.parquet') AS dataset_name
FROM orders
""",
    "candidate_metrics": _cand_sql("""
SELECT candidate_name, CAST(ord AS INTEGER) AS ord, round(val_rmse, 6) AS val_rmse, round(val_mae, 6) AS val_mae,
  n_train, n_val FROM cand
"""),
    "best_candidate": _cand_sql("""
SELECT candidate_name, CAST(ord AS INTEGER) AS ord, round(val_rmse, 6) AS val_rmse, round(val_mae, 6) AS val_mae,
  n_train, n_val FROM best
"""),
    "promotion_decision": _cand_sql("""
SELECT b.candidate_name, round(b.val_rmse, 6) AS val_rmse, round(c.champion_rmse, 6) AS champion_rmse,
  round(c.champion_rmse * (1.0 - 0.0), 6) AS threshold, b.val_rmse < c.champion_rmse * (1.0 - 0.0) AS promote,
  'threshold' AS reason_code
FROM best b, champ c
"""),
    "rotate_slots": _cand_sql("""
, d AS (SELECT b.candidate_name, b.ord, b.val_rmse, b.val_rmse < c.champion_rmse AS promote, c.champion_rmse FROM best b, champ c)
SELECT 'champion' AS slot, CASE WHEN promote THEN candidate_name ELSE 'mean_predictor' END AS candidate_name,
  round(CASE WHEN promote THEN val_rmse ELSE champion_rmse END, 6) AS val_rmse,
  CASE WHEN promote THEN CAST(1 + ord AS VARCHAR) ELSE '1' END AS model_version FROM d
UNION ALL
SELECT 'previous', 'mean_predictor', round(champion_rmse, 6), '1' FROM d WHERE promote
"""),
    "register_version": _cand_sql("""
SELECT round, candidate_name, 'ipc_regressor' AS model_name, CAST(1 + 3 * (round - 1) + ord AS VARCHAR) AS model_version
FROM cand, (VALUES (CAST(1 AS INTEGER)), (2)) AS r(round)
"""),
    "set_alias": _cand_sql("""
SELECT 'ipc_regressor' AS model_name, 'airflow' AS alias,
  CASE WHEN b.val_rmse < c.champion_rmse THEN CAST(1 + b.ord AS VARCHAR) ELSE '1' END AS model_version
FROM best b, champ c
UNION ALL SELECT 'ipc_regressor', 'baseline', '1'
"""),
    "run_metrics_map": _cand_sql("""
, e AS (
  SELECT candidate_name, entry, CAST(value AS VARCHAR) AS value FROM (
    SELECT candidate_name, 'val_rmse' AS entry, round(val_rmse, 6) AS value FROM cand
    UNION ALL SELECT candidate_name, 'val_mae', round(val_mae, 6) FROM cand
    UNION ALL SELECT candidate_name, 'n_train', CAST(n_train AS DOUBLE) FROM cand
    UNION ALL SELECT candidate_name, 'n_val', CAST(n_val AS DOUBLE) FROM cand)
  UNION ALL SELECT candidate_name, 'candidate_name', candidate_name FROM cand
  UNION ALL SELECT candidate_name, 'input_key', 'derived' FROM cand
  UNION ALL SELECT candidate_name, 'training_last_month_resolved', NULL FROM cand
  UNION ALL SELECT candidate_name, 'months_window', NULL FROM cand
  UNION ALL SELECT candidate_name, 'train_frac', '0.666667' FROM cand
  UNION ALL SELECT candidate_name, 'random_state', '42' FROM cand
  UNION ALL SELECT candidate_name, 'depth', CASE WHEN ord = 2 THEN '4' ELSE '6' END FROM cand
  UNION ALL SELECT candidate_name, 'learning_rate', '0.05' FROM cand
  UNION ALL SELECT candidate_name, 'use_ipc_parts', CASE WHEN ord = 3 THEN 'false' ELSE 'true' END FROM cand)
SELECT candidate_name, entry, value FROM e
"""),
}


def oracle_sql() -> dict[str, str]:
    return {**{k: v for k, v in _ORACLE.items() if k in _QUERIES}, **_llm()[1]}
