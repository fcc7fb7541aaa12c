"""Best candidate, promotion decision, slot rotation, versions, aliases (FIXTURES.md §3.7)."""

from __future__ import annotations

import pytest

from ipcforge.operators import registry as reg
from ipcforge.plans.jobs import REGISTRY_SCHEMA


def _runs(spark, rmses):
    rows = [(name, ord_, f"run{ord_}", reg.MODEL_NAME, str(ord_ + 1), r, 0.1, 10, 5, f"m/{name}", f"m/{name}_meta.json", "in", "202603", 10)
            for (name, ord_, *_), r in zip(reg.CANDIDATES, rmses)]
    return spark.createDataFrame(
        rows,
        "candidate_name string, ord int, run_id string, model_name string, model_version string, val_rmse double, "
        "val_mae double, n_train long, n_val long, model_key string, meta_key string, input_key string, "
        "training_last_month_resolved string, months_window int",
    )


def _registry(spark, champion_rmse):
    rows = [] if champion_rmse is None else [
        ("champion", "old", reg.MODEL_NAME, "1", "r0", champion_rmse, 0.2, "in", "m/old", None),
        ("previous", "older", reg.MODEL_NAME, "0", "r-1", 0.5, 0.3, "in", "m/older", None),
    ]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


@pytest.mark.parametrize(
    "best,champ,margin,promote",
    [(0.30, None, 0.0, True), (0.30, 0.31, 0.0, True), (0.31, 0.31, 0.0, False),
     (0.30, 0.31, 0.1, False), (0.27, 0.31, "0.1", True)],
)
def test_promotion_table(spark, best, champ, margin, promote):
    runs = _runs(spark, [best, best + 0.01, best + 0.02])
    d = reg.promotion_decision(reg.best_candidate(runs), _registry(spark, champ), margin).first()
    assert d["promote"] is promote
    if champ is None:
        assert d["reason"] == "no_current_champion"
    else:
        assert d["reason"].startswith("new_rmse=")


def test_bad_margin(spark):
    runs = _runs(spark, [0.3, 0.3, 0.3])
    with pytest.raises(ValueError):
        reg.promotion_decision(reg.best_candidate(runs), _registry(spark, None), "abc")


def test_ties_and_nan(spark):
    assert reg.best_candidate(_runs(spark, [0.3, 0.3, 0.3])).first()["candidate_name"] == "v1_reg_base"
    assert reg.best_candidate(_runs(spark, [0.4, 0.3, 0.3])).first()["candidate_name"] == "v1_reg_shallow"
    assert reg.best_candidate(_runs(spark, [float("nan"), None, 0.9])).first()["candidate_name"] == "v1_reg_no_ipc_parts"


def test_rotate_slots(spark):
    runs = _runs(spark, [0.2, 0.3, 0.4])
    registry = _registry(spark, 0.31)
    d = reg.promotion_decision(reg.best_candidate(runs), registry, 0.0)
    state = {r["slot"]: r for r in reg.rotate_slots(registry, d).collect()}
    assert set(state) == {"champion", "previous"}
    assert state["champion"]["candidate_name"] == "v1_reg_base" and state["champion"]["promoted_at_utc"] is not None
    assert state["previous"]["candidate_name"] == "old"
    # no champion yet: the candidate becomes champion, nothing else appears
    empty = _registry(spark, None)
    d0 = reg.promotion_decision(reg.best_candidate(runs), empty, 0.0)
    assert [r["slot"] for r in reg.rotate_slots(empty, d0).collect()] == ["champion"]
    # no promotion: state unchanged
    d1 = reg.promotion_decision(reg.best_candidate(_runs(spark, [0.9, 0.9, 0.9])), registry, 0.0)
    assert sorted(r["candidate_name"] for r in reg.rotate_slots(registry, d1).collect()) == ["old", "older"]


def test_versions_and_alias(spark):
    runs = _runs(spark, [0.2, 0.3, 0.4]).drop("model_version")
    from pyspark.sql import functions as F

    runs = runs.withColumn("model_version", F.lit(None).cast("string"))
    versions = spark.createDataFrame([(reg.MODEL_NAME, "4", "x")], "model_name string, model_version string, run_id string")
    got = {r["candidate_name"]: r["model_version"] for r in reg.register_versions(versions, runs).collect()}
    assert got == {"v1_reg_base": "5", "v1_reg_shallow": "6", "v1_reg_no_ipc_parts": "7"}
    d = reg.promotion_decision(reg.best_candidate(reg.register_versions(versions, runs)), _registry(spark, None), 0.0)
    aliases = spark.createDataFrame([(reg.MODEL_NAME, "airflow", "4"), (reg.MODEL_NAME, "other", "2")],
                                    "model_name string, alias string, model_version string")
    out = {r["alias"]: r["model_version"] for r in reg.set_alias(aliases, d).collect()}
    assert out == {"airflow": "5", "other": "2"}


def test_same_run_id_in_an_earlier_round_does_not_multiply_rows(spark):
    from pyspark.sql import functions as F

    runs = _runs(spark, [0.2, 0.3, 0.4]).withColumn("model_version", F.lit(None).cast("string"))
    versions = spark.createDataFrame([], "model_name string, model_version string, run_id string")
    for first in (1, 4, 7):
        got = reg.register_versions(versions, runs)
        assert sorted(int(r["model_version"]) for r in got.collect()) == [first, first + 1, first + 2]
        versions = versions.unionByName(got.select("model_name", "model_version", "run_id"))


def test_nan_and_two_champions(spark):
    runs = _runs(spark, [0.30, 0.31, 0.32])
    assert reg.promotion_decision(reg.best_candidate(runs), _registry(spark, float("nan"))).first()["promote"] is False
    twice = _registry(spark, 0.31).unionByName(_registry(spark, 0.2).where("slot = 'champion'"))
    assert reg.promotion_decision(reg.best_candidate(runs), twice).count() == 1


def test_unknown_candidate():
    with pytest.raises(ValueError):
        reg.candidate_config("nope")


def test_run_metrics_map(spark):
    runs = _runs(spark, [0.2, 0.3, 0.4])
    row = reg.run_metrics_map(runs).where("candidate_name = 'v1_reg_base'").first()
    assert row["metrics"]["val_rmse"] == 0.2 and row["metrics"]["n_val"] == 5.0
    assert row["params"]["training_last_month_resolved"] == "202603" and row["params"]["months_window"] == "10"
