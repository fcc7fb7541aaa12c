"""Model acceptance: beats the mean predictor on learnable data; deterministic."""

from __future__ import annotations

import os
import tempfile

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF_SMALL
from entry_inputs import mean_predictor_champion, month_sums, split_sums
from ipcforge.operators.model import train_regressor
from ipcforge.operators.registry import candidate_config
from ipcforge.operators.split import split_long
from ipcforge.plans import derived
from ipcforge.session import cut_lineage


def _learnable_split(spark):
    long = derived.long(spark, SF_SMALL).withColumn(
        "y",
        F.when(F.col("ai_score") > 25, 1.0).when(F.col("rank") <= 2, 0.5).otherwise(0.0),
    )
    return cut_lineage(split_long(cut_lineage(long)))


def test_gbt_beats_mean_and_is_deterministic(spark):
    split = _learnable_split(spark)
    train, val = split.where("split = 'train'"), split.where("split = 'val'")
    cfg = candidate_config("v1_reg_base")
    model, m1 = train_regressor(train, val, cfg, max_iter=8)
    _, m2 = train_regressor(train, val, cfg, max_iter=8)
    mean_rmse = mean_predictor_champion(split_sums(month_sums(split))).first()["val_rmse"]
    assert m1["val_rmse"] < 0.5 * mean_rmse
    assert m1 == m2
    assert 1 <= m1["n_trees"] <= 8
    # K4: saved pipeline reloads and predicts identically
    path = os.path.join(tempfile.mkdtemp(prefix="ipcforge-model-"), "m")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = model.transform(val.na.fill(0, ["ai_score", "main_group", "subgroup"]).na.fill("NA", ["section", "class2", "subclass"]))
    b = again.transform(val.na.fill(0, ["ai_score", "main_group", "subgroup"]).na.fill("NA", ["section", "class2", "subclass"]))
    assert a.select(F.sum("prediction")).first()[0] == b.select(F.sum("prediction")).first()[0]


def test_validation_rows_decide_the_number_of_trees(spark):
    """The kept trees are a prefix of the longer run, and no shorter run is better by the tolerance."""
    split = _learnable_split(spark)
    train, val = split.where("split = 'train'"), split.where("split = 'val'")
    cfg = candidate_config("v1_reg_no_ipc_parts")
    _, watched = train_regressor(train, val, cfg, max_iter=12, tolerance=0.01)
    _, full = train_regressor(train, val, cfg, max_iter=12, tolerance=None)
    assert full["n_trees"] == 12 and 1 <= watched["n_trees"] <= 12
    _, same = train_regressor(train, val, cfg, max_iter=watched["n_trees"], tolerance=None)
    assert same["val_rmse"] == watched["val_rmse"]


def test_noisy_labels_do_not_end_the_fit(spark):
    """The whole number of trees is grown by default, and the kept prefix is the best one."""
    noise = F.pmod(F.xxhash64("patent_id", "rank"), F.lit(1000)) / 1000.0 - 0.5
    split = cut_lineage(_learnable_split(spark).withColumn("y", F.col("y") + 4 * noise))
    train, val = split.where("split = 'train'"), split.where("split = 'val'")
    cfg = candidate_config("v1_reg_no_ipc_parts")
    _, early = train_regressor(train, val, cfg, max_iter=15, tolerance=0.001)
    _, m = train_regressor(train, val, cfg, max_iter=15)
    assert early["n_trees"] < m["n_trees"] and m["val_rmse"] < early["val_rmse"]
    # labels without signal: later trees only fit noise, a shorter prefix is the model, saved and read as such
    split = cut_lineage(split.withColumn("y", 4 * noise))
    train, val = split.where("split = 'train'"), split.where("split = 'val'")
    model, m = train_regressor(train, val, cfg, max_iter=10)
    _, full = train_regressor(train, val, cfg, max_iter=10, tolerance=None)
    assert m["n_trees"] < full["n_trees"] == 10 and m["val_rmse"] < full["val_rmse"]
    path = os.path.join(tempfile.mkdtemp(prefix="ipcforge-model-"), "m")
    model.write().overwrite().save(path)
    assert PipelineModel.load(path).stages[-1].getNumTrees == model.stages[-1].getNumTrees == m["n_trees"]
    assert model.stages[-1].getMaxIter() == 10 and model.stages[-1].getLabelCol() == "y"
