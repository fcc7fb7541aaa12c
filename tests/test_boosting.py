"""Target statistics and boosted trees on cells, against plain versions and Spark ML's trees on rows."""

from __future__ import annotations

import collections
import random
import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from ipcforge.operators import boosting, target_stats
from ipcforge.operators.model import train_models

BASE = {"name": "b", "depth": 4, "learning_rate": 0.1, "use_ipc_parts": True}
PLAIN = {"name": "p", "depth": 3, "learning_rate": 0.1, "use_ipc_parts": False}


def _rows(n, seed=0):
    """Noisy rows; one category holds a third of them, some values are missing."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        section = "H" if i % 3 == 0 else rnd.choice(["A", "B", None, "C"])
        score, rank = float(rnd.randint(0, 40)), rnd.randint(1, 8)
        y = 0.03 * score + (rank <= 2) + (section == "A") * 0.5 + rnd.randint(-8, 8) / 8
        out.append((score if i % 17 else None, rank, rnd.randint(1, 5), rnd.randint(0, 9) * 10, section, f"{i % 4:02d}", rnd.choice("KLM"), y))
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "ai_score double, rank int, main_group int, subgroup int, section string, class2 string, subclass string, y double")


def test_ordered_statistics_see_earlier_rows_only(spark, monkeypatch):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"c{i % 5}" if i % 7 else None, i % 4 / 2 if i % 11 else None) for i in range(900)]
                               + [(5, "hot", 1.0), (5, "hot", 1.0)], "i long, c string, y double")
    order = {tuple(r)[:3]: r["o"] for r in df.withColumn("o", F.shiftrightunsigned(F.xxhash64(*df.columns), 2)).collect()}
    want = {}
    rows = [tuple(r) for r in df.collect()]
    for r in rows:
        before = [x[2] for x in rows if (x[1] or "NA") == (r[1] or "NA") and order[x] < order[r] and x[2] is not None]
        want[r] = (sum(before) + 0.25) / (len(before) + 1)
    for size in (50_000, 40, 7):
        monkeypatch.setattr(target_stats, "SLOT_ROWS", size)
        got = target_stats.ordered_stats(df, ["c"], "y", 0.25, df.count()).collect()
        assert collections.Counter(tuple(r)[:3] for r in got) == collections.Counter(rows)
        for r in got:
            assert r["c_ts"] == pytest.approx(want[tuple(r)[:3]], abs=1e-12)


def test_other_rows_get_the_whole_statistics(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("a", None), (None, 2.0)], "c string, y double")
    stats = target_stats.category_stats(train, ["c"], "y")
    assert sorted((r["category"], r["n"], r["total"]) for r in stats.collect()) == [("NA", 1, 2.0), ("a", 2, 1.0)]
    new = spark.createDataFrame([("a", 1), (None, 2), ("new", 3), ("a", 1)], "c string, i int")
    got = sorted((r["i"], r["c_ts"]) for r in target_stats.encode_with(new, stats, ["c"], 1.0).collect())
    assert got == [(1, 2 / 3), (1, 2 / 3), (2, 1.5), (3, 1.0)]


def _cells(spark, rows, features):
    df = _frame(spark, rows).select(*[F.coalesce(F.col(f).cast("int"), F.lit(0)).alias(f) for f in features], "y")
    train, val = df.where(F.pmod(F.xxhash64(*features), F.lit(4)) > 0), df.where(F.pmod(F.xxhash64(*features), F.lit(4)) == 0)
    return train, val, boosting.feature_cells(train, val, features, "y")


def test_cells_grow_the_trees_of_the_rows(spark):
    """Same splits, predictions and validation errors as Spark ML's fit on the single rows."""
    features = ["ai_score", "rank", "main_group", "subgroup"]
    train, val, cells = _cells(spark, _rows(1500), features)
    assert cells.count() < train.count() + val.count()
    configs = [boosting.TreeConfig([0, 1, 2, 3], 4, 0.1), boosting.TreeConfig([0, 1], 2, 0.3)]
    grown = boosting.grow_trees(cells, features, configs, 12, 1, bins=128)
    for cfg, trees in zip(configs, grown):
        names = [features[f] for f in cfg.features]
        assembler = VectorAssembler(inputCols=names, outputCol="features")
        plain = GBTRegressor(labelCol="y", maxDepth=cfg.depth, stepSize=cfg.rate, maxIter=12, maxBins=128, seed=1).fit(assembler.transform(train))
        rows = plain.transform(assembler.transform(val)).collect()
        got = trees.predict(np.array([[r[n] for n in features] for r in rows]))
        assert got == pytest.approx([r["prediction"] for r in rows], abs=1e-9)
        assert trees.errors == pytest.approx(plain.evaluateEachIteration(assembler.transform(val), "squared"), rel=1e-9)
        for t, tree in enumerate(plain.trees):
            assert (trees.feature[t] >= 0).sum() == (tree.numNodes - 1) // 2


def test_parts_and_stages_grow_the_same_trees(spark):
    features = ["ai_score", "rank", "main_group"]
    _, _, cells = _cells(spark, _rows(800, seed=4), features)
    configs = [boosting.TreeConfig([0, 1, 2], 3, 0.1), boosting.TreeConfig([0, 1], 4, 0.1)]
    one = boosting.grow_trees(cells, features, configs, 9, 1)
    for parts, per_stage in ((1, 4), (3, 9), (4, 5)):
        other = boosting.grow_trees(cells, features, configs, 9, parts, per_stage=per_stage)
        for a, b in zip(one, other):
            assert (a.feature == b.feature).all() and (a.bin == b.bin).all()
            assert np.abs(a.value - b.value).max() < 1e-9 and a.errors == pytest.approx(b.errors, rel=1e-9)
    # more tasks than cells: some hold none
    few = cells.limit(2)
    few = few.sparkSession.createDataFrame(few.collect(), few.schema)
    a, b = (boosting.grow_trees(few, features, configs, 3, n) for n in (1, 4))
    assert a[0].errors == pytest.approx(b[0].errors, rel=1e-9, nan_ok=True)


def test_kept_trees():
    assert boosting.kept_trees([3.0, 2.0, 2.5, 1.9, 2.0], 0.0) == 4
    assert boosting.kept_trees([3.0, 2.0, 2.5, 1.9], None) == 4
    assert boosting.kept_trees([3.0, 2.0, 1.999, 1.0], 0.01) == 2
    assert boosting.kept_trees([float("nan")] * 3, 0.0) == 3


def test_candidates_together_equal_candidates_alone(spark):
    rows = _rows(900, seed=2)
    train, val = _frame(spark, rows[:600]), _frame(spark, rows[600:])
    both = train_models(train, val, [BASE, PLAIN], max_iter=15)
    mean = np.mean([r[-1] for r in rows[:600]])
    base = float(np.sqrt(np.mean([(r[-1] - mean) ** 2 for r in rows[600:]])))
    for cfg, (model, metrics) in zip([BASE, PLAIN], both):
        assert metrics["val_rmse"] < 0.95 * base and metrics["n_val"] == 300
        if not cfg["use_ipc_parts"]:
            alone = train_models(train, val, [cfg], max_iter=15)[0][1]
            assert alone["n_trees"] == metrics["n_trees"] and alone["val_rmse"] == pytest.approx(metrics["val_rmse"], rel=1e-12)
        # M4 on rows gives the error of the fit
        pred = model.transform(val)
        assert pred.columns == [*val.columns, "prediction"]
        assert pred.select(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)))).first()[0] == pytest.approx(metrics["val_rmse"], rel=1e-9)
    path = tempfile.mkdtemp(prefix="ipcforge-model-") + "/m"
    both[0][0].write().overwrite().save(path)
    again = PipelineModel.load(path)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, again.transform(val).collect()), key=key) == sorted(map(tuple, both[0][0].transform(val).collect()), key=key)
    # unknown and missing categories and values score too
    odd = _frame(spark, [(None, None, None, None, None, None, None, None), (float("nan"), 1, 1, 1, "new", "new", "new", 0.0)])
    assert all(np.isfinite(r["prediction"]) for r in again.transform(odd).collect())


def test_tasks_exchange_without_waiting_for_barrier_calls(spark):
    """Trees of many tasks take no second per level, leave no file, and are those of one task and of barrier calls."""
    import os
    import time

    from ipcforge.session import ensure_checkpoint_dir

    features = ["ai_score", "rank", "main_group", "subgroup"]
    cells = _cells(spark, _rows(1500), features)[2].cache()
    config = [boosting.TreeConfig([0, 1, 2, 3], 3, 0.1), boosting.TreeConfig([0, 1], 2, 0.1)]
    cells.count()
    began = time.time()
    many = boosting.grow_trees(cells, features, config, 12, 3, bins=100, per_stage=6)
    assert time.time() - began < 24  # 12 trees of 4 steps: 48 barrier calls would take 48 s
    one = boosting.grow_trees(cells, features, config, 12, 1, bins=100)
    for a, b in zip(many, one):
        assert len(a) == 12 and (a.feature == b.feature).all() and (a.bin == b.bin).all()
        assert a.errors == pytest.approx(b.errors, abs=1e-12) and a.value == pytest.approx(b.value, abs=1e-12)
    left = ensure_checkpoint_dir(spark).removeprefix("file:") + "/exchange"
    assert not os.path.exists(left) or not os.listdir(left)


def test_tasks_without_a_common_folder_use_barrier_calls(spark, monkeypatch):
    features = ["ai_score", "rank"]
    cells = _cells(spark, _rows(300), features)[2]
    config = [boosting.TreeConfig([0, 1], 2, 0.1)]
    want = boosting.grow_trees(cells, features, config, 2, 2)
    monkeypatch.setattr(boosting, "_exchange_folder", lambda *_: None)
    assert boosting.grow_trees(cells, features, config, 2, 2)[0].errors == pytest.approx(want[0].errors, abs=1e-12)
