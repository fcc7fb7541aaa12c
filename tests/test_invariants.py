"""Data invariants of the long table and the split on the whole sf0.001 tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ipcforge.operators.split import month_split, split_counts, split_long
from ipcforge.plans import derived


def test_labels_and_split_cover_every_row(spark):
    long = derived.long_table(spark, SF_SMALL)
    total = long.count()
    assert total > 0
    ys = {r["y"] for r in long.select("y").distinct().collect()}
    assert ys <= {0.0, 0.5, 1.0}
    split = split_long(long)
    counts = {r["split"]: r["n_rows"] for r in split_counts(split).collect()}
    assert set(counts) <= {"train", "val", None}
    assert sum(counts.values()) == total  # NULL months are in neither side but still counted
    assert split.count() == total  # the month join neither drops nor duplicates rows


def test_month_split_point(spark):
    months = month_split(derived.long_table(spark, SF_SMALL)).collect()
    n = len(months)
    n_train = sum(1 for r in months if r["split"] == "train")
    assert n_train == int(n * (2 / 3))
    by_idx = sorted(months, key=lambda r: r["month_idx"])
    assert [r["bulletin_code"] for r in by_idx] == sorted(r["bulletin_code"] for r in months)
    # train months are exactly the earliest ones
    assert all(r["split"] == "train" for r in by_idx[:n_train])
    assert all(r["split"] == "val" for r in by_idx[n_train:])


def test_ranks_start_at_one(spark):
    long = derived.long(spark, SF_SMALL)
    per_patent = long.groupBy("patent_id").agg(F.min("rank").alias("mn"), F.max("rank").alias("mx"),
                                                F.count(F.lit(1)).alias("n"))
    # application numbers may repeat across documents, so ranks are dense per document only
    assert per_patent.where((F.col("mn") != 1) | (F.col("mx") > F.col("n"))).count() == 0
