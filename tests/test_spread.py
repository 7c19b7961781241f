"""Rows on which much is computed are dealt over many files, whatever the input's files."""

from conftest import SMALL
from creditlens.operators import models
from creditlens.plans.fixtures import Tables
from creditlens.session import staged


def test_a_file_holds_few_rows(spark):
    rows = staged(spark.range(0, 95, 1, 1), "spread", 10)
    assert len(rows.inputFiles()) == 10 and sorted(r.id for r in rows.collect()) == list(range(95))


def test_prepared_rows_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(models, "FILE_ROWS", 100)
    apps = Tables(spark, SMALL).apps
    ready, _, _ = models.prepare(apps)
    assert len(ready.inputFiles()) >= 15 and ready.count() == apps.count()


def test_a_tree_chooses_alike_by_node_and_by_row():
    import numpy as np

    from creditlens.operators.boosting import Tree

    tree = Tree()
    tree.add(0.0)
    for node, feature, cut, missing_left in ((0, 0, 3, True), (1, 1, 64, False), (2, 1, 1, False)):
        tree.feature[node], tree.cut[node], tree.missing_left[node] = feature, cut, missing_left
        tree.left[node], tree.right[node] = tree.add(node + 0.25), tree.add(node + 0.5)
    bins = np.array([(a, b) for a in range(65) for b in range(65)], np.uint8)
    by_feature = np.ascontiguousarray(bins.T)
    assert np.array_equal(tree.chosen(by_feature, np.array(tree.value)), tree.values(bins, 2))
    assert np.array_equal(Tree(*[[x] for x in (-1, 0, True, -1, -1, 0.5, 0.0)]).chosen(by_feature, np.array([0.5])), np.full(len(bins), 0.5))


def test_statistics_are_taken_from_dealt_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "FILE_ROWS", 100)
    files, of = [], models.Statistics.of
    monkeypatch.setattr(models.Statistics, "of", lambda train: files.append(len(train.inputFiles())) or of(train))
    models.prepare(Tables(spark, SMALL).apps)
    assert files[0] >= 15


def test_saved_features_are_derived_from_dealt_rows(spark, monkeypatch):
    from creditlens.operators import features
    from creditlens.plans import sources

    monkeypatch.setattr(sources, "FILE_ROWS", 100)
    files, fit, derive = [], features.fit_features, features.derive_job
    monkeypatch.setattr(features, "derive_job", lambda df: files.append(len(df.inputFiles())) or derive(df))
    monkeypatch.setattr(features, "fit_features", lambda df: files.append(len(df.inputFiles())) or fit(df))
    apps = Tables(spark, SMALL)
    row = sources.sink_features(apps).first()
    assert min(files) >= 15 and row["train_records"] + row["test_records"] == apps.apps.count()


def test_weights_leave_rows_where_they_are(spark):
    from pyspark.sql import functions as F

    from creditlens.operators.features import with_weights

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large tables
    try:
        rows = spark.range(900).select("id", F.when(F.col("id") % 3 != 2, F.col("id") % 3).alias("label"))
        weighted = with_weights(rows, "label")
        assert "SortMergeJoin" not in weighted._jdf.queryExecution().toString()
        assert {(r["label"], r["weight"]) for r in weighted.collect()} == {(0, 1.0), (1, 1.0), (None, 1.0)} and weighted.count() == 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
