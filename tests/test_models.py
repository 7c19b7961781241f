"""Training on the small tables: names, votes and persistence."""

import pytest
from pyspark.sql import functions as F

from creditlens.operators import features, models
from creditlens.session import run_folder


@pytest.fixture(scope="module")
def prepared(tables):
    return models.prepare(tables.apps)


def test_every_entry_of_the_vector_has_a_name(prepared):
    ready, _, _ = prepared
    names = models.feature_names(ready)
    assert len(names) == models.dimension(ready)
    assert names[: len(features.SCALED)] == features.SCALED


def test_folds_and_splits_follow_the_key(prepared):
    ready, _, _ = prepared
    assert {r["fold"] for r in ready.select("fold").distinct().collect()} == set(range(models.FOLDS))
    again = features.split_by_hash(ready.drop("split").repartition(5), "application_id")
    assert again.where("split = 'train'").count() == models.part(ready, "train").count()


def test_vote_weighs_the_probabilities(spark):
    frame = spark.createDataFrame([(0.1, 0.5, 0.9)], "p_rf double, p_gbt double, p_mlp double")
    assert models.vote(frame).first()["p_vote"] == pytest.approx(0.3 * 0.1 + 0.4 * 0.5 + 0.3 * 0.9)


def test_a_loaded_model_predicts_the_same(spark, tables, prepared):
    from pyspark.ml import PipelineModel

    ready, vectors, statistics = prepared
    learner = models.forest(3, 3).fit(models.part(ready, "train"))
    model = PipelineModel(stages=[*vectors.stages, learner])
    path = run_folder(spark, "model")
    models.save_model(model, path, {"name": "forest"}, statistics, spark)
    before = models.predict(model, tables.feed, statistics).agg(F.sum("prob_default")).first()[0]
    loaded, held = models.load_model(path, spark)
    assert held == statistics
    after = models.predict(loaded, tables.feed, held).agg(F.sum("prob_default")).first()[0]
    assert before == pytest.approx(after)


def test_training_learns_and_step_sizes_differ(prepared):
    ready, _, _ = prepared
    train, test = models.part(ready, "train"), models.part(ready, "test")
    value = models.auc(models.probability(models.forest(20, 5).fit(train), test, "p"), "p")
    assert value >= 0.8
    searched = models.cross_validate(models.boosted(5, 2), train, {"stepSize": [0.05, 0.3]})
    assert len(set(searched.avgMetrics)) == 2


def test_a_row_scores_alike_in_every_batch(tables, prepared):
    from pyspark.ml import PipelineModel

    ready, vectors, statistics = prepared
    model = PipelineModel(stages=[*vectors.stages, models.forest(3, 3).fit(models.part(ready, "train"))])
    some = tables.feed.where("application_id < 200")

    def scores(frame):
        return {r["application_id"]: r["prob_default"] for r in models.predict(model, frame, statistics).collect()}

    every = scores(tables.feed)
    assert all(every[k] == v for k, v in scores(some).items())


def test_statistics_come_from_training_rows_only(tables):
    odd = tables.apps.withColumn("person_income", F.when(F.expr("CAST(conv(substring(md5(CAST(application_id AS string)), 1, 8), 16, 10) AS bigint) % 1000 >= 800"), 1e12).otherwise(F.col("person_income")))
    assert models.prepare(odd)[2] == models.prepare(tables.apps)[2]
