"""Searches: whole spaces, trees shared by settings, and the rows a fit holds."""

import numpy as np
import pytest

from creditlens.operators import models, side_by_side
from creditlens.plans import models as plans
from creditlens.session import ship


@pytest.fixture(scope="module")
def train(tables):
    ship(tables.spark)
    ready, _, _ = models.prepare(tables.apps)
    return models.part(ready, "train")


@pytest.mark.parametrize("name, settings", [("ml_gbt", 729), ("ml_train", 108)])
def test_queries_search_the_whole_space(tables, monkeypatch, name, settings):
    """The grid that the query's search walks, seen before any fit."""

    class Seen(Exception):
        pass

    walked, grid = [], models.grid

    def note(estimator, space):
        walked.append(grid(estimator, space))
        raise Seen

    monkeypatch.setattr(models, "grid", note)
    with pytest.raises(Seen):
        getattr(plans, name)(tables)
    assert len(walked[0]) == settings


def test_fewer_rounds_are_the_first_of_more(train):
    space = {"maxIter": [2, 4], "stepSize": [0.3]}
    both = models.cross_validate(models.boosted(5, 2), train, space)
    alone = [models.cross_validate(models.boosted(5, 2), train, {**space, "maxIter": [n]}) for n in space["maxIter"]]
    assert both.avgMetrics == [one.avgMetrics[0] for one in alone] and both.stdMetrics == [one.stdMetrics[0] for one in alone]
    assert len(set(both.avgMetrics)) == 2


def test_a_search_equals_fits_one_by_one(train):
    """The figures of Spark's own search."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    space = {"numTrees": [2, 3], "maxDepth": [3]}
    forest = models.forest()
    ours = models.cross_validate(forest, train, space)
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    theirs = CrossValidator(
        estimator=forest, estimatorParamMaps=models.grid(forest, space), evaluator=judge, numFolds=models.FOLDS, foldCol="fold"
    ).fit(train)
    assert ours.avgMetrics == pytest.approx(theirs.avgMetrics) and ours.stdMetrics == pytest.approx(theirs.stdMetrics)
    assert ours.bestModel.toDebugString.split("\n", 1)[1] == theirs.bestModel.toDebugString.split("\n", 1)[1]


def test_a_forest_in_pieces_is_whole(train, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "PIECE_TREES", 2)
    (three, small), (five, large) = models._sizes(models.forest(), {}, [3, 5], train, True)
    assert (three, five) == (small.getNumTrees, large.getNumTrees) == (3, 5)
    text = [tree.toDebugString.split("\n", 1)[1] for tree in large.trees]
    assert [tree.toDebugString.split("\n", 1)[1] for tree in small.trees] == text[:3] and len(set(text)) == 5
    assert models.auc(models.probability(large, train, "p"), "p") > 0.8
    large.write().save(str(tmp_path / "forest"))
    loaded = type(large).load(str(tmp_path / "forest"))
    assert loaded.getNumTrees == 5 and large.getFeaturesCol() == "features"


def test_one_fit_at_a_time_where_it_fills_the_cores(spark, train):
    assert models._at_once(spark.range(0, 100, 1, 64), 4) == 1 and models._at_once(spark.range(0, 100, 1, 1), 4) == 4


def test_a_search_holds_no_rows_of_its_own(spark, train, monkeypatch):
    from pyspark.sql import DataFrame

    held = []
    monkeypatch.setattr(DataFrame, "cache", lambda self: held.append(self) or self)
    models.cross_validate(models.forest(2, 2), train, {"maxDepth": [2]})
    assert held == []


def plain_tree(bins, target, weight, count, depth, least_rows, rows=None):
    """Predictions of a tree grown by whole loops over features and cuts."""
    rows = np.arange(len(bins)) if rows is None else rows
    own = rows[count[rows] > 0]
    out = {r: np.average(target[own], weights=weight[own]) for r in rows}
    best = None
    for feature in range(bins.shape[1] if depth else 0):
        for cut in range(side_by_side.BINS - 1):
            sides = [own[bins[own, feature] <= cut], own[bins[own, feature] > cut]]
            if min(count[x].sum() for x in sides) < max(least_rows, 1):
                continue
            worth = sum((target[x] * weight[x]).sum() ** 2 / weight[x].sum() for x in sides) - (target[own] * weight[own]).sum() ** 2 / weight[own].sum()
            if worth > 1e-9 and (best is None or worth > best[0] + 1e-9):
                best = (worth, feature, cut)
    if best:
        left = bins[rows, best[1]] <= best[2]
        for side in (rows[left], rows[~left]):
            out |= plain_tree(bins, target, weight, count, depth - 1, least_rows, side)
    return out


@pytest.mark.parametrize("least_rows, cells", [(1, 10), (1, 10**6), (9, 10**6)])
def test_trees_in_tasks_equal_trees_grown_by_plain_loops(monkeypatch, least_rows, cells):
    monkeypatch.setattr(side_by_side, "CELLS", cells)
    rng = np.random.default_rng(4)
    bins = rng.integers(0, side_by_side.BINS, (300, 4)).astype(np.uint8)
    target, weight = rng.normal(0, 1, 300) + (bins[:, 1] > 9) * (bins[:, 2] > 20), rng.uniform(0.5, 2, 300)
    count = rng.poisson(1.0, 300).astype(float)
    found = side_by_side.grown(bins, target * weight * count, weight * count, count, [0, 2, 4], least_rows, 0.0, 4, rng)
    for depth, ours in zip((0, 2, 4), found):
        plain = plain_tree(bins, target, weight * count, count, depth, least_rows)
        assert np.allclose(ours, [plain[i] for i in range(300)])


def test_a_node_splits_only_where_it_gains_enough():
    bins = np.repeat(np.arange(2, dtype=np.uint8), 50)[:, None]
    one, target = np.ones(100), np.repeat([0.0, 1.0], 50)
    for gain, values in ((0.24, 2), (0.26, 1)):  # the variance falls by a quarter
        [found] = side_by_side.grown(bins, target, one, one, [3], 1, gain, 1, np.random.default_rng(1))
        assert len(set(found)) == values


@pytest.mark.parametrize("learner, space", [("forest", {"numTrees": [20, 40], "maxDepth": [3, 6]}), ("boosted", {"maxIter": [5, 10], "stepSize": [0.1, 0.3], "maxDepth": [2]})])
def test_fits_in_tasks_are_as_good_as_sparks(train, learner, space):
    estimator = getattr(models, learner)()
    ours = models.cross_validate(estimator, train, space, in_tasks=True)
    theirs = models.cross_validate(estimator, train, space)
    assert len(ours.avgMetrics) == 4 and np.allclose(ours.avgMetrics, theirs.avgMetrics, atol=0.03)
    assert models.auc(models.probability(ours.bestModel, train, "p"), "p") > 0.8


def test_settings_in_tasks_stand_where_the_grid_has_them(train):
    space = {"numTrees": [3, 6], "maxDepth": [2, 5], "featureSubsetStrategy": ["sqrt", "all"], "bootstrap": [True, False]}
    estimator = models.forest()
    maps = models.grid(estimator, space)
    figures = models._tasks_figures(estimator, train, maps)
    rows = side_by_side.packed(train)
    for place, setting in enumerate(maps):
        own = {p.name: v for p, v in setting.items()}
        key = (own["numTrees"], own["maxDepth"])
        one = side_by_side.forest_areas(rows, 2, {"minInstancesPerNode": 1, **own}, [own["numTrees"]], [own["maxDepth"]], models.SEED)
        assert figures[place, 2] == one[key]


def test_areas_count_pairs():
    rng = np.random.default_rng(2)
    label, score = rng.integers(0, 2, 200), np.round(rng.normal(0, 1, 200), 1)
    a, b = score[label == 1], score[label == 0]
    assert side_by_side.area(label, score) == pytest.approx(((a[:, None] > b) + 0.5 * (a[:, None] == b)).mean())
    assert np.isnan(side_by_side.area(np.ones(3), np.ones(3)))
