"""Training, ensembles, persistence and batch scoring with Spark ML."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.operators import features as fe
from creditlens.operators import side_by_side
from creditlens.operators.perceptron import Perceptron
from creditlens.operators.quantiles import area_under_roc
from creditlens.operators.tables import require_columns
from creditlens.schemas import REQUIRED_FIELDS
from creditlens.session import FILE_ROWS, staged

# Vote weights, folds and seed.
VOTE_WEIGHTS = {"rf": 0.3, "gbt": 0.4, "mlp": 0.3}
FOLDS = 5
SEED = 42

# The search spaces, as far as Spark's learners have the parameter.
FOREST_SPACE = {
    "numTrees": [100, 200, 300],
    "maxDepth": [10, 20],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
    "bootstrap": [True, False],
}
BOOST_SPACE = {
    "maxIter": [100, 200, 300],
    "maxDepth": [3, 6, 9],
    "stepSize": [0.01, 0.1, 0.2],
    "subsamplingRate": [0.8, 0.9, 1.0],
    "minInstancesPerNode": [1, 3, 5],
    "minInfoGain": [0.0, 0.1, 0.2],
}


def forest(trees: int = 100, depth: int = 10) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED
    )


def boosted(rounds: int = 100, depth: int = 6, step: float = 0.1) -> GBTClassifier:
    """Boosted trees that stop once the held-out rows no longer gain."""
    return GBTClassifier(
        labelCol="label",
        featuresCol="features",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        validationIndicatorCol="validation",
        validationTol=0.01,
        seed=SEED,
    )


def perceptron(inputs: int, rounds: int = 100) -> Perceptron:
    """Three hidden layers of 128; Spark's network has no dropout."""
    return Perceptron(
        labelCol="label",
        featuresCol="features",
        layers=[inputs, 128, 128, 128, 2],
        maxIter=rounds,
        blockSize=64,
        seed=SEED,
    )


def grid(estimator, space: dict[str, list]):
    builder = ParamGridBuilder()
    for name, values in space.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


@dataclass(frozen=True)
class Statistics:
    """What deriving and filling need to know of the training rows; kept with the model."""

    income_cuts: dict[float, float | None]
    medians: dict[str, float]

    @classmethod
    def of(cls, train: DataFrame) -> Statistics:
        cuts = fe.income_cuts(train)
        return cls(cuts, fe.medians_of(fe.derive_job(train, cuts), fe.SCALED))

    def apply(self, df: DataFrame) -> DataFrame:
        return fe.complete_numbers(fe.derive_job(df, self.income_cuts), fe.SCALED, self.medians)

    def to_json(self) -> str:
        return json.dumps({"income_cuts": list(self.income_cuts.items()), "medians": self.medians})

    @classmethod
    def from_json(cls, text: str) -> Statistics:
        held = json.loads(text)
        return cls({p: value for p, value in held["income_cuts"]}, held["medians"])


def prepare(df: DataFrame, key: str = "application_id") -> tuple[DataFrame, PipelineModel, Statistics]:
    """Feature vectors with label, weight, fold and split, written once for all fits.

    Quartiles, medians, class weights and the encoders come from the training rows only.
    Nulls are filled after deriving and before assembling, as a vector takes none.
    Folds and splits come from the key, so a recomputed task cannot reshuffle them. Whatever the
    files of the input, the rows are dealt over all cores before anything is derived from them, and
    again once derived.
    """
    labelled = df.where(F.col("loan_status").isNotNull()).withColumn("label", F.col("loan_status").cast("double"))
    held = [c for c in df.columns if c in {key, *REQUIRED_FIELDS}]
    marked = fe.split_by_hash(labelled, key).select(*held, "label", "split")
    in_train = F.col("split") == "train"
    dealt = staged(fe.with_weights(marked, "label", marked.where(in_train)), "labelled", FILE_ROWS)
    statistics = Statistics.of(dealt.where(in_train))
    weighted = staged(statistics.apply(dealt), "derived", FILE_ROWS)
    vectors = fe.fit_features(weighted.where(in_train))
    hashed = fe.hash_value(key)
    ready = vectors.transform(weighted).select(
        key,
        "features",
        "label",
        "weight",
        "split",
        (F.floor(hashed / 1000) % FOLDS).cast("int").alias("fold"),
        (F.floor(hashed / 7000) % 10 == 0).alias("validation"),
    )
    return staged(ready, "features", FILE_ROWS), vectors, statistics


def part(ready: DataFrame, split: str) -> DataFrame:
    return ready.where(F.col("split") == split)


def dimension(ready: DataFrame) -> int:
    return ready.select("features").first()["features"].size


def probability(model, df: DataFrame, name: str) -> DataFrame:
    """P(default) of a model as a plain column beside the input columns."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def auc(df: DataFrame, score: str) -> float:
    row = area_under_roc(df, score, "label").first()
    return row["auc"] if row and row["auc"] is not None else float("nan")


#: Trees of a forest that are grown together where a search grows forests in pieces. Spark keeps a
#: count per row and tree while it grows, so this bounds what a row takes.
PIECE_TREES = 25


@dataclass(frozen=True)
class Search:
    """Mean and deviation of the folds' figures by setting, and the best setting fitted on all rows."""

    avgMetrics: list[float]
    stdMetrics: list[float]
    bestModel: Model


def _rebuilt(model, number, size: int, trees: list, weights: list[float] | None = None):
    """A fitted ensemble with these trees and ``number`` set to ``size``, otherwise as ``model``."""
    own, context = model._java_obj, SparkContext._active_spark_context
    gateway = context._gateway
    of = gateway.jvm.java.lang.Class.forName(trees[0].getClass().getName())
    array = gateway.jvm.java.lang.reflect.Array.newInstance(of, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree
    kind = getattr(gateway.jvm.org.apache.spark.ml.classification, type(model).__name__)
    if weights is None:
        built = kind(own.uid(), array, own.numFeatures(), own.numClasses())
    else:
        shares = gateway.new_array(gateway.jvm.double, len(weights))
        for i, weight in enumerate(weights):
            shares[i] = weight
        built = kind(own.uid(), array, shares, own.numFeatures(), own.numClasses())
    built = built.copy(own.extractParamMap())
    built.set(built.getParam(number.name), size)
    rebuilt = type(model)(built)
    rebuilt._transfer_params_from_java()
    return rebuilt


def _sizes(estimator, settings: dict, sizes: list[int], train: DataFrame, in_pieces: bool):
    """(size, model) of one setting with each number of trees, the smaller as the first trees of the largest.

    Boosted trees grow one after another, so the first ones are those a smaller number gives. A forest's draws
    depend on its size in Spark; in pieces, each with a seed of its own, its first trees do not.
    """
    if isinstance(estimator, GBTClassifier):
        model = estimator.fit(train, {**settings, estimator.maxIter: max(sizes)})
        trees, weights = list(model._java_obj.trees()), list(model._java_obj.treeWeights())
        return [(size, model if size >= len(trees) else _rebuilt(model, estimator.maxIter, size, trees[:size], weights[:size])) for size in sizes]
    if not in_pieces:
        return [(size, estimator.fit(train, {**settings, estimator.numTrees: size})) for size in sizes]
    trees, out = [], []
    for size in sorted(sizes):
        while len(trees) < size:
            piece = {**settings, estimator.numTrees: min(PIECE_TREES, size - len(trees)), estimator.seed: SEED + 1_000_003 * len(trees)}
            model = estimator.fit(train, piece)
            trees += list(model._java_obj.trees())
        out.append((size, _rebuilt(model, estimator.numTrees, size, trees)))
    return out


def _at_once(df: DataFrame, most: int) -> int:
    """Fits side by side: one where its tasks alone fill the cores, as each holds its rows."""
    return 1 if df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism else most


def _tasks_figures(estimator, train: DataFrame, maps: list[dict]) -> np.ndarray:
    """The fold figures of a grid, by setting and fold, from fits inside tasks."""
    boosting = isinstance(estimator, GBTClassifier)
    free = {"maxIter"} if boosting else {"numTrees", "maxDepth"}
    named = [{p.name: v for p, v in setting.items()} for setting in maps]
    full = [{p.name: s.get(p.name, estimator.getOrDefault(p)) for p in estimator.params if p.name in s or estimator.isDefined(p)} for s in named]
    needed = ("maxDepth", "stepSize", "subsamplingRate", "minInstancesPerNode", "minInfoGain") if boosting else ("minInstancesPerNode", "featureSubsetStrategy", "bootstrap")
    groups: dict[tuple, list[int]] = {}
    for place, setting in enumerate(full):
        groups.setdefault(tuple(setting[name] for name in needed), []).append(place)
    tolerance, seed = (estimator.getValidationTol() if boosting else 0.0), estimator.getSeed()
    sizes = {key: [sorted({full[i][name] for i in places}) for name in sorted(free, reverse=True)] for key, places in groups.items()}

    def judge(rows, fold: int, key: tuple):
        setting = dict(zip(needed, key))
        if boosting:
            return side_by_side.boosted_areas(rows, fold, setting, sizes[key][0], tolerance, seed)
        return side_by_side.forest_areas(rows, fold, setting, *sizes[key], seed)

    work = [(fold, key) for key in groups for fold in range(FOLDS)]
    figures = np.full((len(maps), FOLDS), np.nan)
    for (fold, key), found in zip(work, side_by_side.fold_figures(train, work, judge)):
        for place in groups[key]:
            setting = full[place]
            figures[place, fold] = found[setting["maxIter"] if boosting else (setting["numTrees"], setting["maxDepth"])]
    return figures


def cross_validate(estimator, train: DataFrame, space: dict[str, list] | None = None, parallelism: int = 4, in_tasks: bool = False) -> Search:
    """Grid search over key-based folds by ROC AUC; over the learner's whole space unless one is given.

    Settings that differ in the number of boosting rounds share their trees. The staged rows are read
    by every fit and not held in memory. ``in_tasks`` is for large grids: on tables of up to
    ``side_by_side.MOST_ROWS`` rows a task does all of a fold's fit, on larger ones Spark's learners do, forests
    in pieces of few trees; the best setting is fitted by Spark's learner in any case.
    """
    if space is None:
        space = FOREST_SPACE if isinstance(estimator, RandomForestClassifier) else BOOST_SPACE
    number = estimator.maxIter if isinstance(estimator, GBTClassifier) else estimator.numTrees
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    maps = grid(estimator, space)
    # Settings alike but for their number of trees, by their place in the grid.
    groups: dict[tuple, list[int]] = {}
    for place, setting in enumerate(maps):
        groups.setdefault(tuple((p.name, v) for p, v in setting.items() if p != number), []).append(place)

    def count(setting) -> int:
        return setting.get(number, estimator.getOrDefault(number))

    def rest(setting) -> dict:
        return {p: v for p, v in setting.items() if p != number}

    figures = np.full((len(maps), FOLDS), np.nan)

    def judge(fold: int, places: list[int]) -> None:
        inside, held = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
        known: dict[int, float] = {}
        fitted = dict(_sizes(estimator, rest(maps[places[0]]), sorted({count(maps[i]) for i in places}), inside, in_tasks))
        for place in places:
            model = fitted[count(maps[place])]
            # Boosting that ended early is the same model whatever the number of rounds allowed.
            trees = len(model.treeWeights)
            if trees not in known:
                known[trees] = evaluator.evaluate(model.transform(held))
            figures[place, fold] = known[trees]

    for fold in range(FOLDS):
        for name, condition in (("training", F.col("fold") != fold), ("validation", F.col("fold") == fold)):
            if train.where(condition).isEmpty():
                raise ValueError(f"The {name} data at fold {fold} is empty.")
    if in_tasks and train.count() <= side_by_side.MOST_ROWS:
        figures = _tasks_figures(estimator, train, maps)
    else:
        work = [(fold, places) for fold in range(FOLDS) for places in groups.values()]
        with ThreadPool(_at_once(train, parallelism)) as pool:
            pool.map(inheritable_thread_target(train.sparkSession)(lambda item: judge(*item)), work, chunksize=1)
    means = figures.mean(axis=1)
    best = maps[int(np.argmax(means))]
    model = _sizes(estimator, rest(best), [count(best)], train, in_tasks)[0][1]
    return Search(means.tolist(), figures.std(axis=1).tolist(), model)


def metrics_frame(spark, rows: list[tuple[str, str, float]]) -> DataFrame:
    return spark.createDataFrame(rows, "model string, metric string, value double")


def tuned_metrics(name: str, search, test: DataFrame) -> DataFrame:
    """Cross-validation and hold-out figures of a search."""
    rows = [
        (name, f"cv_auc_mean_{i}", float(mean)) for i, mean in enumerate(search.avgMetrics)
    ] + [(name, f"cv_auc_std_{i}", float(std)) for i, std in enumerate(search.stdMetrics)]
    rows.append((name, "test_auc", auc(probability(search.bestModel, test, "p"), "p")))
    return metrics_frame(test.sparkSession, rows)


def base_models(train: DataFrame, sizes: dict | None = None) -> dict:
    """The three base learners fitted on a training set."""
    sizes = sizes or {}
    return {
        "rf": forest(sizes.get("trees", 100), sizes.get("depth", 10)).fit(train),
        "gbt": boosted(sizes.get("rounds", 100), sizes.get("boost_depth", 6)).fit(train),
        "mlp": perceptron(dimension(train), sizes.get("epochs", 100)).fit(train),
    }


def with_probabilities(models: dict, df: DataFrame) -> DataFrame:
    """One probability column per base model, by chained transforms and no join."""
    return reduce(lambda frame, item: probability(item[1], frame, f"p_{item[0]}"), models.items(), df)


def vote(df: DataFrame, weights: dict[str, float] = VOTE_WEIGHTS, name: str = "p_vote") -> DataFrame:
    """Weighted mean of the probability columns."""
    total = sum(weights.values())
    terms = [F.col(f"p_{model}") * F.lit(weight / total) for model, weight in weights.items()]
    return df.withColumn(name, reduce(lambda a, b: a + b, terms))


def out_of_fold(train: DataFrame, folds: int = FOLDS, sizes: dict | None = None) -> DataFrame:
    """Probabilities for every training row from models that never saw its fold."""
    frames = []
    for fold in range(folds):
        held = F.col("fold") % folds == fold
        models = base_models(train.where(~held), sizes)
        frames.append(with_probabilities(models, train.where(held)).withColumn("held", F.lit(fold)))
    return staged(reduce(lambda a, b: a.unionByName(b), frames), "out-of-fold", FILE_ROWS)


def _stacked(df: DataFrame) -> DataFrame:
    columns = [f"p_{name}" for name in VOTE_WEIGHTS]
    return VectorAssembler(inputCols=columns, outputCol="stack").transform(df)


def fit_stacker(oof: DataFrame):
    return LogisticRegression(featuresCol="stack", labelCol="label", probabilityCol="probability").fit(_stacked(oof))


def stack(stacker, df: DataFrame, name: str = "p_stack") -> DataFrame:
    scored = stacker.transform(_stacked(df))
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def compare_ensembles(oof: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Mean and deviation of the fold AUCs of voting and stacking; every base fold is fitted once."""
    scores: dict[str, list[float]] = {"voting": [], "stacking": []}
    for fold in range(folds):
        held = oof.where(F.col("held") == fold)
        scores["voting"].append(auc(vote(held), "p_vote"))
        scores["stacking"].append(auc(stack(fit_stacker(oof.where(F.col("held") != fold)), held), "p_stack"))
    rows = []
    best = max(scores, key=lambda name: sum(scores[name]) / folds)
    for name, values in scores.items():
        mean = sum(values) / folds
        rows.append((name, "cv_auc_mean", mean))
        rows.append((name, "cv_auc_std", (sum((v - mean) ** 2 for v in values) / folds) ** 0.5))
        rows.append((name, "chosen", 1.0 if name == best else 0.0))
    return metrics_frame(oof.sparkSession, rows)


def feature_names(df: DataFrame, column: str = "features", scaled: list[str] = fe.SCALED) -> list[str]:
    """Names of a vector's entries; the scaler numbers its entries, so their columns are put back."""
    attributes = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    found = sorted((entry["idx"], entry["name"]) for group in attributes.values() for entry in group)
    numbered = {f"scaled_features_{i}": name for i, name in enumerate(scaled)}
    return [numbered.get(name, name) for _, name in found]


def importance(model, names: list[str], spark, top: int = 10) -> DataFrame:
    """The most important features of a model; equal shares when it has none."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        values = abs(model.coefficients.toArray())
    else:
        values = [1.0 / len(names)] * len(names)
    ranked = sorted(zip(names, map(float, values)), key=lambda pair: (-pair[1], pair[0]))[:top]
    return spark.createDataFrame(
        [(rank, name, value) for rank, (name, value) in enumerate(ranked, 1)],
        "rank int, feature string, importance double",
    )


def save_model(model: PipelineModel, path: str, metadata: dict, statistics: Statistics, spark) -> None:
    """Model, its metadata and the training statistics as files of the shared folder."""
    model.write().overwrite().save(f"{path}/model")
    held = {**metadata, "statistics": statistics.to_json()}
    rows = [(str(name), str(value)) for name, value in held.items()]
    spark.createDataFrame(rows, "name string, value string").write.mode("overwrite").json(f"{path}/metadata")


def load_model(path: str, spark) -> tuple[PipelineModel, Statistics]:
    held = spark.read.schema("name string, value string").json(f"{path}/metadata").where("name = 'statistics'").first()
    return PipelineModel.load(f"{path}/model"), Statistics.from_json(held["value"])


def batch_features(df: DataFrame, statistics: Statistics) -> DataFrame:
    """Input of a prediction run: required columns checked, numbers coerced and filled.

    Quartiles and medians are those of training, so a row scores alike in every batch.
    """
    from creditlens.operators.cleaning import coerce_numeric

    return statistics.apply(coerce_numeric(require_columns(df, REQUIRED_FIELDS)))


def predict(model: PipelineModel, df: DataFrame, statistics: Statistics) -> DataFrame:
    """Input columns with probability of default and class; one pass, so it runs on streams too."""
    key = [c for c in df.columns]
    carried = df.withColumns({f"__{c}": F.col(c) for c in key})
    scored = model.transform(batch_features(carried, statistics))
    return scored.select(
        *[F.col(f"__{c}").alias(c) for c in key],
        vector_to_array("probability")[1].alias("prob_default"),
        F.col("prediction").cast("int").alias("prediction_class"),
    )
