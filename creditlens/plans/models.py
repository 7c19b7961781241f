"""Queries: training, ensembles, persistence and batch scoring."""

from pyspark.sql import functions as F

from creditlens.operators import boosting, decisions, evaluation, models as ops, network
from creditlens.plans.fixtures import AS_OF, Tables
from creditlens.plans.registry import query
from creditlens.plans.shape import rounded
from creditlens.session import run_folder

# The learners and the grid of ml_rf are small here, as documented arguments: the queries show the
# work over whole tables. ml_gbt and ml_train search all of operators.models' own spaces.
FOREST_GRID = {"numTrees": [10, 20], "maxDepth": [3, 5], "minInstancesPerNode": [1, 4], "featureSubsetStrategy": ["sqrt"], "bootstrap": [True]}
SIZES = {"trees": 20, "depth": 5, "rounds": 10, "boost_depth": 3, "epochs": 15}


def _prepared(t: Tables):
    ready, _, _ = ops.prepare(t.apps)
    return ready, ops.part(ready, "train"), ops.part(ready, "test")


@query("ml_rf")
def ml_rf(t: Tables):
    _, train, test = _prepared(t)
    search = ops.cross_validate(ops.forest(), train, FOREST_GRID)
    return ops.tuned_metrics("random_forest", search, test)


@query("ml_gbt")
def ml_gbt(t: Tables):
    _, train, test = _prepared(t)
    search = ops.cross_validate(ops.boosted(), train, in_tasks=True)
    return ops.tuned_metrics("boosted_trees", search, test)


@query("ml_mlp")
def ml_mlp(t: Tables):
    ready, train, test = _prepared(t)
    model = ops.perceptron(ops.dimension(ready), SIZES["epochs"]).fit(train)
    value = ops.auc(ops.probability(model, test, "p"), "p")
    return ops.metrics_frame(t.spark, [("perceptron", "test_auc", value)])


@query("ml_vote")
def ml_vote(t: Tables):
    _, train, test = _prepared(t)
    fitted = ops.base_models(train, SIZES)
    voted = ops.vote(ops.with_probabilities(fitted, test))
    return voted.select("application_id", "label", *[f"p_{m}" for m in ops.VOTE_WEIGHTS], "p_vote")


@query("ml_stack")
def ml_stack(t: Tables):
    _, train, test = _prepared(t)
    stacker = ops.fit_stacker(ops.out_of_fold(train, sizes=SIZES))
    stacked = ops.stack(stacker, ops.with_probabilities(ops.base_models(train, SIZES), test))
    return stacked.select("application_id", "label", *[f"p_{m}" for m in ops.VOTE_WEIGHTS], "p_stack")


@query("ml_select")
def ml_select(t: Tables):
    _, train, _ = _prepared(t)
    return ops.compare_ensembles(ops.out_of_fold(train, sizes=SIZES))


@query("ml_importance")
def ml_importance(t: Tables):
    ready, train, _ = _prepared(t)
    model = ops.forest(SIZES["trees"], SIZES["depth"]).fit(train)
    return ops.importance(model, ops.feature_names(ready), t.spark)


def _full_model(t: Tables):
    """Feature stages and learner as one model, fitted on the training split."""
    from pyspark.ml import PipelineModel

    ready, vectors, statistics = ops.prepare(t.apps)
    learner = ops.forest(SIZES["trees"], SIZES["depth"]).fit(ops.part(ready, "train"))
    return ready, PipelineModel(stages=[*vectors.stages, learner]), learner, statistics


def _loaded(path: str, t: Tables):
    model, statistics = ops.load_model(path, t.spark)
    return model, t.feed, statistics


@query("ml_persist")
def ml_persist(t: Tables):
    ready, model, learner, statistics = _full_model(t)
    path = run_folder(t.spark, "model")
    value = ops.auc(ops.probability(learner, ops.part(ready, "test"), "p"), "p")
    metadata = {"model_name": "credit-risk-random-forest", "model_version": "1.0", "auc_score": value}
    ops.save_model(model, path, metadata, statistics, t.spark)
    same = ops.predict(*_loaded(path, t))
    return same.select("application_id", "prob_default", "prediction_class")


@query("ml_train")
def ml_train(t: Tables):
    """Training from table to gate: prepare, tune, evaluate, save, decide on registration."""
    ready, _, _ = ops.prepare(t.apps)
    train, test = ops.part(ready, "train"), ops.part(ready, "test")
    search = ops.cross_validate(ops.forest(), train, in_tasks=True)
    scored = ops.probability(search.bestModel, test, "prob_default").withColumns(
        {
            "loan_status": F.col("label").cast("int"),
            "prediction_class": F.when(F.col("prob_default") > 0.5, 1).otherwise(0),
        }
    )
    metrics = evaluation.performance(scored)
    path = run_folder(t.spark, "model")
    search.bestModel.write().overwrite().save(f"{path}/model")
    metrics.write.json(f"{path}/metrics")
    gate = evaluation.gate(metrics).select(
        F.lit("registration_approved").alias("metric"), F.col("approved").cast("double").alias("value")
    )
    return metrics.unionByName(gate)


@query("batch_score")
def batch_score(t: Tables):
    ready, _, learner, _ = _full_model(t)
    scored = learner.transform(ready)
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array("probability")
    return scored.select(
        "application_id",
        p[1].alias("risk_score"),
        F.col("prediction").cast("int").alias("prediction_class"),
        F.greatest(p[0], p[1]).alias("confidence_score"),
    )


@query("batch_inference")
def batch_inference(t: Tables):
    """Prediction run: read, check, fill, derive, predict, write in three formats, sum up."""
    from creditlens.sources.readers import read_any
    from creditlens.sources.writers import save_all_formats

    _, model, _, statistics = _full_model(t)
    base = run_folder(t.spark, "inference")
    t.feed.write.parquet(f"{base}/input.parquet")
    predicted = ops.predict(model, read_any(t.spark, f"{base}/input.parquet"), statistics)
    output = decisions.batch_output(predicted, "credit-risk-random-forest", "1.0", AS_OF)
    paths = save_all_formats(output, f"{base}/output")
    return decisions.batch_summary(t.spark.read.parquet(paths["parquet"]))


#: Cuts of the numbers a single split is looked for in.
STUMP_CUTS = {
    "person_age": [25.0, 35.0, 50.0, 65.0, 80.0],
    "person_income": [20_000.0, 60_000.0, 120_000.0],
    "person_emp_length": [2.0, 5.0, 10.0, 30.0],
    "loan_amnt": [5_000.0, 20_000.0, 40_000.0],
    "loan_int_rate": [8.0, 12.0, 16.0, 20.0],
    "loan_percent_income": [0.1, 0.2, 0.3, 0.5, 0.7, 0.9],
    "cb_person_cred_hist_length": [2.0, 5.0, 10.0, 20.0],
}
NO_PENALTY = boosting.Setting(rounds=1, depth=1, step=0.1, alpha=0.0, lam=0.0, child_weight=0.0, gamma=0.0)


@query(
    "boost_stump",
    uses=("apps",),
    sql=f""", cells AS ({" UNION ALL ".join(f"SELECT '{name}' AS feature, {name}::DOUBLE AS x, 0.5::DOUBLE - loan_status AS g FROM apps" for name in STUMP_CUTS)}),
cuts(feature, cut) AS (VALUES {", ".join(f"('{name}', {cut}::DOUBLE)" for name, cuts in STUMP_CUTS.items() for cut in [*cuts, 'NULL'])}),
sides AS (SELECT feature, cut, missing_left, g,
    CASE WHEN x IS NULL THEN missing_left WHEN cut IS NULL THEN true ELSE x <= cut END AS is_left
  FROM cells JOIN cuts USING (feature), (VALUES (true), (false)) m(missing_left)),
sums AS (SELECT feature, cut, missing_left, sum(g) FILTER (is_left) AS gl, 0.25::DOUBLE * count(*) FILTER (is_left) AS hl,
    sum(g) FILTER (NOT is_left) AS gr, 0.25::DOUBLE * count(*) FILTER (NOT is_left) AS hr FROM sides GROUP BY ALL)
SELECT feature, cut, missing_left, round(gl * gl / hl + gr * gr / hr - (gl + gr) * (gl + gr) / (hl + hr), 6) AS gain,
  round(-0.1::DOUBLE * gl / hl, 6) AS left_leaf, round(-0.1::DOUBLE * gr / hr, 6) AS right_leaf
FROM sums WHERE hl > 0 AND hr > 0
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gl * gl / hl + gr * gr / hr - (gl + gr) * (gl + gr) / (hl + hr) DESC, cut NULLS LAST, missing_left DESC) = 1""",
)
def boost_stump(t: Tables):
    """The first Newton split of every number, without penalties."""
    rows = t.apps.select("application_id", F.col("loan_status").alias("label"), F.lit(0).alias("fold"), F.lit(False).alias("validation"), *STUMP_CUTS)
    values = F.array(*[F.col(name).cast("double") for name in STUMP_CUTS])
    names = list(STUMP_CUTS)
    found = boosting.first_splits(rows, values, "application_id", list(STUMP_CUTS.values()), NO_PENALTY)
    schema = "feature string, cut double, missing_left boolean, gain double, left_leaf double, right_leaf double"
    return rounded(t.spark.createDataFrame([(names[f[0]], *f[1:]) for f in found], schema), "gain", "left_leaf", "right_leaf")


NEWTON = boosting.Setting(rounds=100, depth=3, step=0.2, rows=0.9, columns=0.9, alpha=0.1, lam=1.0, child_weight=1.0, gamma=0.1)
IN_TEST = "('0x' || substr(md5(application_id::VARCHAR), 1, 8))::BIGINT % 1000 >= 800"


def _facts(t: Tables, rows: list[tuple[str, float]]):
    return t.spark.createDataFrame([(name, float(value)) for name, value in rows], "fact string, value double")


def _facts_sql(held: list[str]) -> str:
    """The rows of the test set, and what must hold of any good run."""
    return f"SELECT 'test_rows' AS fact, count(*)::DOUBLE AS value FROM apps WHERE {IN_TEST}" + "".join(
        f" UNION ALL SELECT '{name}', 1.0::DOUBLE" for name in held
    )


@query("ml_newton", uses=("apps",), sql=_facts_sql(["auc_above_080", "every_fold_above_080", "held_out_loss_fell", "ended_on_best", "loaded_scores_alike"]))
def ml_newton(t: Tables):
    """Penalised boosting, five folds and the whole fit in one go; what holds of the result."""
    ready, train, test = _prepared(t)
    [(mean, spread)], [booster] = boosting.cross_validated(train, [NEWTON])
    path = run_folder(t.spark, "booster")
    boosting.save(booster, path, t.spark)
    scored = boosting.score(test, booster, boosting.features_column(), "p")
    again = boosting.score(scored, boosting.load(path, t.spark), boosting.features_column(), "again")
    same = again.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bool_and(F.col("p") == F.col("again")), F.lit(True)).alias("same")).first()
    losses = booster.losses
    return _facts(
        t,
        [
            ("test_rows", same["rows"]),
            ("auc_above_080", ops.auc(scored, "p") > 0.8),
            ("every_fold_above_080", mean - 2 * spread > 0.8),  # no one of five is further from the mean
            ("held_out_loss_fell", losses[booster.best] < losses[0]),
            ("ended_on_best", booster.best == min(range(len(losses)), key=lambda i: (losses[i], -i)) and len(losses) <= booster.best + NEWTON.patience + 1),
            ("loaded_scores_alike", same["same"]),
        ],
    )


@query("ml_network", uses=("apps",), sql=_facts_sql(["auc_above_080", "held_out_loss_fell", "kept_the_best", "loaded_scores_alike"]))
def ml_network(t: Tables):
    """Three layers of 128 with dropout, stopped early; what holds of the result."""
    ready, train, test = _prepared(t)
    model = network.fit(train, boosting.features_column(), "application_id")
    loaded = network.Network.from_json(model.to_json())
    scored = network.score(test, model, boosting.features_column(), "p")
    again = network.score(scored, loaded, boosting.features_column(), "again")
    same = again.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bool_and(F.col("p") == F.col("again")), F.lit(True)).alias("same")).first()
    history = model.history
    return _facts(
        t,
        [
            ("test_rows", same["rows"]),
            ("auc_above_080", ops.auc(scored, "p") > 0.8),
            ("held_out_loss_fell", history[model.best_epoch]["val_loss"] < history[0]["val_loss"]),
            ("kept_the_best", history[model.best_epoch]["val_auc"] == max(h["val_auc"] for h in history)),
            ("loaded_scores_alike", same["same"]),
        ],
    )
