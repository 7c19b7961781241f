"""Scoring and deciding applications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlens.functions import scoring
from creditlens.functions.validation import scoring_errors


def score(df: DataFrame, model_score: str | None = None) -> DataFrame:
    """Add ``risk_score``: the model's where a column holds one, else the rule score."""
    value = scoring.score_or_fallback(F.col(model_score)) if model_score else scoring.rule_score()
    return df.withColumn("risk_score", value)


def decide(df: DataFrame) -> DataFrame:
    """Decide scored applications.

    Reason and level describe the score; the decision may be overridden by a
    rule, and the approval probability follows the final decision.
    """
    risk = F.coalesce(F.col("risk_score"), F.lit(0.5))
    return (
        df.withColumn("risk_score", risk)
        .withColumn("base_decision", scoring.base_decision(F.col("risk_score")))
        .withColumn("rule_fired", scoring.rule_fired())
        .withColumns(
            {
                "decision": scoring.final_decision(),
                "decision_reason": scoring.decision_reason(F.col("risk_score")),
                "risk_level": scoring.risk_level(F.col("risk_score")),
            }
        )
        .withColumn("approval_probability", scoring.approval_probability(F.col("decision")))
    )


def with_final_status(df: DataFrame) -> DataFrame:
    """Status and summary lines of decided applications."""
    return df.withColumn("final_status", scoring.final_status(F.col("decision"))).withColumns(
        {
            "decision_summary": scoring.decision_summary(F.col("decision"), F.col("risk_score")),
            "processing_summary": scoring.processing_summary(
                F.col("decision"), F.col("risk_score"), F.col("final_status")
            ),
        }
    )


def status_cache_rows(df: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Lookup rows of decided applications with an expiry time."""
    now = F.unix_timestamp(F.lit(as_of).cast("timestamp"))
    return df.select(
        "application_id",
        scoring.final_status(F.col("decision")).alias("status"),
        "decision",
        "risk_score",
        "risk_level",
        (now + days * 86400).alias("ttl"),
    )


def score_with_errors(df: DataFrame) -> DataFrame:
    """One result per input row: a score, or the errors that prevented it."""
    checked = df.withColumn("errors", scoring_errors())
    clean = F.size("errors") == 0
    risk = scoring.rule_score()
    return checked.withColumns(
        {
            "risk_score": F.when(clean, risk),
            "risk_level": F.when(clean, scoring.risk_level_inference(risk)),
        }
    )


def batch_output(df: DataFrame, model_name: str, model_version: str, as_of: str) -> DataFrame:
    """Prediction columns around ``prob_default`` and ``prediction_class``.

    The prediction id comes from the row's key, so a rerun of a lost task gives
    the same id; a position in the file would not.
    """
    stamp = F.unix_timestamp(F.lit(as_of).cast("timestamp")).cast("string")
    risk = F.col("prob_default")
    return df.withColumns(
        {
            "prediction_id": F.concat(F.lit("pred_"), F.col("application_id").cast("string"), F.lit("_"), stamp),
            "risk_score": risk,
            "risk_level": scoring.risk_level_inference(risk),
            "confidence_score": F.greatest(risk, F.lit(1.0) - risk),
            "model_name": F.lit(model_name),
            "model_version": F.lit(model_version),
            "prediction_timestamp": F.lit(as_of),
            "prob_no_default": F.lit(1.0) - risk,
        }
    )


def batch_summary(df: DataFrame) -> DataFrame:
    """Totals of a prediction run, one row per risk level."""
    levels = df.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("risk_score").alias("score_sum"),
        F.sum("confidence_score").alias("confidence_sum"),
    )
    # The window holds one row per level.
    every = Window.partitionBy(F.lit(0))
    total = F.sum("records").over(every)
    return levels.select(
        "risk_level",
        "records",
        total.alias("total_records"),
        F.try_divide(F.sum("score_sum").over(every), total).alias("average_risk_score"),
        F.try_divide(F.sum("confidence_sum").over(every), total).alias("average_confidence"),
    )
