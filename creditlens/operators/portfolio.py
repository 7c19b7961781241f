"""Portfolio, decision and score analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions.scoring import clamp

RECORDS = "*"

# The share shown on a single application's analytics row.
ROW_APPROVAL_RATE = {"AUTO_APPROVE": 0.7, "AUTO_REJECT": 0.3}
ROW_APPROVAL_OTHER = 0.5


def count_of(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def percent(part: Column, whole: Column) -> Column:
    """A percentage with two decimals, in decimal arithmetic; null for nothing."""
    exact = F.try_divide(part.cast("decimal(18,0)"), whole.cast("decimal(18,0)")) * 100
    return F.round(exact, 2).cast("double")


def between(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows from start to end, both included; an open side is None."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("timestamp_ntz"))
    return df


def application_stats(applications: DataFrame) -> DataFrame:
    return applications.agg(
        F.count(RECORDS).alias("total_applications"),
        count_of("status", "APPROVED").alias("approved_count"),
        count_of("status", "REJECTED").alias("rejected_count"),
        count_of("status", "MANUAL_REVIEW").alias("manual_review_count"),
        count_of("status", "PENDING").alias("pending_count"),
        F.avg("loan_amnt").alias("avg_loan_amount"),
        F.sum("loan_amnt").alias("total_loan_amount"),
    )


def _decision_counts(with_review: bool = True) -> list[Column]:
    review = [count_of("decision", "MANUAL_REVIEW").alias("manual_review_count")] if with_review else []
    return [
        F.count(RECORDS).alias("total_decisions"),
        count_of("decision", "APPROVE").alias("approved_count"),
        count_of("decision", "REJECT").alias("rejected_count"),
        *review,
        F.avg("risk_score").alias("avg_risk_score"),
    ]


def _rate(name: str = "approval_rate") -> dict[str, Column]:
    return {name: percent(F.col("approved_count"), F.col("total_decisions"))}


def approval_rate(decisions: DataFrame, start=None, end=None) -> DataFrame:
    chosen = between(decisions, "decision_timestamp", start, end)
    return chosen.agg(*_decision_counts()).withColumns(_rate())


def underwriter_performance(decisions: DataFrame, underwriter: str | None = None) -> DataFrame:
    """All underwriters, busiest first; for one, also the first and last decision."""
    if underwriter is None:
        grouped = decisions.where(F.col("underwriter_id").isNotNull()).groupBy("underwriter_id")
        return (
            grouped.agg(*_decision_counts(False))
            .withColumns(_rate())
            .orderBy(F.col("total_decisions").desc(), "underwriter_id")
        )
    return (
        decisions.where(F.col("underwriter_id") == underwriter)
        .groupBy("underwriter_id")
        .agg(
            *_decision_counts(False),
            F.min("decision_timestamp").alias("first_decision"),
            F.max("decision_timestamp").alias("last_decision"),
        )
        .withColumns(_rate())
    )


def decision_trends(decisions: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """One row per day of the last days, newest first."""
    start = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    return (
        decisions.where(F.col("decision_timestamp") >= start)
        .groupBy(F.to_date("decision_timestamp").alias("decision_date"))
        .agg(*_decision_counts())
        .withColumns(_rate())
        .orderBy(F.col("decision_date").desc())
    )


def decision_stats(decisions: DataFrame) -> DataFrame:
    """Overall figures. Distinct underwriters are counted from one row per underwriter
    and outcome, so no set of ids builds up in one task."""
    per_underwriter = decisions.groupBy("underwriter_id").agg(
        *_decision_counts()[:4],
        F.sum("risk_score").alias("score_sum"),
        F.count("risk_score").alias("scores"),
        F.min("risk_score").alias("low"),
        F.max("risk_score").alias("high"),
    )
    return per_underwriter.agg(
        F.sum("total_decisions").alias("total_decisions"),
        F.sum("approved_count").alias("approved_count"),
        F.sum("rejected_count").alias("rejected_count"),
        F.sum("manual_review_count").alias("manual_review_count"),
        F.try_divide(F.sum("score_sum"), F.sum("scores")).alias("avg_risk_score"),
        F.min("low").alias("min_risk_score"),
        F.max("high").alias("max_risk_score"),
        F.count("underwriter_id").alias("active_underwriters"),
    ).withColumns(_rate("overall_approval_rate"))


def risk_score_stats(scores: DataFrame, start=None, end=None) -> DataFrame:
    return between(scores, "prediction_timestamp", start, end).agg(
        F.count(RECORDS).alias("total_predictions"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.min("risk_score").alias("min_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
        F.avg("processing_time_ms").alias("avg_processing_time"),
        count_of("risk_category", "LOW").alias("low_risk_count"),
        count_of("risk_category", "MEDIUM").alias("medium_risk_count"),
        count_of("risk_category", "HIGH").alias("high_risk_count"),
    )


def model_version_stats(scores: DataFrame) -> DataFrame:
    """Figures of every model version in one pass."""
    return scores.groupBy("model_version").agg(
        F.count(RECORDS).alias("prediction_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.stddev_samp("risk_score").alias("risk_score_stddev"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.avg("processing_time_ms").alias("avg_processing_time"),
    )


def daily_portfolio(applications: DataFrame) -> DataFrame:
    return (
        applications.groupBy(F.to_date("created_at").alias("date"))
        .agg(
            F.count(RECORDS).alias("total_applications"),
            count_of("status", "APPROVED").alias("approved_count"),
            count_of("status", "REJECTED").alias("rejected_count"),
            F.avg("loan_amnt").alias("avg_loan_amount"),
            F.sum("loan_amnt").alias("total_loan_amount"),
        )
        .orderBy(F.col("date").desc())
    )


def portfolio_analytics(decided: DataFrame) -> DataFrame:
    """Daily analytics rows of decided applications with their outcome.

    The default rate is the share of loans that defaulted.
    """
    return decided.groupBy(F.to_date("created_at").alias("date")).agg(
        F.count(RECORDS).alias("total_applications"),
        count_of("decision", "AUTO_APPROVE").alias("approved_count"),
        count_of("decision", "AUTO_REJECT").alias("rejected_count"),
        count_of("decision", "MANUAL_REVIEW").alias("manual_review_count"),
        F.sum("loan_amnt").alias("total_loan_amount"),
        F.sum(F.when(F.col("decision") == "AUTO_APPROVE", F.col("loan_amnt")).otherwise(F.lit(0.0))).alias(
            "approved_loan_amount"
        ),
        F.avg("risk_score").alias("average_risk_score"),
        F.avg("loan_status").alias("default_rate"),
    )


def _running() -> list[Column]:
    decision = F.coalesce(F.col("decision"), F.lit("MANUAL_REVIEW"))
    return [
        F.count(RECORDS).alias("total_applications"),
        F.count_if(decision == "AUTO_APPROVE").alias("approved_applications"),
        F.count_if(decision == "AUTO_REJECT").alias("rejected_applications"),
        F.count_if(~decision.isin("AUTO_APPROVE", "AUTO_REJECT")).alias("pending_review"),
        F.sum(F.coalesce(F.col("loan_amnt"), F.lit(0.0))).alias("total_loan_amount"),
        F.avg(F.coalesce(F.col("risk_score"), F.lit(0.5))).alias("average_risk_score"),
    ]


def portfolio_totals(decided: DataFrame, *by: Column) -> DataFrame:
    """Running totals; the same on a batch and on a stream."""
    return decided.groupBy(*by).agg(*_running())


def portfolio_distribution(decided: DataFrame) -> DataFrame:
    """Risk and loan-size distribution with means and the true approval rate."""
    risk, loan = F.col("risk_score"), F.col("loan_amnt")
    return decided.agg(
        F.count_if(risk < 0.3).alias("low_risk"),
        F.count_if(risk.between(0.3, 0.7)).alias("medium_risk"),
        F.count_if(risk > 0.7).alias("high_risk"),
        F.count_if(loan < 10000).alias("small_loans"),
        F.count_if(loan.between(10000, 50000)).alias("medium_loans"),
        F.count_if(loan > 50000).alias("large_loans"),
        F.avg(loan).alias("average_loan_amount"),
        F.avg(risk).alias("average_risk_score"),
        F.try_divide(count_of("decision", "AUTO_APPROVE"), F.count(RECORDS)).alias("approval_rate"),
    )


def health_score(approval: Column, average_risk: Column) -> Column:
    return clamp(approval * 0.6 + (F.lit(1.0) - average_risk) * 0.4)


def portfolio_health(decided: DataFrame) -> DataFrame:
    return portfolio_distribution(decided).select(
        "approval_rate",
        "average_risk_score",
        health_score(F.col("approval_rate"), F.col("average_risk_score")).alias("health_score"),
    )


def row_approval_rate(decision: Column) -> Column:
    result = F.lit(ROW_APPROVAL_OTHER)
    for value, rate in ROW_APPROVAL_RATE.items():
        result = F.when(decision == value, F.lit(rate)).otherwise(result)
    return result


def analytics_rows(decided: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """One analytics row per application, kept for ninety days."""
    return decided.select(
        "application_id",
        "decision",
        "risk_score",
        "risk_level",
        F.col("loan_amnt").alias("loan_amount"),
        "person_income",
        "loan_grade",
        row_approval_rate(F.col("decision")).alias("approval_rate"),
        (F.unix_timestamp(F.lit(as_of).cast("timestamp")) + days * 86400).alias("ttl"),
    )


def insights(decided: DataFrame) -> DataFrame:
    """One to three messages per application."""
    decision, risk = F.col("decision"), F.col("risk_score")
    verdict = (
        F.when(decision == "AUTO_APPROVE", "Low-risk application approved automatically")
        .when(decision == "AUTO_REJECT", "High-risk application rejected automatically")
        .otherwise("Medium-risk application requires manual review")
    )
    profile = F.when(risk < 0.3, "Excellent credit profile").when(risk > 0.7, "High default risk detected")
    large = F.when(F.col("loan_amnt") > 50000, "Large loan amount - increased scrutiny applied")
    return decided.select(
        "application_id",
        "decision",
        "risk_score",
        F.col("loan_amnt").alias("loan_amount"),
        row_approval_rate(decision).alias("approval_rate"),
        F.array_compact(F.array(verdict, profile, large)).alias("insights"),
    )
