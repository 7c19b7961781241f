"""Data drift, performance degradation and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions.special import chi_square_p_value, ks_p_value
from creditlens.operators.evaluation import performance
from creditlens.operators.profiling import describe, text_pairs
from creditlens.operators.quantiles import largest_gap, number, value_counts
from creditlens.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

# Thresholds and the performance a model is held to.
KS_LIMIT = 0.05
PSI_LIMIT = 0.2
CHI_SQUARE_LIMIT = 0.05
DRIFT_SHARE = 0.1
DEGRADATION_LIMIT = 0.05
DEGRADED_SHARE = 0.05
EXPECTED = {"accuracy": 0.85, "precision": 0.82, "recall": 0.80, "f1_score": 0.81, "auc_score": 0.83}


def baseline_numeric(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Mean, deviation, extremes, median and quartiles per column."""
    return describe(df, columns).select(
        "column_name", "mean", "std", "min", "max", F.col("q50").alias("median"), "q25", "q75"
    )


def baseline_categorical(df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Share of each value per column."""
    counts = text_pairs(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    # One row per column of the list, so this side stays small.
    totals = counts.groupBy("column_name").agg(F.sum("rows").alias("total"))
    return counts.join(F.broadcast(totals), "column_name").select(
        "column_name", "value", F.try_divide(F.col("rows"), F.col("total")).alias("share")
    )


def _sides(baseline: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    left = baseline.select(*columns).withColumn("__side", F.lit(0))
    return left.unionByName(current.select(*columns).withColumn("__side", F.lit(1)))


def _side_counts() -> dict[str, Column]:
    return {
        "baseline": F.when(F.col("__side") == 0, 1).otherwise(0),
        "current": F.when(F.col("__side") == 1, 1).otherwise(0),
    }


def drift_ks(baseline: DataFrame, current: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per numeric column."""
    both = _sides(baseline, current, columns)
    counts = value_counts(both, columns, _side_counts(), keep=["__side"])
    gaps = largest_gap(counts, "baseline", "current")
    p = ks_p_value(F.col("gap"), F.col("left_all"), F.col("right_all"))
    return gaps.select(
        F.col("column").alias("column_name"), F.col("gap").alias("statistic"), p.alias("p_value")
    ).withColumn("drift_detected", F.col("p_value") < KS_LIMIT)


def drift_psi(
    baseline: DataFrame, current: DataFrame, columns: list[str] = NUMERIC_FEATURES, bins: int = 10
) -> DataFrame:
    """Population stability index over equal-width bins of the joint range.

    The last bin is closed; bins empty on either side do not count, nor do nulls and NaN.
    """
    both = _sides(baseline, current, columns)
    ends = both.agg(
        *[F.min(number(c)).alias(f"{c}#min") for c in columns],
        *[F.max(number(c)).alias(f"{c}#max") for c in columns],
    ).first()

    def bin_of(c: str) -> Column:
        low, high = ends[f"{c}#min"], ends[f"{c}#max"]
        if low is None or low == high:
            return F.when(number(c).isNotNull(), F.lit(0))
        width = (high - low) / bins
        # least passes over nulls, so they are kept out here.
        return F.when(number(c).isNotNull(), _capped_bin(c, low, width))

    def _capped_bin(c: str, low: float, width: float) -> Column:
        return F.least(F.floor((number(c) - F.lit(low)) / F.lit(width)).cast("int"), F.lit(bins - 1))

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), bin_of(c).alias("bin")) for c in columns])
    counts = (
        both.select("__side", F.inline(pairs))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(*[F.sum(m).alias(name) for name, m in _side_counts().items()])
    )
    totals = counts.groupBy("column").agg(F.sum("baseline").alias("all_b"), F.sum("current").alias("all_c"))
    b, c = F.col("baseline") / F.col("all_b"), F.col("current") / F.col("all_c")
    term = F.when((F.col("baseline") > 0) & (F.col("current") > 0), (c - b) * F.log(c / b)).otherwise(F.lit(0.0))
    return (
        counts.join(F.broadcast(totals), "column")
        .groupBy(F.col("column").alias("column_name"))
        .agg(F.sum(term).alias("psi"))
        .withColumn("drift_detected", F.col("psi") > PSI_LIMIT)
    )


def drift_chi2(baseline: DataFrame, current: DataFrame, columns: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Chi-square homogeneity test per category column."""
    counts = (
        text_pairs(_sides(baseline, current, columns), columns, keep=["__side"])
        .groupBy("column_name", "value")
        .agg(*[F.sum(m).cast("double").alias(name) for name, m in _side_counts().items()])
    )
    totals = counts.groupBy("column_name").agg(F.sum("baseline").alias("all_b"), F.sum("current").alias("all_c"))
    row_total, everything = F.col("baseline") + F.col("current"), F.col("all_b") + F.col("all_c")

    def cell(observed: str, total: str) -> Column:
        expected = row_total * F.col(total) / everything
        return F.when(expected > 0, F.pow(F.col(observed) - expected, 2) / expected).otherwise(F.lit(0.0))

    tested = (
        counts.join(F.broadcast(totals), "column_name")
        .groupBy("column_name")
        .agg(
            F.sum(cell("baseline", "all_b") + cell("current", "all_c")).alias("statistic"),
            (F.count(F.lit(1)) - 1).cast("int").alias("df"),
        )
    )
    return tested.withColumn("p_value", chi_square_p_value(F.col("statistic"), F.col("df"))).withColumn(
        "drift_detected", F.col("p_value") < CHI_SQUARE_LIMIT
    )


def drift_tests(baseline: DataFrame, current: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> DataFrame:
    """All tests as rows (column_name, test, value, p_value, drift_detected)."""

    def rows(df: DataFrame, test: str, value: str, p: Column) -> DataFrame:
        return df.select(
            "column_name",
            F.lit(test).alias("test"),
            F.col(value).alias("value"),
            p.alias("p_value"),
            "drift_detected",
        )

    return (
        rows(drift_ks(baseline, current, numeric), "ks_test", "statistic", F.col("p_value"))
        .unionByName(rows(drift_psi(baseline, current, numeric), "psi", "psi", F.lit(None).cast("double")))
        .unionByName(rows(drift_chi2(baseline, current, categorical), "chi_square", "statistic", F.col("p_value")))
    )


def drift_summary(tests: DataFrame) -> DataFrame:
    """How many columns drifted by any test, and whether that is too many."""
    per_column = tests.groupBy("column_name").agg(F.bool_or("drift_detected").alias("drifted"))
    return per_column.agg(
        F.count(F.lit(1)).alias("total_features"), F.count_if(F.col("drifted")).alias("drifted_features")
    ).select(
        "total_features",
        "drifted_features",
        F.coalesce(
            F.try_divide(F.col("drifted_features") * F.lit(100.0), F.col("total_features")), F.lit(0.0)
        ).alias("drift_percentage"),
        (F.col("drifted_features") > F.col("total_features") * F.lit(DRIFT_SHARE)).alias("overall_drift_detected"),
    )


def degradation(metrics: DataFrame, expected: dict[str, float] = EXPECTED, direction: str = "decrease") -> DataFrame:
    """Each metric against what is expected of it."""
    wanted = F.coalesce(*[F.when(F.col("metric") == m, F.lit(v)) for m, v in expected.items()])
    sign = 1.0 if direction == "decrease" else -1.0
    return (
        metrics.withColumn("baseline_value", wanted)
        .where(F.col("baseline_value").isNotNull())
        .select(
            "metric",
            "baseline_value",
            F.col("value").alias("current_value"),
            ((F.col("baseline_value") - F.col("value")) * F.lit(sign)).alias("degradation"),
            F.lit(DEGRADATION_LIMIT).alias("threshold"),
        )
        .withColumn("alert_triggered", F.col("degradation") > F.col("threshold"))
    )


def degradation_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(
        F.count(F.lit(1)).alias("total_metrics"), F.count_if(F.col("alert_triggered")).alias("degraded_metrics")
    ).select(
        "total_metrics",
        "degraded_metrics",
        F.coalesce(F.try_divide(F.col("degraded_metrics") * F.lit(100.0), F.col("total_metrics")), F.lit(0.0)).alias(
            "degradation_percentage"
        ),
        (F.col("degraded_metrics") > F.col("total_metrics") * F.lit(DEGRADED_SHARE)).alias(
            "overall_degradation_detected"
        ),
    )


def alerts(drift: DataFrame, degraded: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """Alert rows for what the summaries flag; delivering them is left to the caller."""

    def rows(df: DataFrame, condition: Column, kind: str, message: Column) -> DataFrame:
        return df.where(condition).select(
            F.lit(kind).alias("alert_type"), F.lit("HIGH").alias("severity"), message.alias("message")
        )

    drifted = F.concat(
        F.lit("Data drift detected: "),
        F.format_string("%.1f", "drift_percentage"),
        F.lit("% of features drifted"),
    )
    worse = F.concat(
        F.lit("Performance degradation detected: "),
        F.format_string("%.1f", "degradation_percentage"),
        F.lit("% of metrics degraded"),
    )
    result = rows(drift, F.col("overall_drift_detected"), "DATA_DRIFT", drifted).unionByName(
        rows(degraded, F.col("overall_degradation_detected"), "PERFORMANCE_DEGRADATION", worse)
    )
    if quality is not None:
        low = F.concat(F.lit("Data quality score "), F.format_string("%.3f", "overall_score"), F.lit(" is low"))
        result = result.unionByName(rows(quality, F.col("alert_triggered"), "DATA_QUALITY", low))
    return result


def monitoring_status(drift: DataFrame, degraded: DataFrame) -> DataFrame:
    """The closing row of a monitoring run."""
    state = drift.select("overall_drift_detected", F.lit(0).alias("k")).join(
        degraded.select("overall_degradation_detected", F.lit(0).alias("k")), "k"
    )
    healthy = ~(F.col("overall_drift_detected") | F.col("overall_degradation_detected"))
    return state.select(
        F.col("overall_drift_detected").alias("data_drift_detected"),
        F.col("overall_degradation_detected").alias("performance_degradation_detected"),
        F.when(healthy, "HEALTHY").otherwise("ISSUES_DETECTED").alias("overall_status"),
    )


def run_monitoring(baseline: DataFrame, current: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> dict:
    """Drift, performance, alerts and status as frames; skipped without current data."""
    if current.isEmpty():
        return {"status": "SKIPPED", "reason": "No current data"}
    tests = drift_tests(baseline, current, numeric, categorical)
    drift = drift_summary(tests)
    checked = degradation(performance(current))
    degraded = degradation_summary(checked)
    return {
        "status": "SUCCESS",
        "drift_tests": tests,
        "drift_summary": drift,
        "performance": checked,
        "performance_summary": degraded,
        "alerts": alerts(drift, degraded),
        "report": monitoring_status(drift, degraded),
    }


