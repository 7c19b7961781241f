"""Data-quality dimensions, their weighted score and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.operators.cleaning import as_rows, duplicate_counts

# Weights, thresholds and advice of the quality report.
WEIGHTS = {"completeness": 0.25, "validity": 0.25, "consistency": 0.20, "uniqueness": 0.15, "freshness": 0.15}
PASS_THRESHOLD = 0.95
ALERT_THRESHOLD = 0.90
ADVICE = [
    ("completeness", 0.95, "Data completeness is low - investigate missing value patterns"),
    ("validity", 0.95, "Data validity issues detected - check data types and ranges"),
    ("consistency", 0.90, "Data consistency issues found - review business rules"),
    ("uniqueness", 0.99, "Duplicate records detected - implement deduplication"),
    ("freshness", 0.8, "Data is stale - check processing pipeline"),
]
FRESH_DAYS = 30
MISSING_LIMIT = 5
MISSING_PENALTY = 0.1



def _weighted_count(condition: Column, weight: Column | None) -> Column:
    """How many rows meet a condition, each row standing for ``weight`` copies."""
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))


def _total(weight: Column | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0))


def ingestion_report(df: DataFrame, target: str = "loan_status") -> DataFrame:
    """Rows (section, item, value) of the ingestion report.

    One pass over the feed, plus one grouping by target.
    """
    total = F.count(F.lit(1))
    wide = df.agg(total.alias("total_records"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    share = [F.try_divide(F.col(c) * F.lit(100.0), F.col("total_records")) for c in df.columns]
    failing = sum((F.when(s > MISSING_LIMIT, 1).otherwise(0) for s in share), F.lit(0))
    score = F.lit(1.0) - failing * F.lit(MISSING_PENALTY)

    def row(section: str, item: str, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(item).alias("item"), value.cast("double").alias("value"))

    rows = [
        row("summary", "total_records", F.col("total_records")),
        row("summary", "quality_score", score),
        row("summary", "quality_passed", F.when(score >= PASS_THRESHOLD, 1).otherwise(0)),
        *[row("missing_count", c, F.col(c)) for c in df.columns],
        *[row("missing_percentage", c, s) for c, s in zip(df.columns, share)],
    ]
    report = wide.select(F.inline(F.array(*rows)))
    classes = df.groupBy(target).agg(total.alias("value"))
    distribution = classes.select(
        F.lit("target_count").alias("section"),
        F.coalesce(F.col(target).cast("string"), F.lit("null")).alias("item"),
        F.col("value").cast("double").alias("value"),
    )
    return report.unionByName(distribution)


def ingestion_score(report: DataFrame) -> float:
    return report.where(F.col("item") == "quality_score").first()["value"]


def _is_empty_text(df: DataFrame, name: str) -> Column:
    return F.col(name) == "" if dict(df.dtypes)[name] == "string" else F.lit(False)


def completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls and empty texts per column, all columns in one pass."""
    columns = columns or df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}#null") for c in columns],
        *[F.count_if(_is_empty_text(df, c)).alias(f"{c}#empty") for c in columns],
    )

    def row(c: str) -> Column:
        missing = F.col(f"{c}#null") + F.col(f"{c}#empty")
        percentage = F.try_divide(missing * F.lit(100.0), F.col("total_records"))
        return F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}#null").alias("missing_values"),
            F.col(f"{c}#empty").alias("empty_strings"),
            missing.alias("total_missing"),
            percentage.alias("missing_percentage"),
            (F.lit(1.0) - percentage / 100).alias("completeness_score"),
        )

    return wide.select(F.inline(F.array(*[row(c) for c in columns])))


def _invalid(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind == "double":
        return F.col(name).isNull() | F.isnan(name)
    if kind in ("int", "string"):
        return F.col(name).isNull()
    return F.lit(False)


def _range_checks() -> dict[str, tuple[str, Column]]:
    return {
        "person_age": ("age_outliers", (F.col("person_age") < 18) | (F.col("person_age") > 100)),
        "person_income": ("negative_income", F.col("person_income") < 0),
        "loan_amnt": ("negative_loans", F.col("loan_amnt") < 0),
        "loan_int_rate": ("invalid_rates", (F.col("loan_int_rate") < 0) | (F.col("loan_int_rate") > 50)),
    }


def validity(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Invalid values per column by type; range violations are counted beside them."""
    columns = columns or df.columns
    ranges = _range_checks()
    wide = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(_invalid(df, c)).alias(f"{c}#bad") for c in columns],
        *[F.count_if(ranges[c][1]).alias(f"{c}#range") for c in columns if c in ranges],
    )
    kinds = dict(df.dtypes)

    def row(c: str) -> Column:
        bad = F.col(f"{c}#bad")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kinds[c]).alias("data_type"),
            (F.col("total_records") - bad).alias("valid_records"),
            bad.alias("invalid_records"),
            F.try_divide(F.col("total_records") - bad, F.col("total_records")).alias("validity_score"),
            (F.lit(ranges[c][0]) if c in ranges else F.lit(None).cast("string")).alias("range_check"),
            (F.col(f"{c}#range") if c in ranges else F.lit(None).cast("bigint")).alias("range_violations"),
        )

    return wide.select(F.inline(F.array(*[row(c) for c in columns])))


def _consistency_rules() -> dict[str, Column]:
    grade, rate = F.col("loan_grade"), F.col("loan_int_rate")
    return {
        "age_employment_consistency": F.col("person_emp_length") > F.col("person_age") - 18,
        "debt_income_consistency": F.col("loan_percent_income") > 1.0,
        "grade_rate_consistency": ((grade == "A") & (rate > 15))
        | ((grade == "B") & (rate > 20))
        | ((grade == "C") & (rate > 25)),
    }


def consistency(df: DataFrame) -> DataFrame:
    """Broken rules and copies, from one grouping by whole rows.

    Each distinct row carries its number of copies, which weights the rule counts,
    so duplicates and rules share one shuffle.
    """
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    rules = _consistency_rules()
    wide = copies.agg(
        _total(F.col("__n")).alias("total_records"),
        *[_weighted_count(rule, F.col("__n")).alias(name) for name, rule in rules.items()],
        (_total(F.col("__n")) - F.count(F.lit(1))).alias("duplicate_consistency"),
    )

    def row(name: str) -> Column:
        broken = F.col(name)
        share = F.try_divide(broken.cast("double"), F.col("total_records"))
        return F.struct(
            F.lit(name).alias("rule"),
            broken.alias("inconsistent_records"),
            (share * 100).alias("percentage"),
            (F.lit(1.0) - share).alias("consistency_score"),
        )

    return wide.select(F.inline(F.array(*[row(name) for name in [*rules, "duplicate_consistency"]])))


def uniqueness(df: DataFrame) -> DataFrame:
    counts = duplicate_counts(df)
    return counts.withColumn("uniqueness_score", F.try_divide(F.col("unique_records"), F.col("total_records")))


def freshness(df: DataFrame, as_of: str, column: str = "processing_date") -> DataFrame:
    """Age of the newest date; a frame without the column counts as fresh."""
    if column not in df.columns:
        return df.sparkSession.range(1).select(
            F.lit(None).cast("date").alias("latest_processing_date"),
            F.lit(None).cast("int").alias("days_old"),
            F.lit(1.0).alias("freshness_score"),
        )
    newest = df.agg(F.max(F.to_date(column)).alias("latest_processing_date"))
    days = F.datediff(F.lit(as_of).cast("date"), F.col("latest_processing_date"))
    return newest.select(
        "latest_processing_date",
        days.alias("days_old"),
        F.greatest(F.lit(0.0), F.lit(1.0) - days / F.lit(float(FRESH_DAYS))).alias("freshness_score"),
    )


def dimensions(df: DataFrame, as_of: str, date_column: str = "processing_date") -> DataFrame:
    """The five dimension scores as one row.

    Everything comes from one grouping by whole rows, weighted by copies: one scan
    and one shuffle for the whole quality job, where a count per column and rule
    would read the data some forty times.
    """
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    n = F.col("__n")
    total = _total(n).alias("total_records")
    rules = _consistency_rules()
    dated = date_column in df.columns
    wide = copies.agg(
        total,
        F.count(F.lit(1)).alias("unique_records"),
        *[
            _weighted_count(F.col(c).isNull() | _is_empty_text(df, c), n).alias(f"{c}#missing")
            for c in df.columns
        ],
        *[_weighted_count(_invalid(df, c), n).alias(f"{c}#bad") for c in df.columns],
        *[_weighted_count(rule, n).alias(name) for name, rule in rules.items()],
        (F.max(F.to_date(date_column)) if dated else F.lit(None).cast("date")).alias("latest"),
    )

    def mean_of(parts: list[Column]) -> Column:
        whole = sum(parts[1:], parts[0])
        return F.lit(1.0) - F.try_divide(whole.cast("double"), F.col("total_records") * len(parts))

    copies_lost = F.col("total_records") - F.col("unique_records")
    days = F.datediff(F.lit(as_of).cast("date"), F.col("latest"))
    return wide.select(
        mean_of([F.col(f"{c}#missing") for c in df.columns]).alias("completeness"),
        mean_of([F.col(f"{c}#bad") for c in df.columns]).alias("validity"),
        mean_of([*[F.col(name) for name in rules], copies_lost]).alias("consistency"),
        F.try_divide(F.col("unique_records"), F.col("total_records")).alias("uniqueness"),
        (
            F.greatest(F.lit(0.0), F.lit(1.0) - days / F.lit(float(FRESH_DAYS))) if dated else F.lit(1.0)
        ).alias("freshness"),
    )


def overall(scores: DataFrame) -> DataFrame:
    """Add the weighted score."""
    parts = [F.col(name) * weight for name, weight in WEIGHTS.items()]
    return scores.withColumn("overall_score", sum(parts[1:], parts[0]))


def report(scores: DataFrame) -> DataFrame:
    """Verdict and advice for a row of dimension scores."""
    scored = overall(scores)
    advice = F.array_compact(F.array(*[F.when(F.col(d) < limit, F.lit(text)) for d, limit, text in ADVICE]))
    return scored.withColumns(
        {
            "quality_passed": F.col("overall_score") >= PASS_THRESHOLD,
            "alert_triggered": F.col("overall_score") < ALERT_THRESHOLD,
            "recommendations": advice,
        }
    )


def quality_job(spark, path: str, as_of: str) -> dict:
    """Read, score and report; the outcome tells success from failure."""
    from creditlens.sources.readers import read_any

    try:
        row = report(dimensions(read_any(spark, path), as_of)).first()
        return {
            "status": "SUCCESS",
            "quality_score": row["overall_score"],
            "quality_passed": row["quality_passed"],
            "alert_triggered": row["alert_triggered"],
            "recommendations": row["recommendations"],
        }
    except Exception as error:  # the job reports its failure instead of raising
        return {"status": "FAILED", "error": str(error)}


def final_validation(df: DataFrame, target: str = "loan_status") -> DataFrame:
    """Shape, nulls, copies, infinities and class balance as (metric, value) rows."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    n = F.col("__n")
    doubles = [c for c, kind in df.dtypes if kind in ("double", "float")]
    numbers = [c for c, kind in df.dtypes if kind != "string"]
    infinite = [F.abs(F.col(c)) == float("inf") for c in doubles]
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    infinities = sum((F.when(i, 1).otherwise(0) for i in infinite), F.lit(0))
    wide = copies.agg(
        _total(n).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.lit(len(numbers)).alias("numeric_columns"),
        F.lit(len(df.columns) - len(numbers)).alias("categorical_columns"),
        F.coalesce(F.sum(nulls * n), F.lit(0)).alias("missing_values"),
        (_total(n) - F.count(F.lit(1))).alias("duplicate_rows"),
        F.coalesce(F.sum(infinities * n), F.lit(0)).alias("infinite_values"),
        F.try_divide(_weighted_count(F.col(target) == 1, n), F.sum(F.when(F.col(target).isNotNull(), n))).alias(
            "default_rate"
        ),
        F.try_divide(_weighted_count(F.col(target) == 0, n), F.sum(F.when(F.col(target).isNotNull(), n))).alias(
            "non_default_rate"
        ),
        F.try_divide(_weighted_count(F.col(target) == 0, n), _weighted_count(F.col(target) == 1, n)).alias(
            "class_imbalance_ratio"
        ),
    )
    return as_rows(wide.select(*[F.col(c).cast("double").alias(c) for c in wide.columns]), "metric", "value")


def cleaning_score(duplicates: Column, missing: Column, infinite: Column) -> Column:
    """Points out of a hundred after cleaning."""
    score = (
        F.lit(100)
        - F.when(duplicates > 0, 5).otherwise(0)
        - F.when(missing > 0, 10).otherwise(0)
        - F.when(infinite > 0, 15).otherwise(0)
    )
    return F.greatest(score, F.lit(0))


