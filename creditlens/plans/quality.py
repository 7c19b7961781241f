"""Queries: the quality dimensions, their score and the report."""

from pyspark.sql import functions as F

from creditlens.operators import quality as ops
from creditlens.plans.fixtures import AS_OF, CLEAN_COLUMNS, Tables
from creditlens.plans.registry import query
from creditlens.plans.shape import as_text, joined, rounded

INTS = ("person_age", "cb_person_cred_hist_length", "loan_status")
TEXTS = ("person_home_ownership", "loan_intent", "loan_grade", "cb_person_default_on_file")


def kind_of(name: str) -> str:
    if name == "application_id":
        return "bigint"
    return "int" if name in INTS else "string" if name in TEXTS else "double"


def per_column(body, source: str = "feed_dup") -> str:
    """One SELECT per column, over the whole table each."""
    return " UNION ALL ".join(f"SELECT {body(c)} FROM {source}" for c in CLEAN_COLUMNS)


NULLS = " + ".join(
    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*) > 5 THEN 1 ELSE 0 END" for c in CLEAN_COLUMNS
)


@query(
    "dq_ingestion",
    uses=("feed_dup",),
    sql=f""", s AS (SELECT count(*) AS n, 1.0::DOUBLE - ({NULLS}) * 0.1::DOUBLE AS score FROM feed_dup)
SELECT 'summary' AS section, 'total_records' AS item, n::DOUBLE AS value FROM s
UNION ALL SELECT 'summary', 'quality_score', round(score, 6) FROM s
UNION ALL SELECT 'summary', 'quality_passed', CASE WHEN score >= 0.95::DOUBLE THEN 1 ELSE 0 END FROM s
UNION ALL SELECT * FROM ({per_column(lambda c: f"'missing_count', '{c}', count(*) FILTER (WHERE {c} IS NULL)::DOUBLE")})
UNION ALL SELECT * FROM ({per_column(lambda c: f"'missing_percentage', '{c}', round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 6)")})
UNION ALL SELECT 'target_count', loan_status::VARCHAR, count(*)::DOUBLE FROM feed_dup GROUP BY loan_status""",
)
def dq_ingestion(t: Tables):
    return rounded(ops.ingestion_report(t.feed_dup), "value")


MISSING_TEXT = {c: f"count(*) FILTER (WHERE {c} = '')" if c in TEXTS else "0::BIGINT" for c in CLEAN_COLUMNS}


@query(
    "dq_completeness",
    uses=("feed_dup",),
    sql=f"""SELECT column_name, missing_values, empty_strings, missing_values + empty_strings AS total_missing,
  round((missing_values + empty_strings) * 100.0::DOUBLE / n, 6) AS missing_percentage,
  round(1 - (missing_values + empty_strings)::DOUBLE / n, 6) AS completeness_score
FROM ({per_column(lambda c: f"'{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_values, {MISSING_TEXT[c]} AS empty_strings, count(*) AS n")})""",
)
def dq_completeness(t: Tables):
    return rounded(ops.completeness(t.feed_dup), "missing_percentage", "completeness_score")


RANGES = {
    "person_age": ("age_outliers", "person_age < 18 OR person_age > 100"),
    "person_income": ("negative_income", "person_income < 0"),
    "loan_amnt": ("negative_loans", "loan_amnt < 0"),
    "loan_int_rate": ("invalid_rates", "loan_int_rate < 0 OR loan_int_rate > 50"),
}


def _validity_row(c: str) -> str:
    bad = "0::BIGINT" if kind_of(c) == "bigint" else f"count(*) FILTER (WHERE {c} IS NULL)"
    name, rule = RANGES.get(c, (None, None))
    check = f"'{name}'" if name else "NULL::VARCHAR"
    hits = f"count(*) FILTER (WHERE {rule})" if name else "NULL::BIGINT"
    return (
        f"'{c}' AS column_name, '{kind_of(c)}' AS data_type, count(*) - {bad} AS valid_records, {bad} AS invalid_records, "
        f"round((count(*) - {bad})::DOUBLE / count(*), 6) AS validity_score, {check} AS range_check, {hits} AS range_violations"
    )


@query("dq_validity", uses=("feed_dup",), sql=per_column(_validity_row))
def dq_validity(t: Tables):
    return rounded(ops.validity(t.feed_dup), "validity_score")


GRADE_RATE = """(loan_grade = 'A' AND loan_int_rate > 15) OR (loan_grade = 'B' AND loan_int_rate > 20) OR (loan_grade = 'C' AND loan_int_rate > 25)"""


CONSISTENCY_SQL = f""", n AS (SELECT count(*) AS n FROM feed_dup), c AS (
  SELECT 'age_employment_consistency' AS rule, count(*) FILTER (WHERE person_emp_length > person_age - 18) AS bad FROM feed_dup
  UNION ALL SELECT 'debt_income_consistency', count(*) FILTER (WHERE loan_percent_income > 1.0) FROM feed_dup
  UNION ALL SELECT 'grade_rate_consistency', count(*) FILTER (WHERE {GRADE_RATE}) FROM feed_dup
  UNION ALL SELECT 'duplicate_consistency', (SELECT n FROM n) - (SELECT count(*) FROM (SELECT DISTINCT * FROM feed_dup)))
SELECT rule, bad AS inconsistent_records, round(bad * 100.0::DOUBLE / n, 6) AS percentage, round(1 - bad::DOUBLE / n, 6) AS consistency_score FROM c CROSS JOIN n"""


@query("dq_consistency", uses=("feed_dup",), sql=CONSISTENCY_SQL)
def dq_consistency(t: Tables):
    return rounded(ops.consistency(t.feed_dup), "percentage", "consistency_score")


@query(
    "dq_uniqueness",
    uses=("feed_dup",),
    sql="""SELECT total_records, unique_records, total_records - unique_records AS duplicate_records,
  round(unique_records::DOUBLE / total_records, 6) AS uniqueness_score
FROM (SELECT (SELECT count(*) FROM feed_dup) AS total_records, (SELECT count(*) FROM (SELECT DISTINCT * FROM feed_dup)) AS unique_records)""",
)
def dq_uniqueness(t: Tables):
    return rounded(ops.uniqueness(t.feed_dup), "uniqueness_score")


FRESH_SQL = f"round(greatest(0.0::DOUBLE, 1 - date_diff('day', max(created_at)::DATE, DATE '{AS_OF}') / 30.0::DOUBLE), 6)"


@query(
    "dq_freshness",
    uses=("apps",),
    sql=f"""SELECT max(created_at)::DATE::VARCHAR AS latest_processing_date,
  CAST(date_diff('day', max(created_at)::DATE, DATE '{AS_OF}') AS INTEGER) AS days_old, {FRESH_SQL} AS freshness_score FROM apps""",
)
def dq_freshness(t: Tables):
    dated = t.apps.withColumn("processing_date", F.to_date("created_at"))
    return as_text(rounded(ops.freshness(dated, AS_OF), "freshness_score"), "latest_processing_date")


MISSING_SUM = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in CLEAN_COLUMNS)
INVALID_SUM = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in CLEAN_COLUMNS if kind_of(c) != "bigint")
WIDTH = len(CLEAN_COLUMNS)
DIMENSIONS_SQL = f""", n AS (SELECT count(*)::DOUBLE AS n FROM feed_dup), u AS (SELECT count(*)::DOUBLE AS u FROM (SELECT DISTINCT * FROM feed_dup)),
d AS (SELECT 1 - ({MISSING_SUM}) / (count(*) * {WIDTH}.0::DOUBLE) AS completeness, 1 - ({INVALID_SUM}) / (count(*) * {WIDTH}.0::DOUBLE) AS validity,
  1 - (count(*) FILTER (WHERE person_emp_length > person_age - 18) + count(*) FILTER (WHERE loan_percent_income > 1.0)
    + count(*) FILTER (WHERE {GRADE_RATE}) + any_value(n) - any_value(u)) / (count(*) * 4.0::DOUBLE) AS consistency,
  any_value(u) / any_value(n) AS uniqueness, 1.0::DOUBLE AS freshness FROM feed_dup CROSS JOIN n CROSS JOIN u),
o AS (SELECT *, completeness * 0.25::DOUBLE + validity * 0.25::DOUBLE + consistency * 0.2::DOUBLE + uniqueness * 0.15::DOUBLE + freshness * 0.15::DOUBLE AS overall_score FROM d)"""
SCORES = ["completeness", "validity", "consistency", "uniqueness", "freshness", "overall_score"]
SCORES_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in SCORES)


@query("dq_overall", uses=("feed_dup",), sql=f"{DIMENSIONS_SQL} SELECT {SCORES_SQL} FROM o")
def dq_overall(t: Tables):
    return rounded(ops.overall(ops.dimensions(t.feed_dup, AS_OF)), *SCORES)


REPORT_SQL = f"""SELECT {SCORES_SQL}, overall_score >= 0.95 AS quality_passed, overall_score < 0.9 AS alert_triggered,
  concat_ws(' | ', CASE WHEN completeness < 0.95 THEN 'Data completeness is low - investigate missing value patterns' END,
  CASE WHEN validity < 0.95 THEN 'Data validity issues detected - check data types and ranges' END,
  CASE WHEN consistency < 0.9 THEN 'Data consistency issues found - review business rules' END,
  CASE WHEN uniqueness < 0.99 THEN 'Duplicate records detected - implement deduplication' END,
  CASE WHEN freshness < 0.8 THEN 'Data is stale - check processing pipeline' END) AS recommendations FROM o"""


@query("dq_report", uses=("feed_dup",), sql=f"{DIMENSIONS_SQL} {REPORT_SQL}")
def dq_report(t: Tables):
    return joined(rounded(ops.report(ops.dimensions(t.feed_dup, AS_OF)), *SCORES), "recommendations")


@query(
    "dq_job",
    uses=("feed_dup",),
    sql=f"""{DIMENSIONS_SQL} SELECT 'SUCCESS' AS status, quality_score, quality_passed, alert_triggered, recommendations
FROM (SELECT overall_score AS quality_score, * FROM ({REPORT_SQL}))""",
)
def dq_job(t: Tables):
    from creditlens.session import run_folder

    path = f"{run_folder(t.spark, 'quality')}/feed.parquet"
    t.feed_dup.write.parquet(path)
    outcome = ops.quality_job(t.spark, path, AS_OF)
    row = (
        outcome["status"],
        round(outcome["quality_score"], 6),
        outcome["quality_passed"],
        outcome["alert_triggered"],
        " | ".join(outcome["recommendations"]),
    )
    return t.spark.createDataFrame(
        [row],
        "status string, quality_score double, quality_passed boolean, alert_triggered boolean, recommendations string",
    )


@query(
    "final_validation",
    uses=("feed_dup",),
    sql=f""", w AS (SELECT count(*)::DOUBLE AS rows, {WIDTH}::DOUBLE AS columns, {WIDTH - len(TEXTS)}::DOUBLE AS numeric_columns, {len(TEXTS)}::DOUBLE AS categorical_columns,
  ({MISSING_SUM})::DOUBLE AS missing_values, (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM feed_dup)))::DOUBLE AS duplicate_rows,
  0.0::DOUBLE AS infinite_values, round(avg(loan_status), 6)::DOUBLE AS default_rate, round(1 - avg(loan_status), 6)::DOUBLE AS non_default_rate,
  round(count(*) FILTER (WHERE loan_status = 0)::DOUBLE / count(*) FILTER (WHERE loan_status = 1), 6) AS class_imbalance_ratio FROM feed_dup)
SELECT metric, value FROM (UNPIVOT w ON COLUMNS(*) INTO NAME metric VALUE value)""",
)
def final_validation(t: Tables):
    return rounded(ops.final_validation(t.feed_dup), "value")
