"""Queries: validation, selection, constraints and defaults."""

from pyspark.sql import functions as F

from creditlens.functions.validation import required_errors, scoring_errors, type_errors
from creditlens.operators import cleaning, tables
from creditlens.plans.fixtures import AS_OF, SNAPSHOT_COLUMNS, Tables
from creditlens.plans.registry import query
from creditlens.plans.shape import joined
from creditlens.schemas import NUMERIC_FEATURES, REQUIRED_FIELDS, SCORING_REQUIRED_FIELDS
from creditlens.streaming import flow

HOMES = "''RENT'', ''OWN'', ''MORTGAGE'', ''OTHER''"
INTENTS = "''PERSONAL'', ''EDUCATION'', ''MEDICAL'', ''VENTURE'', ''HOMEIMPROVEMENT'', ''DEBTCONSOLIDATION''"
GRADES = "''A'', ''B'', ''C'', ''D'', ''E'', ''F'', ''G''"


def number_sql(name: str) -> str:
    return f"TRY_CAST({name} AS DOUBLE)"


def _required_sql(fields) -> str:
    parts = ", ".join(f"CASE WHEN {f} IS NULL THEN 'Missing required field: {f}' END" for f in fields)
    return f"concat_ws(' | ', {parts})"


def _range_sql(name, low, high, shown) -> str:
    return (
        f"CASE WHEN {number_sql(name)} IS NULL THEN '{name} must be a valid number' "
        f"WHEN {number_sql(name)} < {low} OR {number_sql(name)} > {high} THEN '{name} must be between {shown}' END"
    )


def _member_sql(name, values) -> str:
    plain = values.replace("''", "'")
    return f"CASE WHEN {name} IS NULL OR {name} NOT IN ({plain}) THEN '{name} must be one of: [{values}]' END"


TYPES_SQL = "concat_ws(' | ', " + ", ".join(
    [
        _range_sql("person_age", 18, 100, "18 and 100"),
        _range_sql("person_income", 0, 10000000, "0 and 10,000,000"),
        _range_sql("loan_amnt", 1000, 500000, "1,000 and 500,000"),
        _range_sql("loan_int_rate", 0, 50, "0 and 50"),
        _range_sql("person_emp_length", 0, 50, "0 and 50"),
        _member_sql("person_home_ownership", HOMES),
        _member_sql("loan_intent", INTENTS),
        _member_sql("loan_grade", GRADES),
    ]
) + ")"


@query(
    "validate_required",
    uses=("raw",),
    sql=f"SELECT application_id, {_required_sql(REQUIRED_FIELDS)} AS errors FROM raw",
)
def validate_required(t: Tables):
    return joined(t.raw.select("application_id", required_errors().alias("errors")), "errors")


@query("validate_types", uses=("raw",), sql=f"SELECT application_id, {TYPES_SQL} AS errors FROM raw")
def validate_types(t: Tables):
    return joined(t.raw.select("application_id", type_errors().alias("errors")), "errors")


def _scoring_sql() -> str:
    checks = [f"CASE WHEN {f} IS NULL THEN 'Missing required field: {f}' END" for f in SCORING_REQUIRED_FIELDS]
    for name, low, high in [
        ("person_age", 18, 100),
        ("person_income", 0, 1000000),
        ("loan_amnt", 0, 1000000),
        ("loan_int_rate", 0, 50),
        ("person_emp_length", 0, 50),
    ]:
        checks.append(
            f"CASE WHEN {name} IS NOT NULL AND {number_sql(name)} IS NULL THEN 'Field {name} must be numeric' "
            f"WHEN {number_sql(name)} NOT BETWEEN {low} AND {high} THEN 'Field {name} out of range [{low}, {high}]' END"
        )
    for name, values in [
        ("person_home_ownership", HOMES),
        ("loan_intent", INTENTS),
        ("loan_grade", GRADES),
        ("cb_person_default_on_file", "''Y'', ''N''"),
    ]:
        plain = values.replace("''", "'")
        checks.append(f"CASE WHEN {name} NOT IN ({plain}) THEN 'Field {name} has invalid value: ' || {name} END")
    return "concat_ws(' | ', " + ", ".join(checks) + ")"


@query("validate_scoring", uses=("raw",), sql=f"SELECT application_id, {_scoring_sql()} AS errors FROM raw")
def validate_scoring(t: Tables):
    return joined(t.raw.select("application_id", scoring_errors().alias("errors")), "errors")


SPLIT_SQL = f"""SELECT application_id,
  CASE WHEN required <> '' THEN 'required' WHEN types <> '' THEN 'types' ELSE 'accepted' END AS outcome,
  CASE WHEN required <> '' THEN required ELSE types END AS errors
FROM (SELECT application_id, {_required_sql(REQUIRED_FIELDS)} AS required, {TYPES_SQL} AS types FROM raw)"""


@query("validate_split", uses=("raw",), sql=SPLIT_SQL)
def validate_split(t: Tables):
    checked = flow.validate(t.raw)
    shown = checked.select(
        "application_id", F.coalesce("failed_phase", F.lit("accepted")).alias("outcome"), "errors"
    )
    return joined(shown, "errors")


@query(
    "coerce_numeric",
    uses=("raw",),
    sql="SELECT application_id, "
    + ", ".join(
        f"CAST(TRY_CAST({c} AS DOUBLE) AS {'INTEGER' if c in ('person_age', 'cb_person_cred_hist_length') else 'DOUBLE'}) AS {c}"
        for c in NUMERIC_FEATURES
    )
    + " FROM raw",
)
def coerce_numeric(t: Tables):
    return cleaning.coerce_numeric(t.raw).select("application_id", *NUMERIC_FEATURES)


APP_COLUMNS = ", ".join(SNAPSHOT_COLUMNS) + ", created_at"


def _shown(df):
    return df.select(*SNAPSHOT_COLUMNS, "created_at")


@query(
    "apps_by_status",
    uses=("applications",),
    sql=f"SELECT {APP_COLUMNS} FROM applications WHERE status = 'APPROVED' ORDER BY created_at DESC, application_id LIMIT 100",
)
def apps_by_status(t: Tables):
    return tables.newest(_shown(t.applications.where(F.col("status") == "APPROVED")), "created_at", "application_id", 100)


@query(
    "apps_pending",
    uses=("applications",),
    sql=f"""SELECT {APP_COLUMNS} FROM applications WHERE status IN ('PENDING', 'PROCESSING')
ORDER BY created_at, application_id LIMIT 50""",
)
def apps_pending(t: Tables):
    waiting = t.applications.where(F.col("status").isin("PENDING", "PROCESSING"))
    return tables.newest(_shown(waiting), "created_at", "application_id", 50, ascending=True)


@query(
    "apps_date_range",
    uses=("applications",),
    sql=f"""SELECT {APP_COLUMNS} FROM applications
WHERE created_at BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31' ORDER BY created_at DESC, application_id""",
)
def apps_date_range(t: Tables):
    from creditlens.operators.portfolio import between

    return tables.newest(
        _shown(between(t.applications, "created_at", "1997-01-01", "1998-12-31")), "created_at", "application_id"
    )


@query(
    "app_by_id",
    uses=("applications",),
    sql="SELECT application_id, status, person_age, person_income, loan_amnt, loan_grade FROM applications WHERE application_id = 42",
)
def app_by_id(t: Tables):
    # The cached form of the row carries the cache's own names.
    cached = t.applications.where(F.col("application_id") == 42).select(
        F.col("application_id").alias("applicationId"),
        "status",
        F.col("person_age").alias("personAge"),
        F.col("person_income").alias("personIncome"),
        F.col("loan_amnt").alias("loanAmount"),
        F.col("loan_grade").alias("loanGrade"),
    )
    return tables.from_cache_names(cached)


CONSTRAINTS = (
    [(f"{c}_not_null", f"{c} IS NULL") for c in REQUIRED_FIELDS]
    + [
        ("person_age_check", "NOT (person_age BETWEEN 18 AND 100)"),
        ("person_income_check", "NOT (person_income >= 0)"),
        ("person_home_ownership_check", "person_home_ownership NOT IN ('RENT','OWN','MORTGAGE','OTHER')"),
        ("person_emp_length_check", "NOT (person_emp_length BETWEEN 0 AND 50)"),
        (
            "loan_intent_check",
            "loan_intent NOT IN ('PERSONAL','EDUCATION','MEDICAL','VENTURE','HOMEIMPROVEMENT','DEBTCONSOLIDATION')",
        ),
        ("loan_grade_check", "loan_grade NOT IN ('A','B','C','D','E','F','G')"),
        ("loan_amnt_check", "NOT (loan_amnt >= 0)"),
        ("loan_int_rate_check", "NOT (loan_int_rate BETWEEN 0 AND 50)"),
        ("loan_percent_income_check", "NOT (loan_percent_income BETWEEN 0 AND 1)"),
        ("cb_person_default_on_file_check", "cb_person_default_on_file NOT IN ('Y','N')"),
        ("cb_person_cred_hist_length_check", "NOT (cb_person_cred_hist_length >= 0)"),
        ("status_check", "status NOT IN ('PENDING','PROCESSING','APPROVED','REJECTED','MANUAL_REVIEW')"),
    ]
)
CONSTRAINT_SQL = "SELECT * FROM (SELECT application_id, unnest([" + ", ".join(
    f"CASE WHEN {rule} THEN '{name}' END" for name, rule in CONSTRAINTS
) + "]) AS constraint_name FROM applications) WHERE constraint_name IS NOT NULL"


@query("constraint_violations", uses=("applications",), sql=CONSTRAINT_SQL)
def constraint_violations(t: Tables):
    return tables.application_violations(t.applications)


@query(
    "constraint_counts",
    uses=("applications", "risk_scores", "decisions"),
    sql=f"""SELECT table_name, constraint_name, count(*) AS violations FROM (
  SELECT 'applications' AS table_name, constraint_name FROM ({CONSTRAINT_SQL})
  UNION ALL SELECT 'risk_scores', 'risk_score_check' FROM risk_scores WHERE NOT (risk_score BETWEEN 0 AND 1)
  UNION ALL SELECT 'risk_scores', 'risk_category_check' FROM risk_scores WHERE risk_category NOT IN ('LOW','MEDIUM','HIGH')
  UNION ALL SELECT 'risk_scores', 'confidence_score_check' FROM risk_scores WHERE NOT (confidence_score BETWEEN 0 AND 1)
  UNION ALL SELECT 'decisions', 'decision_check' FROM decisions WHERE decision NOT IN ('APPROVE','REJECT','MANUAL_REVIEW'))
GROUP BY ALL""",
)
def constraint_counts(t: Tables):
    found = [
        ("applications", tables.application_violations(t.applications)),
        ("risk_scores", tables.score_violations(t.risk_scores)),
        ("decisions", tables.decision_violations(t.decisions)),
    ]
    named = [df.select(F.lit(name).alias("table_name"), "constraint_name") for name, df in found]
    return (
        tables.union_frames(named).groupBy("table_name", "constraint_name").agg(F.count(F.lit(1)).alias("violations"))
    )


@query(
    "apply_defaults",
    uses=("applications",),
    sql=f"""SELECT application_id, coalesce(CASE WHEN status <> 'PROCESSING' THEN status END, 'PENDING') AS status,
  CASE WHEN status = 'PENDING' THEN TIMESTAMP '{AS_OF}' ELSE created_at END AS created_at, TIMESTAMP '{AS_OF}' AS updated_at
FROM applications""",
)
def apply_defaults(t: Tables):
    # Applications in processing come without a status here, pending ones without a time.
    given = t.applications.select(
        "application_id",
        F.when(F.col("status") != "PROCESSING", F.col("status")).alias("status"),
        F.when(F.col("status") != "PENDING", F.col("created_at")).alias("created_at"),
    )
    return tables.apply_defaults(given, AS_OF)


ALIGNED = ["person_age", "loan_int_rate", "not_in_the_data", "person_emp_length", "loan_amnt"]


@query(
    "align_features",
    uses=("apps",),
    sql="""SELECT application_id, coalesce(person_age, 0)::DOUBLE AS person_age, coalesce(loan_int_rate, 0) AS loan_int_rate,
  0::DOUBLE AS not_in_the_data, coalesce(person_emp_length, 0) AS person_emp_length, coalesce(loan_amnt, 0) AS loan_amnt FROM apps""",
)
def align_features(t: Tables):
    return tables.align_features(t.apps, ALIGNED, keep=["application_id"])


@query(
    "union_frames",
    uses=("apps",),
    sql="""SELECT application_id, person_age, loan_amnt, NULL::DOUBLE AS model_score FROM apps WHERE intake = 'F'
UNION ALL SELECT application_id, person_age, NULL, model_score FROM apps WHERE intake <> 'F'""",
)
def union_frames(t: Tables):
    closed = t.apps.where(F.col("intake") == "F").select("application_id", "person_age", "loan_amnt")
    rest = t.apps.where(F.col("intake") != "F").select("application_id", "person_age", "model_score")
    return tables.union_frames([closed, rest])
