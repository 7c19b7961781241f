"""Queries: cleaning rules, imputation and the two cleaning jobs."""

from pyspark.sql import functions as F

from creditlens.operators import cleaning as ops
from creditlens.operators import quality
from creditlens.plans.fixtures import CLEAN_COLUMNS, Tables
from creditlens.plans.registry import query
from creditlens.plans.shape import rounded
from creditlens.schemas import NUMERIC_FEATURES

COLUMNS = ", ".join(CLEAN_COLUMNS)
AGE_GROUP_OPEN = """CASE WHEN person_age <= 25 THEN '18-25' WHEN person_age <= 35 THEN '26-35'
  WHEN person_age <= 45 THEN '36-45' ELSE '45+' END"""
AGE_GROUP_CLOSED = """CASE WHEN person_age > 0 AND person_age <= 25 THEN '18-25' WHEN person_age > 25 AND person_age <= 35 THEN '26-35'
  WHEN person_age > 35 AND person_age <= 45 THEN '36-45' WHEN person_age > 45 AND person_age <= 100 THEN '45+' END"""
FLOORED = """greatest(person_income, 0) AS person_income, greatest(loan_amnt, 0) AS loan_amnt"""


@query("clean_dedup", uses=("feed_dup",), sql=f"SELECT DISTINCT {COLUMNS} FROM feed_dup")
def clean_dedup(t: Tables):
    return ops.drop_duplicates(t.feed_dup)


@query(
    "clean_dedup_counts",
    uses=("feed_dup",),
    sql="""SELECT (SELECT count(*) FROM feed_dup) AS total_records, count(*) AS unique_records,
  (SELECT count(*) FROM feed_dup) - count(*) AS duplicate_records FROM (SELECT DISTINCT * FROM feed_dup)""",
)
def clean_dedup_counts(t: Tables):
    return ops.duplicate_counts(t.feed_dup)


@query(
    "clean_cap_const",
    uses=("feed",),
    sql="""SELECT application_id, CASE WHEN person_age > 100 THEN 100 ELSE person_age END AS person_age,
  CASE WHEN person_emp_length > 50 THEN 50 ELSE person_emp_length END AS person_emp_length FROM feed""",
)
def clean_cap_const(t: Tables):
    return ops.cap_constants(t.feed).select("application_id", "person_age", "person_emp_length")


@query(
    "clean_floor_zero",
    uses=("feed",),
    sql=f"SELECT application_id, {FLOORED} FROM feed",
)
def clean_floor_zero(t: Tables):
    return ops.floor_amounts(t.feed).select("application_id", "person_income", "loan_amnt")


@query(
    "clean_cap_p99",
    uses=("feed",),
    sql=f""", floored AS (SELECT application_id, {FLOORED} FROM feed),
limits AS (SELECT quantile_cont(person_income, 0.99) AS income, quantile_cont(loan_amnt, 0.99) AS loan FROM floored)
SELECT application_id, round(least(person_income, income), 6) AS person_income, round(least(loan_amnt, loan), 6) AS loan_amnt
FROM floored CROSS JOIN limits""",
)
def clean_cap_p99(t: Tables):
    capped = ops.cap_amounts(ops.floor_amounts(t.feed)).select("application_id", "person_income", "loan_amnt")
    return rounded(capped, "person_income", "loan_amnt")


@query(
    "clean_emp_123",
    uses=("feed",),
    sql="SELECT count(*) FILTER (WHERE person_emp_length::VARCHAR LIKE '%123%') AS emp_length_impossible FROM feed",
)
def clean_emp_123(t: Tables):
    return t.feed.agg(
        F.count_if(F.col("person_emp_length").cast("string").contains("123")).alias("emp_length_impossible")
    )


@query(
    "impute_rate_by_grade",
    uses=("feed",),
    sql="""SELECT application_id, loan_grade, coalesce(loan_int_rate, m) AS loan_int_rate FROM feed
LEFT JOIN (SELECT loan_grade, median(loan_int_rate) AS m FROM feed GROUP BY loan_grade) USING (loan_grade)""",
)
def impute_rate_by_grade(t: Tables):
    return ops.impute_rate_by_grade(t.feed).select("application_id", "loan_grade", "loan_int_rate")


@query(
    "impute_emp_by_age",
    uses=("feed",),
    sql=f""", grouped AS (SELECT *, {AGE_GROUP_OPEN} AS g FROM feed)
SELECT application_id, person_age, coalesce(person_emp_length, m) AS person_emp_length FROM grouped
LEFT JOIN (SELECT g, median(person_emp_length) AS m FROM grouped GROUP BY g) USING (g)""",
)
def impute_emp_by_age(t: Tables):
    return ops.impute_employment_by_age(t.feed).select("application_id", "person_age", "person_emp_length")


STRATIFIED = """quartiles AS (SELECT quantile_cont(person_income, 0.25) AS q1, quantile_cont(person_income, 0.5) AS q2,
  quantile_cont(person_income, 0.75) AS q3 FROM {source}),
banded AS (SELECT s.*, CASE WHEN person_income <= q1 THEN 'Q1' WHEN person_income <= q2 THEN 'Q2'
  WHEN person_income <= q3 THEN 'Q3' WHEN person_income > q3 THEN 'Q4' END AS quartile FROM {source} s CROSS JOIN quartiles),
grouped AS (SELECT b.* REPLACE (coalesce(b.loan_int_rate, m.rate) AS loan_int_rate) FROM banded b LEFT JOIN
  (SELECT loan_grade, quartile, median(loan_int_rate) AS rate FROM banded GROUP BY loan_grade, quartile) m
  ON b.loan_grade = m.loan_grade AND b.quartile = m.quartile),
rated AS (SELECT * REPLACE (coalesce(loan_int_rate, (SELECT median(loan_int_rate) FROM grouped)) AS loan_int_rate) FROM grouped)"""


@query(
    "impute_rate_stratified",
    uses=("feed",),
    sql=", " + STRATIFIED.format(source="feed") + " SELECT application_id, loan_grade, loan_int_rate FROM rated",
)
def impute_rate_stratified(t: Tables):
    return ops.impute_rate_stratified(t.feed).select("application_id", "loan_grade", "loan_int_rate")


@query(
    "impute_all_median",
    uses=("feed",),
    sql="SELECT application_id, "
    + ", ".join(
        f"round(coalesce({c}, (SELECT median({c}) FROM feed))::DOUBLE, 6) AS {c}" for c in NUMERIC_FEATURES
    )
    + " FROM feed",
)
def impute_all_median(t: Tables):
    filled = ops.impute_all_median(t.feed).select("application_id", *NUMERIC_FEATURES)
    return rounded(filled, *NUMERIC_FEATURES)


REST = """person_home_ownership, loan_intent, loan_grade, loan_percent_income, cb_person_default_on_file,
  cb_person_cred_hist_length, loan_status"""

CLEAN_JOB_TABLES = f""", distinct_feed AS (SELECT DISTINCT * FROM feed_dup),
base AS (SELECT application_id, {REST}, least(person_age, 100) AS person_age, {FLOORED}, loan_int_rate,
  CASE WHEN person_emp_length > 50 THEN 50 ELSE person_emp_length END AS person_emp_length FROM distinct_feed),
limits AS (SELECT quantile_cont(person_income, 0.99) AS income, quantile_cont(loan_amnt, 0.99) AS loan FROM base),
capped AS (SELECT * REPLACE (least(person_income, income) AS person_income, least(loan_amnt, loan) AS loan_amnt),
  {AGE_GROUP_OPEN} AS g FROM base CROSS JOIN limits),
rates AS (SELECT loan_grade, median(loan_int_rate) AS rate FROM capped GROUP BY loan_grade),
years AS (SELECT g, median(person_emp_length) AS emp FROM capped GROUP BY g)"""
CLEAN_JOB_RESULT = f"""SELECT application_id, {REST}, person_age, round(person_income, 6) AS person_income, round(loan_amnt, 6) AS loan_amnt,
  coalesce(loan_int_rate, rate) AS loan_int_rate, coalesce(person_emp_length, emp) AS person_emp_length
FROM capped LEFT JOIN rates USING (loan_grade) LEFT JOIN years USING (g)"""
CLEAN_JOB_SQL = f"{CLEAN_JOB_TABLES} {CLEAN_JOB_RESULT}"


@query("clean_job", uses=("feed_dup",), sql=CLEAN_JOB_SQL)
def clean_job(t: Tables):
    return rounded(ops.clean_job(t.feed_dup), "person_income", "loan_amnt")


CLEAN_SCRIPT_SQL = f""", distinct_feed AS (SELECT DISTINCT * FROM feed_dup),
base AS (SELECT application_id, {REST}, least(person_age, 100) AS person_age, {FLOORED}, loan_int_rate, person_emp_length FROM distinct_feed),
limits AS (SELECT quantile_cont(person_income, 0.99) AS income, quantile_cont(loan_amnt, 0.99) AS loan FROM base),
capped AS (SELECT * EXCLUDE (income, loan) REPLACE (least(person_income, income) AS person_income, least(loan_amnt, loan) AS loan_amnt)
  FROM base CROSS JOIN limits),
{STRATIFIED.format(source="capped")},
aged AS (SELECT *, {AGE_GROUP_CLOSED} AS g FROM rated),
years AS (SELECT g, median(person_emp_length) AS emp FROM aged GROUP BY g),
employed AS (SELECT * REPLACE (coalesce(person_emp_length, emp) AS person_emp_length) FROM aged LEFT JOIN years USING (g)),
filled AS (SELECT * REPLACE (coalesce(person_emp_length, (SELECT median(person_emp_length) FROM employed)) AS person_emp_length) FROM employed)
SELECT application_id, {REST}, person_age, round(person_income, 6) AS person_income, round(loan_amnt, 6) AS loan_amnt,
  loan_int_rate, least(person_emp_length, 50) AS person_emp_length FROM filled"""


@query("clean_script", uses=("feed_dup",), sql=CLEAN_SCRIPT_SQL)
def clean_script(t: Tables):
    return rounded(ops.clean_script(t.feed_dup), "person_income", "loan_amnt")


STATS_SQL = f""", distinct_feed AS (SELECT DISTINCT * FROM feed_dup), floored AS (SELECT {FLOORED} FROM distinct_feed),
limits AS (SELECT quantile_cont(person_income, 0.99) AS income, quantile_cont(loan_amnt, 0.99) AS loan FROM floored),
wide AS (SELECT count(*) AS rows_after_dedup, count(*) FILTER (WHERE person_age > 100) AS age_capped,
  count(*) FILTER (WHERE person_income < 0) AS negative_income_fixed, count(*) FILTER (WHERE person_income > income) AS income_capped,
  count(*) FILTER (WHERE loan_amnt < 0) AS negative_loans_fixed, count(*) FILTER (WHERE loan_amnt > loan) AS loan_capped,
  count(*) FILTER (WHERE person_emp_length > 50) AS employment_capped,
  count(*) FILTER (WHERE person_emp_length::VARCHAR LIKE '%123%') AS emp_length_impossible,
  count(*) FILTER (WHERE loan_int_rate IS NULL) AS interest_rates_missing,
  count(*) FILTER (WHERE person_emp_length IS NULL) AS employment_missing,
  (SELECT count(*) FROM feed_dup) - count(*) AS duplicates_removed FROM distinct_feed CROSS JOIN limits)
SELECT rule, rows FROM (UNPIVOT wide ON COLUMNS(*) INTO NAME rule VALUE rows)"""


@query("clean_stats", uses=("feed_dup",), sql=STATS_SQL)
def clean_stats(t: Tables):
    return ops.clean_stats(t.feed_dup)


@query(
    "cleaning_score",
    uses=("feed_dup",),
    sql=""", c AS (SELECT (SELECT count(*) FROM feed_dup) - (SELECT count(*) FROM (SELECT DISTINCT * FROM feed_dup)) AS duplicates,
  (SELECT count(*) FILTER (WHERE loan_int_rate IS NULL) + count(*) FILTER (WHERE person_emp_length IS NULL) FROM feed_dup) AS missing)
SELECT duplicates, missing, 0::BIGINT AS infinite, 100 - CASE WHEN duplicates > 0 THEN 5 ELSE 0 END - CASE WHEN missing > 0 THEN 10 ELSE 0 END AS score FROM c""",
)
def cleaning_score(t: Tables):
    checked = quality.final_validation(t.feed_dup)

    def value(metric: str):
        return F.max(F.when(F.col("metric") == metric, F.col("value"))).cast("bigint")

    return checked.agg(
        value("duplicate_rows").alias("duplicates"),
        value("missing_values").alias("missing"),
        value("infinite_values").alias("infinite"),
    ).withColumn("score", quality.cleaning_score(F.col("duplicates"), F.col("missing"), F.col("infinite")))
