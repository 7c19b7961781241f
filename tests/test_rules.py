"""Scores, decisions, bands and validation on literal and boundary rows."""

import pytest
from pyspark.sql import functions as F

from creditlens.functions import bands, scoring
from creditlens.functions.validation import required_errors, scoring_errors, type_errors
from creditlens.operators.decisions import decide, score, score_with_errors, with_final_status
from creditlens.operators.features import scoring_features
from literal_rows import COLUMNS, EXPECTED, ROWS


@pytest.fixture(scope="module")
def literal(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def test_rule_score_and_decision(literal):
    for row in decide(score(literal)).collect():
        value, decision, rule = EXPECTED[row["application_id"]]
        assert row["risk_score"] == pytest.approx(value, abs=1e-9)
        assert (row["decision"], row["rule_fired"]) == (decision, rule)


@pytest.mark.parametrize("risk, decision", [(0.2, "AUTO_APPROVE"), (0.5, "MANUAL_REVIEW"), (0.8, "AUTO_REJECT")])
def test_given_score_decides(literal, risk, decision):
    row = decide(literal.where("application_id = 1").withColumn("risk_score", F.lit(risk))).first()
    assert row["decision"] == decision


def decided(spark, risk, **changes):
    values = dict(zip([c.split()[0] for c in COLUMNS.split(", ")], ROWS[0])) | changes
    frame = spark.createDataFrame([tuple(values.values())], COLUMNS).withColumn("risk_score", F.lit(risk))
    return decide(frame).first()


# Boundaries: what equals a threshold does not pass it, except 0.7 which is still reviewed.
@pytest.mark.parametrize(
    "risk, changes, decision, rule",
    [
        (0.3, {}, "MANUAL_REVIEW", None),
        (0.7, {}, "MANUAL_REVIEW", None),
        (0.0, {}, "AUTO_APPROVE", None),
        (1.0, {}, "AUTO_REJECT", None),
        (0.75, {"person_income": 150000.0}, "AUTO_REJECT", None),
        (0.75, {"person_income": 150000.01}, "MANUAL_REVIEW", "R1a"),
        (0.8, {"person_income": 200000.0}, "AUTO_REJECT", None),
        (0.4, {"person_income": 200000.0}, "AUTO_APPROVE", "R1b"),
        (0.5, {"person_income": 200000.0}, "MANUAL_REVIEW", None),
        (0.75, {"loan_amnt": 4999.99}, "MANUAL_REVIEW", "R2"),
        (0.75, {"loan_amnt": 5000.0}, "AUTO_REJECT", None),
        (0.26, {"loan_amnt": 100000.01}, "MANUAL_REVIEW", "R3a"),
        (0.25, {"loan_amnt": 100000.01}, "AUTO_APPROVE", None),
        (0.65, {"loan_amnt": 100000.01}, "AUTO_REJECT", "R3b"),
        (0.65, {"loan_amnt": 100000.0}, "MANUAL_REVIEW", None),
        (0.35, {"person_emp_length": 10.5}, "AUTO_APPROVE", "R4"),
        (0.35, {"person_emp_length": None}, "MANUAL_REVIEW", None),
        (0.1, {"cb_person_default_on_file": "Y"}, "MANUAL_REVIEW", "R5a"),
        (0.61, {"cb_person_default_on_file": "Y"}, "AUTO_REJECT", "R5b"),
        (0.6, {"cb_person_default_on_file": "Y"}, "MANUAL_REVIEW", None),
        (0.1, {"cb_person_cred_hist_length": 0}, "MANUAL_REVIEW", "R6"),
        (0.1, {"cb_person_cred_hist_length": None}, "MANUAL_REVIEW", "R6"),
        (0.1, {"loan_percent_income": 0.41}, "MANUAL_REVIEW", "R7a"),
        (0.1, {"loan_percent_income": 0.4}, "AUTO_APPROVE", None),
        (0.55, {"loan_percent_income": 0.41}, "AUTO_REJECT", "R7b"),
        (0.65, {"loan_amnt": 200000.0, "cb_person_default_on_file": "Y"}, "AUTO_REJECT", "R3b"),
        (None, {}, "MANUAL_REVIEW", None),
    ],
)
def test_override_rules(spark, risk, changes, decision, rule):
    row = decided(spark, risk, **changes)
    assert (row["decision"], row["rule_fired"]) == (decision, rule)


def test_reason_and_level_stay_on_the_score(spark):
    row = decided(spark, 0.4, person_income=200000.0)
    assert row["decision"] == "AUTO_APPROVE" and row["approval_probability"] == 0.95
    assert row["risk_level"] == "MEDIUM"
    assert row["decision_reason"] == "Medium risk score (0.400) requires manual underwriting review"


def test_summaries(literal):
    row = with_final_status(decide(score(literal))).where("application_id = 8").first()
    assert row["decision_summary"] == "Applicant 8 - MANUAL REVIEW: Medium risk (0.600), Income: $150,000, Loan: $100,000"
    assert row["processing_summary"] == "Application 8: Decision=MANUAL_REVIEW, Risk=0.600, Status=PENDING_REVIEW"


def test_model_score_is_clamped_and_missing_falls_back(spark, literal):
    frame = literal.where("application_id <= 3").withColumn(
        "m", F.when(F.col("application_id") == 1, F.lit(1.5)).when(F.col("application_id") == 2, F.lit(-0.5))
    )
    scores = {r["application_id"]: r["risk_score"] for r in score(frame, "m").collect()}
    assert scores == {1: 1.0, 2: 0.0, 3: 1.0}


def column(spark, values, kind, function):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in frame.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


def test_age_groups(spark):
    ages = [None, -1.0, 0.0, 17.0, 25.0, 25.5, 26.0, 35.0, 45.0, 46.0, 100.0, 101.0]
    opened = column(spark, ages, "double", bands.age_group_open)
    closed = column(spark, ages, "double", bands.age_group_closed)
    assert opened == ["Senior"] + ["Young"] * 4 + ["Adult"] * 3 + ["Middle"] + ["Senior"] * 3
    assert closed == [None, None, None, "Young", "Young", "Adult", "Adult", "Adult", "Middle", "Senior", "Senior", None]


def test_levels_differ_at_the_boundary(spark):
    risks = [0.0, 0.3, 0.7, 0.71, 1.0]
    assert column(spark, risks, "double", scoring.risk_level) == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]
    assert column(spark, risks, "double", scoring.risk_level_inference) == ["LOW", "MEDIUM", "HIGH", "HIGH", "HIGH"]


def test_income_bands(spark):
    incomes = [0.0, 25000.0, 25000.01, 75000.0, 1000000.0, 1000000.01, None]
    assert column(spark, incomes, "double", bands.income_band) == [None, "Low", "Medium", "High", "VeryHigh", None, None]


def test_division_by_nothing_is_null(spark, literal):
    frame = literal.where("application_id = 1").withColumns({"person_age": F.lit(18), "loan_amnt": F.lit(0.0)})
    row = frame.select(
        bands.employment_stability().alias("a"),
        bands.employment_stability(True).alias("b"),
        bands.income_to_loan().alias("c"),
        bands.income_to_loan(True).alias("d"),
    ).first()
    assert tuple(row) == (None, 3.0, None, 50000.0)


def test_scoring_feature_row(literal):
    features = scoring_features(literal)
    assert len(features.columns) == 1 + 7 + 13 + 15
    row = features.where("application_id = 1").first()
    assert (row["loan_grade_encoded"], row["home_ownership_RENT"], row["age_group_18_25"]) == (6, 1, 1)


def test_validation(spark, literal):
    text = literal.select(*[F.col(c).cast("string").alias(c) for c in literal.columns])
    row = text.where("application_id = 1").select(
        F.size(required_errors()).alias("r"), F.size(type_errors()).alias("t"), F.size(scoring_errors()).alias("s")
    ).first()
    assert tuple(row) == (0, 0, 0)
    bad = text.where("application_id = 1").withColumns(
        {
            "person_age": F.lit("abc"),
            "person_income": F.lit("10000000.5"),
            "loan_amnt": F.lit("999"),
            "loan_grade": F.lit("Z"),
            "loan_int_rate": F.lit(None).cast("string"),
        }
    )
    found = bad.select(required_errors().alias("r"), type_errors().alias("t"), scoring_errors().alias("s")).first()
    assert found["r"] == ["Missing required field: loan_int_rate"]
    assert found["t"] == [
        "person_age must be a valid number",
        "person_income must be between 0 and 10,000,000",
        "loan_amnt must be between 1,000 and 500,000",
        "loan_int_rate must be a valid number",
        "loan_grade must be one of: ['A', 'B', 'C', 'D', 'E', 'F', 'G']",
    ]
    assert found["s"] == [
        "Missing required field: loan_int_rate",
        "Field person_age must be numeric",
        "Field person_income out of range [0, 1000000]",
        "Field loan_grade has invalid value: Z",
    ]


def test_failing_records_do_not_stop_the_others(literal):
    mixed = literal.withColumn("person_age", F.when(F.col("application_id") == 2, 12).otherwise(F.col("person_age")))
    rows = {r["application_id"]: r for r in score_with_errors(mixed).collect()}
    assert rows[2]["risk_score"] is None and rows[2]["errors"]
    assert rows[1]["risk_score"] == pytest.approx(0.4) and not rows[1]["errors"]
