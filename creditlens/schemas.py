"""Table schemas and the fixed values the rules are stated in."""

from __future__ import annotations

# Domains of the loan application.
HOME_OWNERSHIP = ["RENT", "OWN", "MORTGAGE", "OTHER"]
LOAN_INTENTS = ["PERSONAL", "EDUCATION", "MEDICAL", "VENTURE", "HOMEIMPROVEMENT", "DEBTCONSOLIDATION"]
LOAN_GRADES = ["A", "B", "C", "D", "E", "F", "G"]
DEFAULT_FLAGS = ["Y", "N"]
STATUSES = ["PENDING", "PROCESSING", "APPROVED", "REJECTED", "MANUAL_REVIEW"]
RISK_CATEGORIES = ["LOW", "MEDIUM", "HIGH"]
DECISIONS = ["APPROVE", "REJECT", "MANUAL_REVIEW"]

NUMERIC_FEATURES = [
    "person_age",
    "person_income",
    "person_emp_length",
    "loan_amnt",
    "loan_int_rate",
    "loan_percent_income",
    "cb_person_cred_hist_length",
]
CATEGORICAL_FEATURES = ["person_home_ownership", "loan_intent", "loan_grade", "cb_person_default_on_file"]

REQUIRED_FIELDS = [
    "person_age",
    "person_income",
    "person_home_ownership",
    "person_emp_length",
    "loan_intent",
    "loan_grade",
    "loan_amnt",
    "loan_int_rate",
    "loan_percent_income",
    "cb_person_default_on_file",
    "cb_person_cred_hist_length",
]

# Order in which the scoring endpoint checks its fields.
SCORING_REQUIRED_FIELDS = [
    "person_age",
    "person_income",
    "person_emp_length",
    "loan_amnt",
    "loan_int_rate",
    "loan_percent_income",
    "cb_person_default_on_file",
    "cb_person_cred_hist_length",
    "person_home_ownership",
    "loan_intent",
    "loan_grade",
]


def _ddl(**fields: str) -> str:
    """A schema in the text form that readers and from_json take."""
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


#: The raw feed: features plus target, numbers as written in the file.
RAW_APPLICATION = _ddl(
    application_id="bigint",
    person_age="string",
    person_income="string",
    person_home_ownership="string",
    person_emp_length="string",
    loan_intent="string",
    loan_grade="string",
    loan_amnt="string",
    loan_int_rate="string",
    loan_percent_income="string",
    cb_person_default_on_file="string",
    cb_person_cred_hist_length="string",
    loan_status="int",
)

#: The typed feed, for CSV files whose only text marker is "?" in a number column.
APPLICATION = _ddl(
    application_id="bigint",
    person_age="int",
    person_income="double",
    person_home_ownership="string",
    person_emp_length="double",
    loan_intent="string",
    loan_grade="string",
    loan_amnt="double",
    loan_int_rate="double",
    loan_percent_income="double",
    cb_person_default_on_file="string",
    cb_person_cred_hist_length="int",
    loan_status="int",
)

#: Types the raw text columns are coerced to.
COERCIONS = {
    "person_age": "int",
    "person_income": "double",
    "person_emp_length": "double",
    "loan_amnt": "double",
    "loan_int_rate": "double",
    "loan_percent_income": "double",
    "cb_person_cred_hist_length": "int",
}

APPLICATIONS_TABLE = _ddl(
    application_id="string",
    person_age="int",
    person_income="decimal(12,2)",
    person_home_ownership="string",
    person_emp_length="decimal(5,2)",
    loan_intent="string",
    loan_grade="string",
    loan_amnt="decimal(12,2)",
    loan_int_rate="decimal(5,2)",
    loan_percent_income="decimal(5,4)",
    cb_person_default_on_file="string",
    cb_person_cred_hist_length="int",
    status="string",
    created_at="timestamp",
    updated_at="timestamp",
)

RISK_SCORES_TABLE = _ddl(
    risk_score_id="string",
    application_id="string",
    risk_score="decimal(5,4)",
    risk_category="string",
    model_version="string",
    confidence_score="decimal(5,4)",
    feature_importance="string",
    prediction_timestamp="timestamp",
    processing_time_ms="int",
    created_at="timestamp",
)

DECISIONS_TABLE = _ddl(
    decision_id="string",
    application_id="string",
    decision="string",
    decision_reason="string",
    risk_score="decimal(5,4)",
    underwriter_id="string",
    underwriter_notes="string",
    decision_timestamp="timestamp",
    created_at="timestamp",
)

AUDIT_LOGS_TABLE = _ddl(
    log_id="string",
    application_id="string",
    action="string",
    entity_type="string",
    entity_id="string",
    old_value="string",
    new_value="string",
    user_id="string",
    ip_address="string",
    user_agent="string",
    created_at="timestamp",
)

MODEL_PERFORMANCE_TABLE = _ddl(
    performance_id="string",
    model_version="string",
    metric_name="string",
    metric_value="decimal(10,6)",
    evaluation_date="date",
    dataset_size="int",
    created_at="timestamp",
)

PORTFOLIO_ANALYTICS_TABLE = _ddl(
    analytics_id="string",
    date="date",
    total_applications="int",
    approved_count="int",
    rejected_count="int",
    manual_review_count="int",
    total_loan_amount="decimal(15,2)",
    approved_loan_amount="decimal(15,2)",
    average_risk_score="decimal(5,4)",
    default_rate="decimal(5,4)",
    created_at="timestamp",
)

#: One message of the application flow; the payload travels as JSON text.
EVENT_ENVELOPE = _ddl(Source="string", DetailType="string", Detail="string", EventBusName="string")
