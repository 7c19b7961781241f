"""SQL form of the derived tables, for the checks."""

from __future__ import annotations

AS_OF = "2001-08-02"

FEATURE_LIST = """person_age, person_income, person_home_ownership, person_emp_length, loan_intent,
  loan_grade, loan_amnt, loan_int_rate, loan_percent_income, cb_person_default_on_file,
  cb_person_cred_hist_length"""

RULE_SCORE = """least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.5::DOUBLE
  + CASE WHEN cb_person_default_on_file = 'Y' THEN 0.3::DOUBLE ELSE 0 END
  + CASE WHEN loan_percent_income > 0.3::DOUBLE THEN 0.2::DOUBLE ELSE 0 END
  + CASE WHEN cb_person_cred_hist_length < 2 THEN 0.15::DOUBLE ELSE 0 END
  + CASE WHEN person_emp_length < 2 THEN 0.1::DOUBLE ELSE 0 END
  + CASE WHEN person_income < 30000 THEN 0.1::DOUBLE ELSE 0 END
  + CASE loan_grade WHEN 'A' THEN -0.2::DOUBLE WHEN 'B' THEN -0.1::DOUBLE WHEN 'C' THEN 0.0::DOUBLE
      WHEN 'D' THEN 0.1::DOUBLE WHEN 'E' THEN 0.2::DOUBLE WHEN 'F' THEN 0.3::DOUBLE
      WHEN 'G' THEN 0.4::DOUBLE ELSE 0.1::DOUBLE END))"""

RISK_LEVEL = "CASE WHEN {0} < 0.3::DOUBLE THEN 'LOW' WHEN {0} <= 0.7::DOUBLE THEN 'MEDIUM' ELSE 'HIGH' END"

CACHE_KEY = """'risk_' || substr(md5(concat_ws('_',
  coalesce(person_age::VARCHAR, ''), coalesce(person_income::DECIMAL(12,2)::VARCHAR, ''),
  coalesce(person_home_ownership, ''), coalesce(person_emp_length::DECIMAL(12,2)::VARCHAR, ''),
  coalesce(loan_intent, ''), coalesce(loan_grade, ''), coalesce(loan_amnt::DECIMAL(12,2)::VARCHAR, ''))), 1, 16)"""

TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "apps": (
        (),
        """SELECT o_orderkey AS application_id,
  CAST(15 + o_custkey % 90 AS INTEGER) AS person_age,
  floor(c_acctbal * 20) AS person_income,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'OWN' WHEN 'MACHINERY' THEN 'MORTGAGE'
    WHEN 'HOUSEHOLD' THEN 'OTHER' ELSE 'RENT' END AS person_home_ownership,
  CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderkey % 60 AS DOUBLE) END AS person_emp_length,
  ['PERSONAL','EDUCATION','MEDICAL','VENTURE','HOMEIMPROVEMENT','DEBTCONSOLIDATION'][o_orderkey % 6 + 1] AS loan_intent,
  substr('ABCDEFG', CAST(o_orderkey % 7 + 1 AS INTEGER), 1) AS loan_grade,
  CASE WHEN o_orderkey % 97 = 0 THEN -floor(o_totalprice / 4) ELSE floor(o_totalprice / 4) END AS loan_amnt,
  CASE WHEN o_orderkey % 11 <> 0 THEN 5.0::DOUBLE + (o_orderkey % 180)::DOUBLE / 10.0::DOUBLE END AS loan_int_rate,
  (o_orderkey % 110)::DOUBLE / 100.0::DOUBLE AS loan_percent_income,
  CASE WHEN o_custkey % 7 = 0 THEN 'Y' ELSE 'N' END AS cb_person_default_on_file,
  CAST(o_custkey % 30 AS INTEGER) AS cb_person_cred_hist_length,
  CASE WHEN (o_orderkey % 110) * 2 + o_orderkey % 180 + (o_orderkey * 17 + o_custkey * 31) % 60 > 230 THEN 1 ELSE 0 END AS loan_status,
  o_orderdate AS created_at,
  CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey * 37 % 1000)::DOUBLE / 1000.0::DOUBLE END AS model_score,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'UW-' || (o_orderkey % 12)::VARCHAR END AS underwriter_id,
  o_orderstatus AS intake, o_orderpriority AS priority
FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "feed": (("apps",), f"SELECT application_id, {FEATURE_LIST}, loan_status FROM apps"),
    "feed_dup": (
        ("apps", "feed"),
        f"""SELECT * FROM feed UNION ALL SELECT application_id, {FEATURE_LIST}, loan_status FROM apps
WHERE loan_grade = 'A' AND priority = '1-URGENT'""",
    ),
    "raw": (
        ("apps",),
        """SELECT application_id,
  CASE WHEN application_id % 101 = 0 THEN 'abc' ELSE person_age::VARCHAR END AS person_age,
  CASE WHEN application_id % 107 <> 0 THEN person_income::DECIMAL(12,2)::VARCHAR END AS person_income,
  person_home_ownership, person_emp_length::DECIMAL(12,2)::VARCHAR AS person_emp_length, loan_intent,
  CASE WHEN application_id % 103 = 0 THEN 'Z' ELSE loan_grade END AS loan_grade,
  loan_amnt::DECIMAL(12,2)::VARCHAR AS loan_amnt,
  coalesce(loan_int_rate::DECIMAL(12,2)::VARCHAR, '?') AS loan_int_rate,
  loan_percent_income::DECIMAL(12,2)::VARCHAR AS loan_percent_income, cb_person_default_on_file,
  cb_person_cred_hist_length::VARCHAR AS cb_person_cred_hist_length, loan_status FROM apps""",
    ),
    "scored": (
        ("apps",),
        f"""SELECT *, CASE risk_score < 0.3::DOUBLE WHEN true THEN 'AUTO_APPROVE' ELSE
    CASE WHEN risk_score <= 0.7::DOUBLE THEN 'MANUAL_REVIEW' ELSE 'AUTO_REJECT' END END AS base,
  {RISK_LEVEL.format('risk_score')} AS risk_level
FROM (SELECT *, {RULE_SCORE} AS rule_score,
  CASE WHEN model_score IS NOT NULL THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, model_score)) ELSE {RULE_SCORE} END AS risk_score FROM apps)""",
    ),
    "decided": (
        ("scored",),
        """SELECT *, CASE WHEN fired IS NULL THEN base
    WHEN fired IN ('R1b', 'R4') THEN 'AUTO_APPROVE'
    WHEN fired IN ('R3b', 'R5b', 'R7b') THEN 'AUTO_REJECT' ELSE 'MANUAL_REVIEW' END AS decision,
  CASE WHEN risk_score < 0.3::DOUBLE THEN 'Low risk score (' || printf('%.3f', risk_score) || ') indicates high creditworthiness'
    WHEN risk_score <= 0.7::DOUBLE THEN 'Medium risk score (' || printf('%.3f', risk_score) || ') requires manual underwriting review'
    ELSE 'High risk score (' || printf('%.3f', risk_score) || ') indicates significant default risk' END AS decision_reason
FROM (SELECT *, CASE
  WHEN person_income > 150000 AND base = 'AUTO_REJECT' AND risk_score < 0.8::DOUBLE THEN 'R1a'
  WHEN person_income > 150000 AND base = 'MANUAL_REVIEW' AND risk_score < 0.5::DOUBLE THEN 'R1b'
  WHEN loan_amnt < 5000 AND base = 'AUTO_REJECT' AND risk_score < 0.8::DOUBLE THEN 'R2'
  WHEN loan_amnt > 100000 AND base = 'AUTO_APPROVE' AND risk_score > 0.25::DOUBLE THEN 'R3a'
  WHEN loan_amnt > 100000 AND base = 'MANUAL_REVIEW' AND risk_score > 0.6::DOUBLE THEN 'R3b'
  WHEN coalesce(person_emp_length, 0) > 10 AND base = 'MANUAL_REVIEW' AND risk_score < 0.4::DOUBLE THEN 'R4'
  WHEN cb_person_default_on_file = 'Y' AND base = 'AUTO_APPROVE' THEN 'R5a'
  WHEN cb_person_default_on_file = 'Y' AND base <> 'AUTO_APPROVE' AND risk_score > 0.6::DOUBLE THEN 'R5b'
  WHEN cb_person_cred_hist_length < 1 AND base = 'AUTO_APPROVE' THEN 'R6'
  WHEN loan_percent_income > 0.4::DOUBLE AND base = 'AUTO_APPROVE' THEN 'R7a'
  WHEN loan_percent_income > 0.4::DOUBLE AND base = 'MANUAL_REVIEW' AND risk_score > 0.5::DOUBLE THEN 'R7b'
  END AS fired FROM scored)""",
    ),
    "applications": (
        ("decided",),
        f"""SELECT application_id, {FEATURE_LIST},
  CASE WHEN intake = 'P' AND priority IN ('1-URGENT', '2-HIGH') THEN 'PROCESSING' WHEN intake = 'P' THEN 'PENDING'
    WHEN decision = 'AUTO_APPROVE' THEN 'APPROVED' WHEN decision = 'AUTO_REJECT' THEN 'REJECTED'
    ELSE 'MANUAL_REVIEW' END AS status, created_at FROM decided""",
    ),
    "risk_scores": (
        ("apps",),
        f"""SELECT 'RS-' || application_id::VARCHAR || '-' || model_version AS risk_score_id, application_id, risk_score,
  {RISK_LEVEL.format('risk_score')} AS risk_category, model_version,
  greatest(risk_score, 1.0::DOUBLE - risk_score) AS confidence_score, prediction_timestamp,
  CAST(20 + application_id % 180 AS INTEGER) AS processing_time_ms
FROM (SELECT application_id, {RULE_SCORE} AS risk_score, '1.0' AS model_version, created_at AS prediction_timestamp FROM apps
  UNION ALL SELECT application_id, model_score, '1.1', created_at + INTERVAL 1 DAY FROM apps WHERE model_score IS NOT NULL)""",
    ),
    "decisions": (
        ("decided",),
        """SELECT 'D-' || application_id::VARCHAR AS decision_id, application_id,
  CASE decision WHEN 'AUTO_APPROVE' THEN 'APPROVE' WHEN 'AUTO_REJECT' THEN 'REJECT' ELSE 'MANUAL_REVIEW' END AS decision,
  decision_reason, risk_score, underwriter_id, CAST(NULL AS VARCHAR) AS underwriter_notes,
  created_at + to_days(CAST(application_id % 5 AS INTEGER)) AS decision_timestamp
FROM decided WHERE intake <> 'P'""",
    ),
    "snapshot_old": (
        ("applications",),
        """SELECT application_id, person_age, person_income, loan_grade, loan_amnt, loan_int_rate, status FROM applications""",
    ),
    "snapshot_new": (
        ("applications",),
        """SELECT application_id, person_age, person_income, loan_grade,
  CASE WHEN loan_intent = 'MEDICAL' THEN loan_amnt + 500 ELSE loan_amnt END AS loan_amnt, loan_int_rate, status
FROM applications WHERE NOT (loan_grade = 'G' AND cb_person_default_on_file = 'Y')
UNION ALL SELECT -application_id - 1, person_age, person_income, loan_grade, loan_amnt, loan_int_rate, status
FROM applications WHERE loan_grade = 'A' AND person_home_ownership = 'OWN'""",
    ),
    "cache": (
        ("apps",),
        f"""SELECT cache_key, risk_score, {RISK_LEVEL.format('risk_score')} AS risk_category, '1.0' AS model_version,
  CAST(epoch(TIMESTAMP '{AS_OF}') AS BIGINT) + (first_id % 15 - 7) * 86400 AS ttl
FROM (SELECT cache_key, min(score) AS risk_score, min(application_id) AS first_id
  FROM (SELECT application_id, {CACHE_KEY} AS cache_key, {RULE_SCORE} AS score FROM apps) GROUP BY cache_key)""",
    ),
    "baseline": (("apps",), "SELECT * FROM apps WHERE created_at < TIMESTAMP '1998-01-01'"),
    "current_apps": (
        ("apps",),
        """SELECT * REPLACE (floor(person_income * 1.2::DOUBLE) AS person_income)
FROM apps WHERE created_at >= TIMESTAMP '1998-01-01'""",
    ),
    "predictions": (
        ("apps",),
        """SELECT application_id, loan_status, coalesce(model_score, 0.5::DOUBLE) AS prob_default,
  CASE WHEN coalesce(model_score, 0.5::DOUBLE) > 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction_class FROM apps""",
    ),
}


def with_tables(uses: tuple[str, ...], body: str) -> str:
    """The body preceded by the derived tables it uses, in order of dependency."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in TABLES[name][0]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        visit(name)
    body = body.strip()
    if not ordered:
        return body
    tables = ",\n".join(f"{name} AS ({TABLES[name][1]})" for name in ordered)
    return f"WITH {tables}{body if body.startswith(',') else chr(10) + body}"
