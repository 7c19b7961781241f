"""Queries: scores, decisions, summaries, keys and prediction output."""

from pyspark.sql import functions as F

from creditlens.functions import scoring
from creditlens.operators import decisions as ops
from creditlens.operators import models
from creditlens.plans.fixture_sql import CACHE_KEY, RULE_SCORE
from creditlens.plans.fixtures import AS_OF, FEATURES, Tables
from creditlens.plans.registry import query
from creditlens.plans.shape import joined, rounded
from creditlens.plans.validation import _scoring_sql


@query("rule_score", uses=("apps",), sql=f"SELECT application_id, {RULE_SCORE} AS risk_score FROM apps")
def rule_score(t: Tables):
    return ops.score(t.apps).select("application_id", "risk_score")


@query("score_or_fallback", uses=("scored",), sql="SELECT application_id, risk_score FROM scored")
def score_or_fallback(t: Tables):
    return ops.score(t.apps, "model_score").select("application_id", "risk_score")


@query(
    "risk_level_inference",
    uses=("predictions",),
    sql="""SELECT application_id, prob_default, CASE WHEN prob_default < 0.3::DOUBLE THEN 'LOW'
  WHEN prob_default < 0.7::DOUBLE THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level FROM predictions""",
)
def risk_level_inference(t: Tables):
    return t.predictions.select(
        "application_id", "prob_default", scoring.risk_level_inference(F.col("prob_default")).alias("risk_level")
    )


@query(
    "base_decision",
    uses=("decided",),
    sql="""SELECT application_id, risk_score, base AS base_decision, risk_level, decision_reason,
  CASE base WHEN 'AUTO_APPROVE' THEN 0.95::DOUBLE WHEN 'MANUAL_REVIEW' THEN 0.6::DOUBLE ELSE 0.05::DOUBLE END AS base_probability
FROM decided""",
)
def base_decision(t: Tables):
    return t.decided.select(
        "application_id",
        "risk_score",
        "base_decision",
        "risk_level",
        "decision_reason",
        scoring.approval_probability(F.col("base_decision")).alias("base_probability"),
    )


@query(
    "final_decision",
    uses=("decided",),
    sql="""SELECT application_id, decision, fired AS rule_fired, risk_level, decision_reason,
  CASE decision WHEN 'AUTO_APPROVE' THEN 0.95::DOUBLE WHEN 'MANUAL_REVIEW' THEN 0.6::DOUBLE ELSE 0.05::DOUBLE END AS approval_probability
FROM decided""",
)
def final_decision(t: Tables):
    return t.decided.select(
        "application_id", "decision", "rule_fired", "risk_level", "decision_reason", "approval_probability"
    )


SUMMARY_SQL = """SELECT application_id,
  'Applicant ' || application_id::VARCHAR || CASE decision WHEN 'AUTO_APPROVE' THEN ' - APPROVED: Low risk ('
    WHEN 'MANUAL_REVIEW' THEN ' - MANUAL REVIEW: Medium risk (' ELSE ' - REJECTED: High risk (' END
    || printf('%.3f', risk_score) || '), Income: $' || format('{:,}', person_income::BIGINT)
    || ', Loan: $' || format('{:,}', loan_amnt::BIGINT) AS decision_summary,
  'Application ' || application_id::VARCHAR || ': Decision=' || decision || ', Risk=' || printf('%.3f', risk_score)
    || ', Status=' || CASE decision WHEN 'AUTO_APPROVE' THEN 'APPROVED' WHEN 'AUTO_REJECT' THEN 'REJECTED'
    ELSE 'PENDING_REVIEW' END AS processing_summary
FROM decided"""


@query("decision_summary", uses=("decided",), sql=SUMMARY_SQL)
def decision_summary(t: Tables):
    return ops.with_final_status(t.decided).select("application_id", "decision_summary", "processing_summary")


STATUS_SQL = """CASE decision WHEN 'AUTO_APPROVE' THEN 'APPROVED' WHEN 'AUTO_REJECT' THEN 'REJECTED' ELSE 'PENDING_REVIEW' END"""


@query(
    "final_status",
    uses=("decided",),
    sql=f"SELECT application_id, decision, {STATUS_SQL} AS final_status FROM decided",
)
def final_status(t: Tables):
    return ops.with_final_status(t.decided).select("application_id", "decision", "final_status")


@query(
    "status_cache_row",
    uses=("decided",),
    sql=f"""SELECT application_id, {STATUS_SQL} AS status, decision, risk_score, risk_level,
  CAST(epoch(TIMESTAMP '{AS_OF}') AS BIGINT) + 30 * 86400 AS ttl FROM decided""",
)
def status_cache_row(t: Tables):
    return ops.status_cache_rows(t.decided, AS_OF)


def _request_sql() -> str:
    """Key-sorted JSON of all features of a request; texts in quotes, numbers as they print."""
    texts = {"person_home_ownership", "loan_intent", "loan_grade", "cb_person_default_on_file"}
    mark = {True: "'\"' || {0} || '\"'", False: "{0}::VARCHAR"}
    parts = [f"'\"{name}\":' || coalesce({mark[name in texts].format(name)}, 'null')" for name in sorted(FEATURES)]
    return "md5('{' || " + " || ',' || ".join(parts) + " || '}')"


@query(
    "cache_key",
    uses=("apps",),
    sql=f"SELECT application_id, {CACHE_KEY} AS cache_key, {_request_sql()} AS request_key FROM apps",
)
def cache_key(t: Tables):
    return t.apps.select(
        "application_id", scoring.cache_key().alias("cache_key"), scoring.request_key(FEATURES).alias("request_key")
    )


@query(
    "application_id",
    uses=("apps",),
    sql="SELECT application_id, 'APP-' || upper(substr(md5(application_id::VARCHAR), 1, 8)) AS application_code FROM apps",
)
def application_id(t: Tables):
    return t.apps.select(
        "application_id", scoring.application_code(F.col("application_id")).alias("application_code")
    )


@query(
    "score_with_errors",
    uses=("apps",),
    sql=f"""SELECT application_id, errors, CASE WHEN errors = '' THEN risk END AS risk_score,
  CASE WHEN errors = '' THEN CASE WHEN risk < 0.3::DOUBLE THEN 'LOW' WHEN risk < 0.7::DOUBLE THEN 'MEDIUM' ELSE 'HIGH' END END AS risk_level
FROM (SELECT application_id, {_scoring_sql()} AS errors, {RULE_SCORE} AS risk FROM apps)""",
)
def score_with_errors(t: Tables):
    scored = ops.score_with_errors(t.apps)
    return joined(scored.select("application_id", "errors", "risk_score", "risk_level"), "errors")


@query(
    "batch_output",
    uses=("predictions",),
    sql=f"""SELECT application_id, loan_status, prob_default, prediction_class,
  'pred_' || application_id::VARCHAR || '_' || CAST(epoch(TIMESTAMP '{AS_OF}') AS BIGINT)::VARCHAR AS prediction_id,
  prob_default AS risk_score, CASE WHEN prob_default < 0.3::DOUBLE THEN 'LOW' WHEN prob_default < 0.7::DOUBLE THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
  greatest(prob_default, 1.0::DOUBLE - prob_default) AS confidence_score, 'credit-risk-ensemble' AS model_name,
  '1.0' AS model_version, '{AS_OF}' AS prediction_timestamp, 1.0::DOUBLE - prob_default AS prob_no_default FROM predictions""",
)
def batch_output(t: Tables):
    return ops.batch_output(t.predictions, "credit-risk-ensemble", "1.0", AS_OF)


@query(
    "batch_summary",
    uses=("predictions",),
    sql=""", leveled AS (SELECT prob_default, greatest(prob_default, 1.0::DOUBLE - prob_default) AS confidence,
  CASE WHEN prob_default < 0.3::DOUBLE THEN 'LOW' WHEN prob_default < 0.7::DOUBLE THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level FROM predictions)
SELECT risk_level, count(*) AS records, (SELECT count(*) FROM leveled) AS total_records,
  round((SELECT avg(prob_default) FROM leveled), 6) AS average_risk_score,
  round((SELECT avg(confidence) FROM leveled), 6) AS average_confidence FROM leveled GROUP BY risk_level""",
)
def batch_summary(t: Tables):
    output = ops.batch_output(t.predictions, "credit-risk-ensemble", "1.0", AS_OF)
    return rounded(ops.batch_summary(output), "average_risk_score", "average_confidence")


@query(
    "vote_math",
    uses=("apps",),
    sql=f"""SELECT application_id, round((0.3::DOUBLE * a + 0.4::DOUBLE * b + 0.3::DOUBLE * c) / (0.3::DOUBLE + 0.4::DOUBLE + 0.3::DOUBLE), 9) AS p_vote
FROM (SELECT application_id, {RULE_SCORE} AS a, coalesce(model_score, 0.5::DOUBLE) AS b, loan_percent_income / 1.1::DOUBLE AS c FROM apps)""",
)
def vote_math(t: Tables):
    probabilities = t.apps.select(
        "application_id",
        scoring.rule_score().alias("p_rf"),
        F.coalesce("model_score", F.lit(0.5)).alias("p_gbt"),
        (F.col("loan_percent_income") / F.lit(1.1)).alias("p_mlp"),
    )
    return rounded(models.vote(probabilities).select("application_id", "p_vote"), "p_vote", digits=9)
