"""Queries: application, decision, score and portfolio analytics."""

from pyspark.sql import functions as F

from creditlens.operators import portfolio as ops
from creditlens.operators import tables
from creditlens.plans.fixtures import AS_OF, Tables
from creditlens.plans.registry import query
from creditlens.plans.shape import as_text, joined, rounded

APPROVED = "count(*) FILTER (WHERE decision = 'APPROVE')"
COUNTS = f"""count(*) AS total_decisions, {APPROVED} AS approved_count,
  count(*) FILTER (WHERE decision = 'REJECT') AS rejected_count"""
REVIEW = "count(*) FILTER (WHERE decision = 'MANUAL_REVIEW') AS manual_review_count"
AVERAGE = "round(avg(risk_score), 6) AS avg_risk_score"
RATE = f"round({APPROVED} * 100.0::DOUBLE / nullif(count(*), 0), 2)"


@query(
    "application_stats",
    uses=("applications",),
    sql="""SELECT count(*) AS total_applications, count(*) FILTER (WHERE status = 'APPROVED') AS approved_count,
  count(*) FILTER (WHERE status = 'REJECTED') AS rejected_count,
  count(*) FILTER (WHERE status = 'MANUAL_REVIEW') AS manual_review_count,
  count(*) FILTER (WHERE status = 'PENDING') AS pending_count,
  round(avg(loan_amnt), 6) AS avg_loan_amount, sum(loan_amnt) AS total_loan_amount FROM applications""",
)
def application_stats(t: Tables):
    return rounded(ops.application_stats(t.applications), "avg_loan_amount")


@query(
    "approval_rate",
    uses=("decisions",),
    sql=f"SELECT {COUNTS}, {REVIEW}, {AVERAGE}, {RATE} AS approval_rate FROM decisions",
)
def approval_rate(t: Tables):
    return rounded(ops.approval_rate(t.decisions), "avg_risk_score")


@query(
    "approval_rate_range",
    uses=("decisions",),
    sql=f"""SELECT {COUNTS}, {REVIEW}, {AVERAGE}, {RATE} AS approval_rate FROM decisions
WHERE decision_timestamp BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'""",
)
def approval_rate_range(t: Tables):
    return rounded(ops.approval_rate(t.decisions, "1997-01-01", "1999-12-31"), "avg_risk_score")


@query(
    "underwriter_performance",
    uses=("decisions",),
    sql=f"""SELECT underwriter_id, {COUNTS}, {AVERAGE}, {RATE} AS approval_rate FROM decisions
WHERE underwriter_id IS NOT NULL GROUP BY underwriter_id ORDER BY total_decisions DESC, underwriter_id""",
)
def underwriter_performance(t: Tables):
    return rounded(ops.underwriter_performance(t.decisions), "avg_risk_score")


@query(
    "underwriter_one",
    uses=("decisions",),
    sql=f"""SELECT underwriter_id, {COUNTS}, {AVERAGE}, min(decision_timestamp) AS first_decision,
  max(decision_timestamp) AS last_decision, {RATE} AS approval_rate FROM decisions
WHERE underwriter_id = 'UW-5' GROUP BY underwriter_id""",
)
def underwriter_one(t: Tables):
    return rounded(ops.underwriter_performance(t.decisions, "UW-5"), "avg_risk_score")


@query(
    "decision_trends",
    uses=("decisions",),
    sql=f"""SELECT CAST(CAST(decision_timestamp AS DATE) AS VARCHAR) AS decision_date, {COUNTS}, {REVIEW}, {AVERAGE},
  {RATE} AS approval_rate FROM decisions WHERE decision_timestamp >= DATE '{AS_OF}' - INTERVAL 30 DAY
GROUP BY 1 ORDER BY 1 DESC""",
)
def decision_trends(t: Tables):
    return as_text(rounded(ops.decision_trends(t.decisions, AS_OF, 30), "avg_risk_score"), "decision_date")


@query(
    "decision_stats",
    uses=("decisions",),
    sql=f"""SELECT {COUNTS}, {REVIEW}, {AVERAGE}, min(risk_score) AS min_risk_score, max(risk_score) AS max_risk_score,
  count(DISTINCT underwriter_id) AS active_underwriters, {RATE} AS overall_approval_rate FROM decisions""",
)
def decision_stats(t: Tables):
    return rounded(ops.decision_stats(t.decisions), "avg_risk_score")


SCORE_STATS = """SELECT count(*) AS total_predictions, round(avg(risk_score), 6) AS avg_risk_score,
  min(risk_score) AS min_risk_score, max(risk_score) AS max_risk_score,
  round(avg(processing_time_ms), 6) AS avg_processing_time,
  count(*) FILTER (WHERE risk_category = 'LOW') AS low_risk_count,
  count(*) FILTER (WHERE risk_category = 'MEDIUM') AS medium_risk_count,
  count(*) FILTER (WHERE risk_category = 'HIGH') AS high_risk_count FROM risk_scores"""


@query("risk_score_stats", uses=("risk_scores",), sql=SCORE_STATS)
def risk_score_stats(t: Tables):
    return rounded(ops.risk_score_stats(t.risk_scores), "avg_risk_score", "avg_processing_time")


@query(
    "risk_score_stats_range",
    uses=("risk_scores",),
    sql=SCORE_STATS + " WHERE prediction_timestamp BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'",
)
def risk_score_stats_range(t: Tables):
    stats = ops.risk_score_stats(t.risk_scores, "1997-01-01", "1999-12-31")
    return rounded(stats, "avg_risk_score", "avg_processing_time")


@query(
    "model_version_stats",
    uses=("risk_scores",),
    sql="""SELECT model_version, count(*) AS prediction_count, round(avg(risk_score), 6) AS avg_risk_score,
  round(stddev_samp(risk_score), 6) AS risk_score_stddev, round(avg(confidence_score), 6) AS avg_confidence,
  round(avg(processing_time_ms), 6) AS avg_processing_time FROM risk_scores GROUP BY model_version""",
)
def model_version_stats(t: Tables):
    return rounded(
        ops.model_version_stats(t.risk_scores),
        "avg_risk_score",
        "risk_score_stddev",
        "avg_confidence",
        "avg_processing_time",
    )


@query(
    "scores_by_version",
    uses=("risk_scores",),
    sql="""SELECT * FROM risk_scores WHERE model_version = '1.1'
ORDER BY prediction_timestamp DESC, risk_score_id LIMIT 100""",
)
def scores_by_version(t: Tables):
    chosen = t.risk_scores.where(F.col("model_version") == "1.1")
    return tables.newest(chosen, "prediction_timestamp", "risk_score_id", 100)


DAILY_SQL = """SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS date, count(*) AS total_applications,
  count(*) FILTER (WHERE status = 'APPROVED') AS approved_count, count(*) FILTER (WHERE status = 'REJECTED') AS rejected_count,
  round(avg(loan_amnt), 6) AS avg_loan_amount, sum(loan_amnt) AS total_loan_amount
FROM applications GROUP BY 1 ORDER BY 1 DESC"""


@query("daily_portfolio", uses=("applications",), sql=DAILY_SQL)
def daily_portfolio(t: Tables):
    return as_text(rounded(ops.daily_portfolio(t.applications), "avg_loan_amount"), "date")


@query(
    "portfolio_analytics",
    uses=("decided",),
    sql="""SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS date, count(*) AS total_applications,
  count(*) FILTER (WHERE decision = 'AUTO_APPROVE') AS approved_count, count(*) FILTER (WHERE decision = 'AUTO_REJECT') AS rejected_count,
  count(*) FILTER (WHERE decision = 'MANUAL_REVIEW') AS manual_review_count, sum(loan_amnt) AS total_loan_amount,
  sum(CASE WHEN decision = 'AUTO_APPROVE' THEN loan_amnt ELSE 0 END) AS approved_loan_amount,
  round(avg(risk_score), 6) AS average_risk_score, round(avg(loan_status), 6) AS default_rate
FROM decided GROUP BY 1""",
)
def portfolio_analytics(t: Tables):
    return as_text(
        rounded(ops.portfolio_analytics(t.decided), "average_risk_score", "default_rate"), "date"
    )


TOTALS_SQL = """count(*) AS total_applications, count(*) FILTER (WHERE decision = 'AUTO_APPROVE') AS approved_applications,
  count(*) FILTER (WHERE decision = 'AUTO_REJECT') AS rejected_applications,
  count(*) FILTER (WHERE decision = 'MANUAL_REVIEW') AS pending_review, sum(loan_amnt) AS total_loan_amount,
  round(avg(risk_score), 6) AS average_risk_score"""


@query("portfolio_realtime", uses=("decided",), sql=f"SELECT {TOTALS_SQL} FROM decided")
def portfolio_realtime(t: Tables):
    return rounded(ops.portfolio_totals(t.decided), "average_risk_score")


@query(
    "portfolio_distribution",
    uses=("decided",),
    sql="""SELECT count(*) FILTER (WHERE risk_score < 0.3::DOUBLE) AS low_risk,
  count(*) FILTER (WHERE risk_score BETWEEN 0.3::DOUBLE AND 0.7::DOUBLE) AS medium_risk,
  count(*) FILTER (WHERE risk_score > 0.7::DOUBLE) AS high_risk, count(*) FILTER (WHERE loan_amnt < 10000) AS small_loans,
  count(*) FILTER (WHERE loan_amnt BETWEEN 10000 AND 50000) AS medium_loans,
  count(*) FILTER (WHERE loan_amnt > 50000) AS large_loans, round(avg(loan_amnt), 6) AS average_loan_amount,
  round(avg(risk_score), 6) AS average_risk_score,
  round(count(*) FILTER (WHERE decision = 'AUTO_APPROVE')::DOUBLE / count(*), 6) AS approval_rate FROM decided""",
)
def portfolio_distribution(t: Tables):
    return rounded(
        ops.portfolio_distribution(t.decided), "average_loan_amount", "average_risk_score", "approval_rate"
    )


@query(
    "portfolio_health",
    uses=("decided",),
    sql="""SELECT round(approval, 6) AS approval_rate, round(risk, 6) AS average_risk_score,
  round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, approval * 0.6::DOUBLE + (1.0::DOUBLE - risk) * 0.4::DOUBLE)), 6) AS health_score
FROM (SELECT count(*) FILTER (WHERE decision = 'AUTO_APPROVE')::DOUBLE / count(*) AS approval, avg(risk_score) AS risk FROM decided)""",
)
def portfolio_health(t: Tables):
    return rounded(ops.portfolio_health(t.decided), "approval_rate", "average_risk_score", "health_score")


ROW_RATE = "CASE decision WHEN 'AUTO_APPROVE' THEN 0.7::DOUBLE WHEN 'AUTO_REJECT' THEN 0.3::DOUBLE ELSE 0.5::DOUBLE END"


@query(
    "portfolio_row",
    uses=("decided",),
    sql=f"""SELECT application_id, decision, risk_score, risk_level, loan_amnt AS loan_amount, person_income, loan_grade,
  {ROW_RATE} AS approval_rate, CAST(epoch(TIMESTAMP '{AS_OF}') AS BIGINT) + 90 * 86400 AS ttl FROM decided""",
)
def portfolio_row(t: Tables):
    return ops.analytics_rows(t.decided, AS_OF)


@query(
    "portfolio_insights",
    uses=("decided",),
    sql=f"""SELECT application_id, decision, risk_score, loan_amnt AS loan_amount, {ROW_RATE} AS approval_rate,
  concat_ws(' | ', CASE decision WHEN 'AUTO_APPROVE' THEN 'Low-risk application approved automatically'
    WHEN 'AUTO_REJECT' THEN 'High-risk application rejected automatically' ELSE 'Medium-risk application requires manual review' END,
  CASE WHEN risk_score < 0.3::DOUBLE THEN 'Excellent credit profile' WHEN risk_score > 0.7::DOUBLE THEN 'High default risk detected' END,
  CASE WHEN loan_amnt > 50000 THEN 'Large loan amount - increased scrutiny applied' END) AS insights FROM decided""",
)
def portfolio_insights(t: Tables):
    return joined(ops.insights(t.decided), "insights")
