"""Queries: joins, updates, deletes, audit and cache."""

from pyspark.sql import functions as F

from creditlens.functions import scoring
from creditlens.operators import tables as ops
from creditlens.plans.fixture_sql import CACHE_KEY, RISK_LEVEL, RULE_SCORE
from creditlens.plans.fixtures import AS_OF, Tables
from creditlens.plans.registry import query

SUMMARY = ["application_id", "person_age", "person_income", "loan_amnt", "loan_grade", "status", "created_at"]


@query(
    "application_summary",
    uses=("applications", "risk_scores", "decisions"),
    sql="""SELECT a.application_id, a.person_age, a.person_income, a.loan_amnt, a.loan_grade, a.status, a.created_at,
  rs.risk_score, rs.risk_category, d.decision, d.decision_reason FROM applications a
LEFT JOIN risk_scores rs ON a.application_id = rs.application_id LEFT JOIN decisions d ON a.application_id = d.application_id""",
)
def application_summary(t: Tables):
    return ops.application_summary(t.applications.select(*SUMMARY), t.risk_scores, t.decisions).select(
        *SUMMARY, "risk_score", "risk_category", "decision", "decision_reason"
    )


@query(
    "application_summary_by_id",
    uses=("applications", "risk_scores", "decisions"),
    sql="""SELECT a.application_id, a.person_age, a.person_income, a.loan_amnt, a.loan_grade, a.status, a.created_at,
  rs.risk_score, rs.risk_category, rs.model_version, d.decision, d.decision_reason, d.underwriter_id FROM applications a
LEFT JOIN risk_scores rs ON a.application_id = rs.application_id LEFT JOIN decisions d ON a.application_id = d.application_id
WHERE a.application_id = 42""",
)
def application_summary_by_id(t: Tables):
    one = t.applications.where(F.col("application_id") == 42).select(*SUMMARY)
    return ops.application_summary(one, t.risk_scores, t.decisions)


DECISION_COLUMNS = """d.decision_id, d.application_id, d.decision, d.decision_reason, d.risk_score, d.underwriter_id,
  d.decision_timestamp, a.person_age, a.person_income, a.loan_amnt, a.loan_grade"""
BORROWER = ["person_age", "person_income", "loan_amnt", "loan_grade"]
JOINED = f"SELECT {DECISION_COLUMNS} FROM decisions d JOIN applications a ON d.application_id = a.application_id"
NEWEST = "ORDER BY d.decision_timestamp DESC, d.decision_id"


def _with_borrower(t: Tables, decisions):
    return ops.with_application(decisions.drop("underwriter_notes"), t.applications, BORROWER)


@query(
    "decisions_by_status",
    uses=("decisions", "applications"),
    sql=f"{JOINED} WHERE d.decision = 'REJECT' {NEWEST} LIMIT 100",
)
def decisions_by_status(t: Tables):
    chosen = t.decisions.where(F.col("decision") == "REJECT")
    return ops.newest(_with_borrower(t, chosen), "decision_timestamp", "decision_id", 100)


@query(
    "decisions_by_underwriter",
    uses=("decisions", "applications"),
    sql=f"{JOINED} WHERE d.underwriter_id = 'UW-5' {NEWEST} LIMIT 100",
)
def decisions_by_underwriter(t: Tables):
    chosen = t.decisions.where(F.col("underwriter_id") == "UW-5")
    return ops.newest(_with_borrower(t, chosen), "decision_timestamp", "decision_id", 100)


@query(
    "decisions_date_range",
    uses=("decisions", "applications"),
    sql=f"{JOINED} WHERE d.decision_timestamp BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31' {NEWEST}",
)
def decisions_date_range(t: Tables):
    from creditlens.operators.portfolio import between

    chosen = between(t.decisions, "decision_timestamp", "1997-01-01", "1997-12-31")
    return ops.newest(_with_borrower(t, chosen), "decision_timestamp", "decision_id")


@query(
    "high_risk_apps",
    uses=("risk_scores", "applications"),
    sql="""SELECT rs.*, a.person_age, a.person_income, a.loan_amnt, a.loan_grade FROM risk_scores rs
JOIN applications a ON rs.application_id = a.application_id WHERE rs.risk_score >= 0.7::DOUBLE
ORDER BY rs.risk_score DESC, rs.risk_score_id LIMIT 50""",
)
def high_risk_apps(t: Tables):
    risky = t.risk_scores.where(F.col("risk_score") >= 0.7)
    return (
        ops.with_application(risky, t.applications, BORROWER)
        .orderBy(F.col("risk_score").desc(), "risk_score_id")
        .limit(50)
    )


@query(
    "high_risk_decisions",
    uses=("decisions", "applications"),
    sql=f"""SELECT {DECISION_COLUMNS}, a.person_home_ownership FROM decisions d JOIN applications a ON d.application_id = a.application_id
WHERE d.risk_score >= 0.7::DOUBLE ORDER BY d.risk_score DESC, d.decision_timestamp DESC, d.decision_id LIMIT 50""",
)
def high_risk_decisions(t: Tables):
    risky = t.decisions.where(F.col("risk_score") >= 0.7).drop("underwriter_notes")
    return (
        ops.with_application(risky, t.applications, [*BORROWER, "person_home_ownership"])
        .orderBy(F.col("risk_score").desc(), F.col("decision_timestamp").desc(), "decision_id")
        .limit(50)
    )


@query(
    "orphans",
    uses=("decisions", "applications", "risk_scores"),
    sql=""", kept AS (SELECT application_id FROM applications WHERE loan_grade <> 'G')
SELECT 'decisions' AS table_name, decision_id AS row_id, application_id FROM decisions
  WHERE application_id NOT IN (SELECT application_id FROM kept)
UNION ALL SELECT 'risk_scores', risk_score_id, application_id FROM risk_scores
  WHERE application_id NOT IN (SELECT application_id FROM kept)""",
)
def orphans(t: Tables):
    # The parents without grade G, so that there are orphans to find.
    parents = t.applications.where(F.col("loan_grade") != "G")
    lost = [
        ops.orphans(t.decisions, parents).select(
            F.lit("decisions").alias("table_name"), F.col("decision_id").alias("row_id"), "application_id"
        ),
        ops.orphans(t.risk_scores, parents).select(
            F.lit("risk_scores").alias("table_name"), F.col("risk_score_id").alias("row_id"), "application_id"
        ),
    ]
    return ops.union_frames(lost)


AUDIT_SQL = "SELECT 'L-' || application_id::VARCHAR AS log_id, application_id, status AS action FROM applications"


@query(
    "cascade_delete",
    uses=("applications", "risk_scores", "decisions"),
    sql=f""", gone AS (SELECT application_id FROM applications WHERE loan_intent = 'VENTURE'), audit AS ({AUDIT_SQL})
SELECT 'applications' AS table_name, application_id::VARCHAR AS row_id, application_id FROM applications WHERE application_id NOT IN (SELECT * FROM gone)
UNION ALL SELECT 'risk_scores', risk_score_id, application_id FROM risk_scores WHERE application_id NOT IN (SELECT * FROM gone)
UNION ALL SELECT 'decisions', decision_id, application_id FROM decisions WHERE application_id NOT IN (SELECT * FROM gone)
UNION ALL SELECT 'audit_logs', log_id, CASE WHEN application_id NOT IN (SELECT * FROM gone) THEN application_id END FROM audit""",
)
def cascade_delete(t: Tables):
    audit = t.applications.select(
        F.concat(F.lit("L-"), F.col("application_id").cast("string")).alias("log_id"),
        "application_id",
        F.col("status").alias("action"),
    )
    deleted = t.applications.where(F.col("loan_intent") == "VENTURE")
    left = ops.delete_cascade(t.applications, t.risk_scores, t.decisions, audit, deleted)
    ids = {
        "applications": F.col("application_id").cast("string"),
        "risk_scores": F.col("risk_score_id"),
        "decisions": F.col("decision_id"),
        "audit_logs": F.col("log_id"),
    }
    return ops.union_frames(
        [df.select(F.lit(name).alias("table_name"), ids[name].alias("row_id"), "application_id") for name, df in left.items()]
    )


@query(
    "apply_status_updates",
    uses=("applications",),
    sql=f""", changes AS (SELECT application_id, 'PROCESSING' AS status, 1 AS step FROM applications WHERE status = 'PENDING'
  UNION ALL SELECT application_id, 'MANUAL_REVIEW', 2 FROM applications WHERE status = 'PENDING' AND loan_grade IN ('F', 'G'))
SELECT a.application_id, coalesce(c.status, a.status) AS status,
  CASE WHEN c.status IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE a.created_at END AS updated_at
FROM applications a LEFT JOIN (SELECT application_id, arg_max(status, step) AS status FROM changes GROUP BY 1) c USING (application_id)""",
)
def apply_status_updates(t: Tables):
    base = t.applications.select("application_id", "status", F.col("created_at").alias("updated_at"))
    pending = t.applications.where(F.col("status") == "PENDING")
    changes = ops.union_frames(
        [
            pending.select("application_id", F.lit("PROCESSING").alias("status"), F.lit(1).alias("step")),
            pending.where(F.col("loan_grade").isin("F", "G")).select(
                "application_id", F.lit("MANUAL_REVIEW").alias("status"), F.lit(2).alias("step")
            ),
        ]
    )
    now = F.lit(AS_OF).cast("timestamp_ntz")
    return ops.apply_updates(base, changes, "application_id", ["status"], "step", "updated_at", now)


@query(
    "apply_decision_updates",
    uses=("decisions",),
    sql=f"""SELECT decision_id, decision, CASE WHEN decision = 'MANUAL_REVIEW' THEN 'Reviewed by hand' ELSE decision_reason END AS decision_reason,
  CASE WHEN decision = 'MANUAL_REVIEW' AND underwriter_id IS NOT NULL THEN 'See ' || underwriter_id ELSE underwriter_notes END AS underwriter_notes,
  CASE WHEN decision = 'MANUAL_REVIEW' THEN TIMESTAMP '{AS_OF}' ELSE decision_timestamp END AS decision_timestamp FROM decisions""",
)
def apply_decision_updates(t: Tables):
    base = t.decisions.select(
        "decision_id", "decision", "decision_reason", "underwriter_notes", "decision_timestamp"
    )
    changes = t.decisions.where(F.col("decision") == "MANUAL_REVIEW").select(
        "decision_id",
        F.lit("Reviewed by hand").alias("decision_reason"),
        F.concat(F.lit("See "), F.col("underwriter_id")).alias("underwriter_notes"),
        F.lit(1).alias("step"),
    )
    return ops.apply_updates(
        base,
        changes,
        "decision_id",
        ["decision_reason", "underwriter_notes"],
        "step",
        "decision_timestamp",
        F.lit(AS_OF).cast("timestamp_ntz"),
    )


@query(
    "latest_score",
    uses=("risk_scores",),
    sql="""SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY application_id
  ORDER BY prediction_timestamp DESC, risk_score_id DESC) AS n FROM risk_scores) WHERE n = 1""",
)
def latest_score(t: Tables):
    return ops.latest_per_key(t.risk_scores, "application_id", "prediction_timestamp", "risk_score_id")


@query(
    "latest_decision",
    uses=("decisions",),
    sql="""SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY application_id
  ORDER BY decision_timestamp DESC, decision_id DESC) AS n FROM (SELECT * FROM decisions UNION ALL
  SELECT * REPLACE (decision_id || '-2' AS decision_id, 'APPROVE' AS decision,
    decision_timestamp + to_days(CAST(application_id % 3 - 1 AS INTEGER)) AS decision_timestamp)
  FROM decisions WHERE decision = 'MANUAL_REVIEW')) WHERE n = 1""",
)
def latest_decision(t: Tables):
    """Manual reviews have a second decision: a day before, at the same time, or a day later."""
    days = F.make_dt_interval((F.col("application_id") % 3 - 1).cast("int"))
    again = t.decisions.where(F.col("decision") == "MANUAL_REVIEW").withColumns(
        {
            "decision_id": F.concat("decision_id", F.lit("-2")),
            "decision": F.lit("APPROVE"),
            "decision_timestamp": F.col("decision_timestamp") + days,
        }
    )
    return ops.latest_per_key(t.decisions.unionByName(again), "application_id", "decision_timestamp", "decision_id")


def _json_sql(side: str) -> str:
    # Numbers as text, so that both engines print the same.
    return f"""CASE WHEN {side}.application_id IS NOT NULL THEN '{{"application_id":' || {side}.application_id::VARCHAR
  || ',"person_age":' || {side}.person_age::VARCHAR || ',"person_income":"' || {side}.person_income::DECIMAL(12,2)::VARCHAR
  || '","loan_grade":"' || {side}.loan_grade || '","loan_amnt":"' || {side}.loan_amnt::DECIMAL(12,2)::VARCHAR
  || '","loan_int_rate":' || coalesce('"' || {side}.loan_int_rate::DECIMAL(12,2)::VARCHAR || '"', 'null')
  || ',"status":"' || {side}.status || '"}}' END"""


@query(
    "audit_diff",
    uses=("snapshot_old", "snapshot_new"),
    sql=f"""SELECT CASE WHEN o.application_id IS NULL THEN 'INSERT' WHEN n.application_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
  'applications' AS entity_type, coalesce(o.application_id, n.application_id)::VARCHAR AS entity_id,
  {_json_sql('o')} AS old_value, {_json_sql('n')} AS new_value
FROM snapshot_old o FULL JOIN snapshot_new n ON o.application_id = n.application_id
WHERE o.application_id IS NULL OR n.application_id IS NULL OR o.loan_amnt IS DISTINCT FROM n.loan_amnt""",
)
def audit_diff(t: Tables):
    def exact(df):
        return df.withColumns(
            {c: F.col(c).cast("decimal(12,2)").cast("string") for c in ("person_income", "loan_amnt", "loan_int_rate")}
        )

    return ops.audit_diff(exact(t.snapshot_old), exact(t.snapshot_new), "application_id", "applications")


NOW = f"CAST(epoch(TIMESTAMP '{AS_OF}') AS BIGINT)"


@query(
    "score_cache_lookup",
    uses=("apps", "cache"),
    sql=f"""SELECT a.application_id, a.cache_key, c.risk_score IS NOT NULL AS cache_hit, coalesce(c.risk_score, a.rule) AS risk_score
FROM (SELECT application_id, {CACHE_KEY} AS cache_key, {RULE_SCORE} AS rule FROM apps) a
LEFT JOIN (SELECT * FROM cache WHERE ttl > {NOW}) c ON a.cache_key = c.cache_key""",
)
def score_cache_lookup(t: Tables):
    found = ops.cache_lookup(t.apps, t.cache, scoring.rule_score(), AS_OF)
    return found.select("application_id", "cache_key", "cache_hit", "risk_score")


@query(
    "score_cache_merge",
    uses=("scored", "cache"),
    sql=f""", written AS (SELECT {CACHE_KEY} AS cache_key, max(risk_score) AS risk_score, max({RISK_LEVEL.format('risk_score')}) AS risk_category,
  '1.1' AS model_version, {NOW} + 168 * 3600 AS ttl FROM scored WHERE model_score IS NOT NULL GROUP BY 1)
SELECT * FROM written UNION ALL
SELECT * FROM cache WHERE ttl > {NOW} AND cache_key NOT IN (SELECT cache_key FROM written)""",
)
def score_cache_merge(t: Tables):
    from creditlens.operators.decisions import score

    scored = score(t.apps.where(F.col("model_score").isNotNull()), "model_score")
    written = ops.cache_rows(
        scored.withColumn("risk_category", scoring.risk_level(F.col("risk_score"))), AS_OF
    )
    return ops.cache_merge(t.cache, written, AS_OF)


@query(
    "cache_extend_ttl",
    uses=("cache",),
    sql=f"""SELECT cache_key, CASE WHEN risk_category = 'HIGH' THEN {NOW} + 24 * 3600 ELSE ttl END AS ttl FROM cache""",
)
def cache_extend_ttl(t: Tables):
    return ops.extend_ttl(t.cache, F.col("risk_category") == "HIGH", AS_OF, 24).select("cache_key", "ttl")


@query(
    "kv_query",
    uses=("cache",),
    sql="SELECT * FROM cache WHERE risk_category = 'HIGH' AND risk_score >= 0.9::DOUBLE ORDER BY risk_score DESC, cache_key LIMIT 100",
)
def kv_query(t: Tables):
    hits = t.cache.where((F.col("risk_category") == "HIGH") & (F.col("risk_score") >= 0.9))
    return hits.orderBy(F.col("risk_score").desc(), "cache_key").limit(100)


@query(
    "kv_scan",
    uses=("cache",),
    sql=f"SELECT * FROM cache WHERE ttl > {NOW} ORDER BY cache_key",
)
def kv_scan(t: Tables):
    return ops.query_items(t.cache, F.col("ttl") > ops.epoch(AS_OF), ["cache_key"])


@query(
    "kv_upsert",
    uses=("decided",),
    sql="""SELECT application_id AS item_key, decision AS item_value, 2 AS version FROM decided WHERE intake <> 'P'
UNION ALL SELECT application_id, base, 1 FROM decided WHERE intake = 'P'""",
)
def kv_upsert(t: Tables):
    stored = t.decided.select(
        F.col("application_id").alias("item_key"), F.col("base_decision").alias("item_value"), F.lit(1).alias("version")
    )
    puts = t.decided.where(F.col("intake") != "P").select(
        F.col("application_id").alias("item_key"), F.col("decision").alias("item_value"), F.lit(2).alias("version")
    )
    return ops.put_items(stored, puts, "item_key", "version")


WIDE_COLUMNS = {
    "applications": {"application_id": "application_id::VARCHAR", "status": "CASE decision WHEN 'AUTO_APPROVE' THEN 'APPROVED' WHEN 'AUTO_REJECT' THEN 'REJECTED' ELSE 'MANUAL_REVIEW' END"}
    | {c: f"{c}::VARCHAR" for c in ("person_age", "person_home_ownership", "loan_intent", "loan_grade", "cb_person_default_on_file")},
    "risk_scores": {"application_id": "application_id::VARCHAR", "risk_category": "risk_level", "risk_score": "CAST(round(risk_score * 1000) AS BIGINT)::VARCHAR"},
    "decisions": {
        "application_id": "application_id::VARCHAR",
        "decision": "CASE decision WHEN 'AUTO_APPROVE' THEN 'APPROVE' WHEN 'AUTO_REJECT' THEN 'REJECT' ELSE 'MANUAL_REVIEW' END",
        "approval_probability": "CASE decision WHEN 'AUTO_APPROVE' THEN '950' WHEN 'MANUAL_REVIEW' THEN '600' ELSE '50' END",
    },
}


@query(
    "split_wide_event",
    uses=("decided",),
    sql=" UNION ALL ".join(
        f"SELECT '{table}' AS table_name, application_id, '{name}' AS field, {text} AS value FROM decided"
        for table, columns in WIDE_COLUMNS.items()
        for name, text in columns.items()
    ),
)
def split_wide_event(t: Tables):
    """Every table's fields as (field, value) rows; fractions in thousandths, so that both engines print alike."""
    frames = []
    for table, part in ops.split_wide_event(t.decided).items():
        values = [
            F.struct(
                F.lit(name).alias("field"),
                (F.round(F.col(name) * 1000).cast("bigint") if name in ("risk_score", "approval_probability") else F.col(name))
                .cast("string")
                .alias("value"),
            )
            for name in WIDE_COLUMNS[table]
        ]
        frames.append(part.select(F.lit(table).alias("table_name"), "application_id", F.inline(F.array(*values))))
    return ops.union_frames(frames)
