"""Joins, updates, deletes and change capture over the application tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions.scoring import cache_key
from creditlens.schemas import DECISIONS, HOME_OWNERSHIP, LOAN_GRADES, LOAN_INTENTS, RISK_CATEGORIES, STATUSES

KEY = "application_id"


def application_summary(applications: DataFrame, scores: DataFrame, decisions: DataFrame) -> DataFrame:
    """Applications with scores and decisions; several scores give several rows."""
    return (
        applications.join(scores.select(KEY, "risk_score", "risk_category", "model_version"), KEY, "left")
        .join(decisions.select(KEY, "decision", "decision_reason", "underwriter_id"), KEY, "left")
    )


def with_application(facts: DataFrame, applications: DataFrame, columns: list[str]) -> DataFrame:
    """Facts with some columns of their application."""
    return facts.join(applications.select(KEY, *columns), KEY)


def newest(df: DataFrame, time: str, tie: str, limit: int | None = None, ascending: bool = False) -> DataFrame:
    """Newest rows first (or oldest), the id breaking ties so that a limit is repeatable."""
    order = [F.col(time).asc() if ascending else F.col(time).desc(), F.col(tie)]
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def latest_per_key(df: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """One row per key, the newest; the rest of the rows never leave their task.

    A maximum aggregates on the map side, so a key with very many rows sends one
    row per task. A window would move all of them to one place.
    """
    others = [name for name in df.columns if name != key]
    newest_row = F.max_by(F.struct(*others), F.struct(time, tie))
    return df.groupBy(key).agg(newest_row.alias("row")).select(key, "row.*")


def orphans(child: DataFrame, parent: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is set and missing in the parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def delete_cascade(
    applications: DataFrame, scores: DataFrame, decisions: DataFrame, audit: DataFrame, deleted: DataFrame
) -> dict[str, DataFrame]:
    """Remove applications with their scores and decisions; audit rows keep a null key."""
    gone = deleted.select(KEY).distinct()
    marked = audit.join(gone.withColumn("__gone", F.lit(True)), KEY, "left")
    detached = marked.withColumn(KEY, F.when(F.col("__gone").isNull(), F.col(KEY))).select(*audit.columns)
    return {
        "applications": applications.join(gone, KEY, "left_anti"),
        "risk_scores": scores.join(gone, KEY, "left_anti"),
        "decisions": decisions.join(gone, KEY, "left_anti"),
        "audit_logs": detached,
    }


def apply_updates(
    base: DataFrame, changes: DataFrame, key: str, columns: list[str], changed_at: str, stamp: str, as_of: Column
) -> DataFrame:
    """Set columns from the latest change per key and stamp the rows that changed."""
    fields = F.struct(*[F.col(c) for c in columns])
    latest = changes.groupBy(key).agg(F.max_by(fields, F.struct(changed_at, *columns)).alias("__new"))
    joined = base.join(latest, key, "left")
    return joined.withColumns(
        {
            **{c: F.coalesce(F.col("__new")[c], F.col(c)) for c in columns},
            stamp: F.when(F.col("__new").isNotNull(), as_of).otherwise(F.col(stamp)),
        }
    ).select(*base.columns)


def audit_diff(old: DataFrame, new: DataFrame, key: str, entity: str) -> DataFrame:
    """INSERT, UPDATE and DELETE rows that lead from one snapshot to the next."""
    columns = [name for name in old.columns if name != key]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(key, *columns).alias(name))

    joined = side(old, "old").join(side(new, "new"), key, "full_outer")
    action = F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "DELETE").otherwise("UPDATE")

    def text(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.to_json(F.col(name), {"ignoreNullFields": "false"}))

    return joined.where(~F.col("old").eqNullSafe(F.col("new"))).select(
        action.alias("action"),
        F.lit(entity).alias("entity_type"),
        F.col(key).cast("string").alias("entity_id"),
        text("old").alias("old_value"),
        text("new").alias("new_value"),
    )


def apply_defaults(df: DataFrame, as_of: str) -> DataFrame:
    """Defaults of the applications table."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return df.withColumns(
        {
            "status": F.coalesce(F.col("status"), F.lit("PENDING")),
            "created_at": F.coalesce(F.col("created_at"), now),
            "updated_at": F.coalesce(F.col("updated_at"), now) if "updated_at" in df.columns else now,
        }
    )


def _check(name: str, holds: Column) -> Column:
    """A CHECK fails only when it is false; null passes."""
    return F.when(~holds, F.lit(name))


def application_violations(df: DataFrame) -> DataFrame:
    """(row, constraint) for every broken NOT NULL and CHECK of an application."""
    required = [c for c in df.columns if c not in (KEY, "created_at", "updated_at", "status")]
    rules = [
        *[F.when(F.col(c).isNull(), F.lit(f"{c}_not_null")) for c in required],
        _check("person_age_check", F.col("person_age").between(18, 100)),
        _check("person_income_check", F.col("person_income") >= 0),
        _check("person_home_ownership_check", F.col("person_home_ownership").isin(HOME_OWNERSHIP)),
        _check("person_emp_length_check", F.col("person_emp_length").between(0, 50)),
        _check("loan_intent_check", F.col("loan_intent").isin(LOAN_INTENTS)),
        _check("loan_grade_check", F.col("loan_grade").isin(LOAN_GRADES)),
        _check("loan_amnt_check", F.col("loan_amnt") >= 0),
        _check("loan_int_rate_check", F.col("loan_int_rate").between(0, 50)),
        _check("loan_percent_income_check", F.col("loan_percent_income").between(0, 1)),
        _check("cb_person_default_on_file_check", F.col("cb_person_default_on_file").isin("Y", "N")),
        _check("cb_person_cred_hist_length_check", F.col("cb_person_cred_hist_length") >= 0),
    ]
    if "status" in df.columns:
        rules.append(_check("status_check", F.col("status").isin(STATUSES)))
    return df.select(KEY, F.explode(F.array_compact(F.array(*rules))).alias("constraint_name"))


def score_violations(df: DataFrame) -> DataFrame:
    rules = [
        _check("risk_score_check", F.col("risk_score").between(0, 1)),
        _check("risk_category_check", F.col("risk_category").isin(RISK_CATEGORIES)),
        _check("confidence_score_check", F.col("confidence_score").between(0, 1)),
    ]
    return df.select(KEY, F.explode(F.array_compact(F.array(*rules))).alias("constraint_name"))


def decision_violations(df: DataFrame) -> DataFrame:
    rules = [_check("decision_check", F.col("decision").isin(DECISIONS))]
    return df.select(KEY, F.explode(F.array_compact(F.array(*rules))).alias("constraint_name"))


def align_features(df: DataFrame, features: list[str], keep: list[str] = ()) -> DataFrame:
    """Exactly the wanted columns in order; missing ones and nulls become 0."""
    present = set(df.columns)
    return df.select(
        *keep,
        *[
            (F.coalesce(F.col(name), F.lit(0)) if name in present else F.lit(0)).cast("double").alias(name)
            for name in features
        ],
    )


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column one of them lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


# Names of cached fields and of their table columns.
CACHED_NAMES = {
    "applicationId": "application_id",
    "personAge": "person_age",
    "personIncome": "person_income",
    "loanAmount": "loan_amnt",
    "loanGrade": "loan_grade",
    "createdAt": "created_at",
}


def from_cache_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(CACHED_NAMES)


def epoch(as_of: str) -> Column:
    return F.unix_timestamp(F.lit(as_of).cast("timestamp"))


def alive(cache: DataFrame, as_of: str) -> DataFrame:
    return cache.where(F.col("ttl") > epoch(as_of))


def cache_lookup(applications: DataFrame, cache: DataFrame, fallback: Column, as_of: str) -> DataFrame:
    """The cached score of each application while it lives, else the fallback."""
    live = alive(cache, as_of).select(
        "cache_key", F.col("risk_score").alias("cached_score"), F.col("model_version").alias("cached_version")
    )
    keyed = applications.withColumn("cache_key", cache_key())
    return keyed.join(live, "cache_key", "left").withColumns(
        {
            "cache_hit": F.col("cached_score").isNotNull(),
            "risk_score": F.coalesce(F.col("cached_score"), fallback),
        }
    )


def cache_rows(scored: DataFrame, as_of: str, ttl_hours: int = 168) -> DataFrame:
    """Cache entries of scored applications, one per feature set."""
    return (
        scored.groupBy(cache_key().alias("cache_key"))
        .agg(F.max("risk_score").alias("risk_score"), F.max("risk_category").alias("risk_category"))
        .select(
            "cache_key",
            "risk_score",
            "risk_category",
            F.lit("1.1").alias("model_version"),
            (epoch(as_of) + ttl_hours * 3600).alias("ttl"),
        )
    )


def cache_merge(cache: DataFrame, written: DataFrame, as_of: str) -> DataFrame:
    """The cache after a batch of writes: later writes win, expired entries go."""
    both = cache.withColumn("__at", F.lit(0)).unionByName(written.withColumn("__at", F.lit(1)))
    merged = latest_per_key(both, "cache_key", "__at", "ttl")
    return alive(merged.select(*cache.columns), as_of)


def extend_ttl(cache: DataFrame, chosen: Column, as_of: str, hours: int) -> DataFrame:
    return cache.withColumn("ttl", F.when(chosen, epoch(as_of) + hours * 3600).otherwise(F.col("ttl")))


def query_items(df: DataFrame, condition: Column, order: list[str], limit: int | None = None) -> DataFrame:
    """Keyed query or filtered scan; only a limit needs an order, to be repeatable."""
    hits = df.where(condition)
    return hits if limit is None else hits.orderBy(*order).limit(limit)


def put_items(stored: DataFrame, items: DataFrame, key: str, version: str) -> DataFrame:
    """Stored items after a batch of puts: the highest version per key stays."""
    return latest_per_key(stored.unionByName(items), key, version, version)


def split_wide_event(df: DataFrame, model_version: str = "ensemble-v1.0") -> dict[str, DataFrame]:
    """The three table rows of a processed application event."""
    from creditlens.functions import scoring
    from creditlens.schemas import REQUIRED_FIELDS

    features_used = F.to_json(F.struct(*REQUIRED_FIELDS), {"ignoreNullFields": "false"})
    return {
        "applications": df.select(
            KEY,
            *REQUIRED_FIELDS,
            scoring.table_status(scoring.final_status(F.col("decision"))).alias("status"),
            "created_at",
        ),
        "risk_scores": df.select(
            KEY,
            "risk_score",
            F.col("risk_level").alias("risk_category"),
            F.lit(model_version).alias("model_version"),
            features_used.alias("features_used"),
            F.col("created_at").alias("prediction_timestamp"),
        ),
        "decisions": df.select(
            KEY,
            scoring.table_decision(F.col("decision")).alias("decision"),
            "decision_reason",
            "risk_score",
            "approval_probability",
            "risk_level",
            F.lit("system").alias("decision_made_by"),
            F.col("created_at").alias("decision_timestamp"),
        ),
    }


