"""The events of one application brought together: submitted, scored, decided.

Two stream-stream joins under watermarks. An event matches when it comes within its time
after the submission; Spark then knows when a submission can no longer be matched, gives
it out with nulls and forgets it, so state holds the last days and not the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORED_WITHIN = "2 days"
DECIDED_WITHIN = "3 days"
DELAY = "1 day"


def _event(stream: DataFrame, time: str, name: str, columns: dict[str, str], delay: str) -> DataFrame:
    picked = {alias: F.col(column) for alias, column in columns.items()}
    timed = stream.select(
        F.col("application_id").alias(f"{name}_id"), F.col(time).cast("timestamp").alias(f"{name}_at"), *[c.alias(a) for a, c in picked.items()]
    )
    return timed.withWatermark(f"{name}_at", delay)


def correlated(
    submitted: DataFrame,
    scored: DataFrame,
    decided: DataFrame,
    scored_within: str = SCORED_WITHIN,
    decided_within: str = DECIDED_WITHIN,
    delay: str = DELAY,
) -> DataFrame:
    """Every submission with its score and decision, or nulls for those that never came in time.

    ``submitted`` has application_id and created_at; ``scored`` application_id,
    prediction_timestamp and risk_score; ``decided`` application_id, decision_timestamp and
    decision. An event before its submission matches nothing. Two scores make two rows.
    """
    first = _event(submitted, "created_at", "submitted", {}, delay)
    second = _event(scored, "prediction_timestamp", "scored", {"risk_score": "risk_score"}, delay)
    third = _event(decided, "decision_timestamp", "decided", {"decision": "decision"}, delay)

    def within(name: str, limit: str) -> Column:
        end = F.col("submitted_at") + F.expr(f"INTERVAL {limit}")
        return (F.col("submitted_id") == F.col(f"{name}_id")) & F.col(f"{name}_at").between(F.col("submitted_at"), end)

    def plain(time: str) -> Column:
        """The time of another event as a value: a stream has one event time, that of the submission."""
        return F.timestamp_micros(F.unix_micros(time)).alias(time)

    joined = first.join(second, within("scored", scored_within), "left_outer")
    joined = joined.select("submitted_id", "submitted_at", "scored_id", plain("scored_at"), "risk_score")
    joined = joined.join(third, within("decided", decided_within), "left_outer")
    outcome = (
        F.when(F.col("scored_id").isNull() & F.col("decided_id").isNull(), "LOST")
        .when(F.col("scored_id").isNull(), "DECIDED_UNSCORED")
        .when(F.col("decided_id").isNull(), "AWAITING_DECISION")
        .otherwise("COMPLETE")
    )
    return joined.select(
        F.col("submitted_id").alias("application_id"),
        "submitted_at",
        "scored_at",
        "risk_score",
        plain("decided_at"),
        "decision",
        outcome.alias("outcome"),
    )
