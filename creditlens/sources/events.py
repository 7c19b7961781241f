"""The event envelope of the application flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Envelope fields and the steps of the flow.
SOURCE = "credit-risk-platform"
BUS = "default"
VALIDATED, SCORED, DECIDED, PROCESSED = (
    "application.validated",
    "risk.scored",
    "decision.made",
    "application.processed",
)


def to_events(df: DataFrame, detail_type: str) -> DataFrame:
    """Rows as events with a JSON payload."""
    return df.select(
        F.lit(SOURCE).alias("Source"),
        F.lit(detail_type).alias("DetailType"),
        F.to_json(F.struct(*df.columns)).alias("Detail"),
        F.lit(BUS).alias("EventBusName"),
    )


def from_events(events: DataFrame, schema: str, detail_type: str | None = None) -> DataFrame:
    """Payloads of events, of one type when given, back as rows."""
    chosen = events if detail_type is None else events.where(F.col("DetailType") == detail_type)
    return chosen.select(F.from_json("Detail", schema).alias("d")).select("d.*")
