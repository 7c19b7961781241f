"""Rule score, loan decision and the texts that go with them."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rule score, its terms in the order they are added.
RULE_SCORE = """
  0.5D
  + CASE WHEN cb_person_default_on_file = 'Y' THEN 0.3D ELSE 0D END
  + CASE WHEN loan_percent_income > 0.3D THEN 0.2D ELSE 0D END
  + CASE WHEN cb_person_cred_hist_length < 2 THEN 0.15D ELSE 0D END
  + CASE WHEN person_emp_length < 2 THEN 0.1D ELSE 0D END
  + CASE WHEN person_income < 30000 THEN 0.1D ELSE 0D END
  + CASE loan_grade WHEN 'A' THEN -0.2D WHEN 'B' THEN -0.1D WHEN 'C' THEN 0D WHEN 'D' THEN 0.1D
      WHEN 'E' THEN 0.2D WHEN 'F' THEN 0.3D WHEN 'G' THEN 0.4D ELSE 0.1D END
"""

# Override rules in order of precedence (label, condition, new
# decision). A missing amount or history counts as 0, which only matters where
# small values are let through.
OVERRIDE_RULES = [
    ("R1a", "person_income > 150000 AND base_decision = 'AUTO_REJECT' AND risk_score < 0.8D", "MANUAL_REVIEW"),
    ("R1b", "person_income > 150000 AND base_decision = 'MANUAL_REVIEW' AND risk_score < 0.5D", "AUTO_APPROVE"),
    ("R2", "coalesce(loan_amnt, 0) < 5000 AND base_decision = 'AUTO_REJECT' AND risk_score < 0.8D", "MANUAL_REVIEW"),
    ("R3a", "loan_amnt > 100000 AND base_decision = 'AUTO_APPROVE' AND risk_score > 0.25D", "MANUAL_REVIEW"),
    ("R3b", "loan_amnt > 100000 AND base_decision = 'MANUAL_REVIEW' AND risk_score > 0.6D", "AUTO_REJECT"),
    ("R4", "person_emp_length > 10 AND base_decision = 'MANUAL_REVIEW' AND risk_score < 0.4D", "AUTO_APPROVE"),
    ("R5a", "cb_person_default_on_file = 'Y' AND base_decision = 'AUTO_APPROVE'", "MANUAL_REVIEW"),
    ("R5b", "cb_person_default_on_file = 'Y' AND base_decision <> 'AUTO_APPROVE' AND risk_score > 0.6D", "AUTO_REJECT"),
    ("R6", "coalesce(cb_person_cred_hist_length, 0) < 1 AND base_decision = 'AUTO_APPROVE'", "MANUAL_REVIEW"),
    ("R7a", "loan_percent_income > 0.4D AND base_decision = 'AUTO_APPROVE'", "MANUAL_REVIEW"),
    ("R7b", "loan_percent_income > 0.4D AND base_decision = 'MANUAL_REVIEW' AND risk_score > 0.5D", "AUTO_REJECT"),
]

# Approval probability per decision.
APPROVAL_PROBABILITY = {"AUTO_APPROVE": 0.95, "MANUAL_REVIEW": 0.6, "AUTO_REJECT": 0.05}


def literal_map(values: dict) -> Column:
    """A constant lookup map."""
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def lookup(column: Column, values: dict, default=None) -> Column:
    """The mapped value of a column; unknown and null give the default."""
    found = F.element_at(literal_map(values), column)
    return found if default is None else F.coalesce(found, F.lit(default))


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Limit a value that is set to a range; names the value once, so plans stay small."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def rule_score() -> Column:
    """Risk from the stated facts alone, for when no model answers.

    The terms are doubles and summed left to right, since results are compared
    with 0.3, 0.6 and 0.7 and another order moves the last bit.
    """
    return F.expr(f"greatest(0D, least(1D, {RULE_SCORE}))")


def score_or_fallback(model_score: Column) -> Column:
    """The model's score held to 0..1, or the rule score where the model gave none."""
    # greatest and least pass over nulls, so a missing model score is set aside first.
    return F.when(model_score.isNotNull(), clamp(model_score)).otherwise(rule_score())


def risk_level(risk: Column) -> Column:
    """Level as the decision step names it: 0.7 is still MEDIUM."""
    return F.when(risk < 0.3, "LOW").when(risk <= 0.7, "MEDIUM").otherwise("HIGH")


def risk_level_inference(risk: Column) -> Column:
    """Level as the inference output names it: 0.7 is already HIGH."""
    return F.when(risk < 0.3, "LOW").when(risk < 0.7, "MEDIUM").otherwise("HIGH")


def base_decision(risk: Column) -> Column:
    return F.when(risk < 0.3, "AUTO_APPROVE").when(risk <= 0.7, "MANUAL_REVIEW").otherwise("AUTO_REJECT")


def decision_reason(risk: Column) -> Column:
    shown = F.format_string("%.3f", risk)
    return (
        F.when(risk < 0.3, F.concat(F.lit("Low risk score ("), shown, F.lit(") indicates high creditworthiness")))
        .when(
            risk <= 0.7,
            F.concat(F.lit("Medium risk score ("), shown, F.lit(") requires manual underwriting review")),
        )
        .otherwise(
            F.concat(F.lit("High risk score ("), shown, F.lit(") indicates significant default risk"))
        )
    )


def rule_fired() -> Column:
    """Label of the first override that holds on base_decision and risk_score, null when none does."""
    branches = " ".join(f"WHEN {condition} THEN '{label}'" for label, condition, _ in OVERRIDE_RULES)
    return F.expr(f"CASE {branches} END")


def final_decision() -> Column:
    """What the rule that fired decides, else the base decision."""
    branches = " ".join(f"WHEN '{label}' THEN '{outcome}'" for label, _, outcome in OVERRIDE_RULES)
    return F.expr(f"CASE rule_fired {branches} ELSE base_decision END")


def approval_probability(decision: Column) -> Column:
    return lookup(decision, APPROVAL_PROBABILITY)


def final_status(decision: Column) -> Column:
    return (
        F.when(decision == "AUTO_APPROVE", "APPROVED")
        .when(decision == "AUTO_REJECT", "REJECTED")
        .otherwise("PENDING_REVIEW")
    )


def table_decision(decision: Column) -> Column:
    """Event decision as the decisions table spells it."""
    return (
        F.when(decision == "AUTO_APPROVE", "APPROVE")
        .when(decision == "AUTO_REJECT", "REJECT")
        .otherwise("MANUAL_REVIEW")
    )


def table_status(status: Column) -> Column:
    """Final status as the applications table spells it."""
    return F.when(status == "PENDING_REVIEW", "MANUAL_REVIEW").otherwise(status)


def money(value: Column) -> Column:
    """Whole currency units with thousands separators, ties to even."""
    return F.format_string("%,.0f", F.rint(F.coalesce(value, F.lit(0.0)).cast("double")))


def decision_summary(decision: Column, risk: Column) -> Column:
    verdict = (
        F.when(decision == "AUTO_APPROVE", " - APPROVED: Low risk (")
        .when(decision == "MANUAL_REVIEW", " - MANUAL REVIEW: Medium risk (")
        .otherwise(" - REJECTED: High risk (")
    )
    return F.concat(
        F.lit("Applicant "),
        F.coalesce(F.col("application_id").cast("string"), F.lit("Unknown")),
        verdict,
        F.format_string("%.3f", risk),
        F.lit("), Income: $"),
        money(F.col("person_income")),
        F.lit(", Loan: $"),
        money(F.col("loan_amnt")),
    )


def processing_summary(decision: Column, risk: Column, status: Column) -> Column:
    return F.concat(
        F.lit("Application "),
        F.coalesce(F.col("application_id").cast("string"), F.lit("Unknown")),
        F.lit(": Decision="),
        decision,
        F.lit(", Risk="),
        F.format_string("%.3f", risk),
        F.lit(", Status="),
        status,
    )


def cache_key() -> Column:
    """Key of a feature set: risk_ and 16 hex digits of an md5 over seven features.

    Numbers pass through decimal(12,2) so that the text, and so the key, does not
    depend on how an engine prints doubles.
    """

    def text(name: str, kind: str | None = None) -> Column:
        value = F.col(name).cast(kind) if kind else F.col(name)
        return F.coalesce(value.cast("string"), F.lit(""))

    joined = F.concat_ws(
        "_",
        text("person_age", "int"),
        text("person_income", "decimal(12,2)"),
        text("person_home_ownership"),
        text("person_emp_length", "decimal(12,2)"),
        text("loan_intent"),
        text("loan_grade"),
        text("loan_amnt", "decimal(12,2)"),
    )
    return F.concat(F.lit("risk_"), F.substring(F.md5(joined), 1, 16))


def _printed(number: Column) -> Column:
    """A number that Spark printed with an exponent, as JSON libraries print it: 1.0E7 is 10000000.0, 1.0E16 is 1e+16."""
    power = F.regexp_extract(number, "E(-?[0-9]+)$", 1).cast("int")

    def plain(kind: str) -> Column:
        return F.regexp_replace(number.cast(kind).cast("string"), "([.][0-9]+?)0+$", "$1")

    digits = F.regexp_replace(F.regexp_extract(number, "^(.*)E", 1), "[.]0$", "")
    size = F.abs(power).cast("string")
    short = F.concat(digits, F.when(power < 0, "e-").otherwise("e+"), F.when(F.abs(power) < 10, F.concat(F.lit("0"), size)).otherwise(size))
    return F.when(power.between(0, 15), plain("decimal(38,10)")).when(power == -4, plain("decimal(38,25)")).otherwise(short)


def request_key(fields: list[str]) -> Column:
    """md5 over the key-sorted JSON of a request."""

    def written(names: list[str]) -> Column:
        return F.to_json(F.struct(*[F.col(name) for name in names]), {"ignoreNullFields": "false"})

    def member(name: str) -> Column:
        own = written([name])
        number = F.regexp_extract(own, '":(-?[0-9.]+E-?[0-9]+)}$', 1)
        return F.when(number != "", F.concat(F.lit(f"{json.dumps(name)}:"), _printed(number))).otherwise(F.substr(own, F.lit(2), F.length(own) - 2))

    body = written(sorted(fields))
    # Few rows have a number beyond 10^7 or below a thousandth; only these are put together by field.
    exact = F.concat(F.lit("{"), F.concat_ws(",", *[member(name) for name in sorted(fields)]), F.lit("}"))
    return F.md5(F.when(body.rlike('":-?[0-9.]+E-?[0-9]+[,}]'), exact).otherwise(body))


def application_code(key: Column) -> Column:
    """APP- and eight hex digits, repeatable for a source key.

    Eight digits are 32 bits, so codes collide on large tables; rows keep their
    source key as identity.
    """
    return F.concat(F.lit("APP-"), F.upper(F.substring(F.md5(key.cast("string")), 1, 8)))
