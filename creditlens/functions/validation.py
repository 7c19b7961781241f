"""Checks on one application, each giving a list of messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditlens.schemas import (
    DEFAULT_FLAGS,
    HOME_OWNERSHIP,
    LOAN_GRADES,
    LOAN_INTENTS,
    REQUIRED_FIELDS,
    SCORING_REQUIRED_FIELDS,
)

# Ranges at submission, with the bounds as the message prints them.
SUBMISSION_RANGES = [
    ("person_age", 18, 100, "18 and 100"),
    ("person_income", 0, 10000000, "0 and 10,000,000"),
    ("loan_amnt", 1000, 500000, "1,000 and 500,000"),
    ("loan_int_rate", 0, 50, "0 and 50"),
    ("person_emp_length", 0, 50, "0 and 50"),
]
SUBMISSION_DOMAINS = [
    ("person_home_ownership", HOME_OWNERSHIP),
    ("loan_intent", LOAN_INTENTS),
    ("loan_grade", LOAN_GRADES),
]

# Ranges and domains at scoring time.
SCORING_RANGES = [
    ("person_age", 18, 100),
    ("person_income", 0, 1000000),
    ("loan_amnt", 0, 1000000),
    ("loan_int_rate", 0, 50),
    ("person_emp_length", 0, 50),
]
SCORING_DOMAINS = [
    ("person_home_ownership", HOME_OWNERSHIP),
    ("loan_intent", LOAN_INTENTS),
    ("loan_grade", LOAN_GRADES),
    ("cb_person_default_on_file", DEFAULT_FLAGS),
]


EMPTY = "''"


def text(value: str) -> str:
    """A string literal of an SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(name: str) -> str:
    return f"try_cast({name} AS double)"


def messages(checks: list[str]) -> Column:
    """The messages that apply, in order; each check is an expression of a message or null."""
    # Null checks become empty texts: unlike array_compact, array_remove is compiled.
    return F.expr(f"array_remove(array({', '.join(f'coalesce({check}, {EMPTY})' for check in checks)}), {EMPTY})")


def _required(fields: list[str]) -> list[str]:
    return [f"CASE WHEN {name} IS NULL THEN {text(f'Missing required field: {name}')} END" for name in fields]


def required_errors(fields: list[str] = REQUIRED_FIELDS) -> Column:
    return messages(_required(fields))


def type_errors() -> Column:
    """Type, range and domain checks at submission."""
    ranges = [
        f"CASE WHEN {number(name)} IS NULL THEN {text(f'{name} must be a valid number')} "
        f"WHEN {number(name)} NOT BETWEEN {low} AND {high} THEN {text(f'{name} must be between {bounds}')} END"
        for name, low, high, bounds in SUBMISSION_RANGES
    ]
    domains = [
        f"CASE WHEN {name} IS NULL OR {name} NOT IN ({', '.join(map(text, allowed))}) "
        f"THEN {text(f'{name} must be one of: {allowed}')} END"
        for name, allowed in SUBMISSION_DOMAINS
    ]
    return messages([*ranges, *domains])


def scoring_errors() -> Column:
    """Checks before scoring; a null counts as a missing field."""
    ranges = [
        f"CASE WHEN {name} IS NOT NULL AND {number(name)} IS NULL THEN {text(f'Field {name} must be numeric')} "
        f"WHEN {number(name)} NOT BETWEEN {low} AND {high} "
        f"THEN {text(f'Field {name} out of range [{low}, {high}]')} END"
        for name, low, high in SCORING_RANGES
    ]
    domains = [
        f"CASE WHEN {name} NOT IN ({', '.join(map(text, allowed))}) "
        f"THEN concat({text(f'Field {name} has invalid value: ')}, {name}) END"
        for name, allowed in SCORING_DOMAINS
    ]
    return messages([*_required(SCORING_REQUIRED_FIELDS), *ranges, *domains])
