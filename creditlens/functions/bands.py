"""Bands, flags and codes derived from one application."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditlens.functions.scoring import lookup

# Codes and labels.
GRADE_ASCENDING = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7}
GRADE_DESCENDING = {"A": 7, "B": 6, "C": 5, "D": 4, "E": 3, "F": 2, "G": 1}
GRADE_GROUPS = {
    "A": "LowRisk",
    "B": "LowRisk",
    "C": "MediumRisk",
    "D": "MediumRisk",
    "E": "HighRisk",
    "F": "HighRisk",
    "G": "HighRisk",
}
AGE_NAMES = ("Young", "Adult", "Middle", "Senior")
AGE_RANGES = ("18-25", "26-35", "36-45", "45+")
QUARTILE_NAMES = ("Low", "Medium", "High", "VeryHigh")
QUARTILE_CODES = ("Q1", "Q2", "Q3", "Q4")


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0 (null included)."""
    return F.when(condition, 1).otherwise(0)


def age_group_open(age: Column, labels=AGE_NAMES) -> Column:
    """Every age falls in a group; the last one is open and takes nulls too."""
    return F.when(age <= 25, labels[0]).when(age <= 35, labels[1]).when(age <= 45, labels[2]).otherwise(labels[3])


def age_group_closed(age: Column, labels=AGE_NAMES) -> Column:
    """Right-closed bins on (0, 100]; ages outside have no group."""
    return (
        F.when((age > 0) & (age <= 25), labels[0])
        .when((age > 25) & (age <= 35), labels[1])
        .when((age > 35) & (age <= 45), labels[2])
        .when((age > 45) & (age <= 100), labels[3])
    )


def quartile_label(value: Column, q1: Column, q2: Column, q3: Column, labels=QUARTILE_NAMES, null_last=False) -> Column:
    """Right-closed quartile label; nulls get none, or the last label when asked."""
    low = F.when(value <= q1, labels[0]).when(value <= q2, labels[1]).when(value <= q3, labels[2])
    return low.otherwise(labels[3]) if null_last else low.when(value > q3, labels[3])


def income_band(income: Column) -> Column:
    """Fixed income bands of online scoring, right-closed on (0, 1,000,000]."""
    return (
        F.when((income > 0) & (income <= 25000), "Low")
        .when((income > 25000) & (income <= 50000), "Medium")
        .when((income > 50000) & (income <= 75000), "High")
        .when((income > 75000) & (income <= 1000000), "VeryHigh")
    )


def years_of_adulthood(age: Column) -> Column:
    return (age - 18).cast("double")


def employment_stability(floor_years: bool = False) -> Column:
    """Share of adult years in employment; at age 18 null, or over one year when floored."""
    years = years_of_adulthood(F.col("person_age"))
    if floor_years:
        years = F.when(years < 1, F.lit(1.0)).otherwise(years)
    return F.try_divide(F.col("person_emp_length"), years)


def income_to_loan(floor_loan: bool = False) -> Column:
    """Income over loan; a zero loan gives null, or counts as one when floored."""
    loan = F.col("loan_amnt").cast("double")
    if floor_loan:
        loan = F.when(loan < 1, F.lit(1.0)).otherwise(loan)
    return F.try_divide(F.col("person_income"), loan)


def grade_group_open(grade: Column) -> Column:
    """A and B, C and D, and everything else."""
    return F.when(grade.isin("A", "B"), "LowRisk").when(grade.isin("C", "D"), "MediumRisk").otherwise("HighRisk")


def grade_group_closed(grade: Column) -> Column:
    """Known grades only."""
    return lookup(grade, GRADE_GROUPS)


def loan_size(loan: Column) -> Column:
    return (
        F.when(loan <= 5000, "Small").when(loan <= 15000, "Medium").when(loan <= 25000, "Large").otherwise("VeryLarge")
    )


def rate_band(rate: Column) -> Column:
    return F.when(rate <= 10, "Low").when(rate <= 15, "Medium").otherwise("High")
