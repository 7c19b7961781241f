"""Cleaning and imputation of the application feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.functions import bands
from creditlens.operators.quantiles import filled_medians, group_counts, group_medians, quantile_values
from creditlens.schemas import COERCIONS, NUMERIC_FEATURES
from creditlens.session import staged

# Limits of the cleaning rules.
MAX_AGE = 100
MAX_EMPLOYMENT = 50
CAP_QUANTILE = 0.99


def coerce_numeric(df: DataFrame, types: dict[str, str] = COERCIONS) -> DataFrame:
    """Text columns to numbers; what is no number becomes null."""
    # By way of double, so that "42.00" is a valid whole number.
    return df.withColumns(
        {name: F.col(name).try_cast("double").try_cast(kind) for name, kind in types.items() if name in df.columns}
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Exact copies collapse before the shuffle, so many copies of a row cost nothing there."""
    return df.dropDuplicates()


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and copies in one pass over one shuffle."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("total_records"), F.count(F.lit(1)).alias("unique_records"))
        .withColumn("duplicate_records", F.col("total_records") - F.col("unique_records"))
    )


def cap(column: str, limit) -> Column:
    """Upper limit that leaves nulls null."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    return F.when(F.col(column) > limit, limit).otherwise(F.col(column)).alias(column)


def floor_at_zero(column: str) -> Column:
    return F.when(F.col(column) < 0, F.lit(0)).otherwise(F.col(column)).alias(column)


def cap_constants(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"person_age": cap("person_age", MAX_AGE), "person_emp_length": cap("person_emp_length", MAX_EMPLOYMENT)}
    )


def floor_amounts(df: DataFrame) -> DataFrame:
    return df.withColumns({name: floor_at_zero(name) for name in ("person_income", "loan_amnt")})


def amount_caps(df: DataFrame, method: str = "exact") -> dict[str, float | None]:
    """The 99th percentiles of income and loan."""
    found = quantile_values(df, {"person_income": [CAP_QUANTILE], "loan_amnt": [CAP_QUANTILE]}, method)
    return {name: values[CAP_QUANTILE] for name, values in found.items()}


def cap_amounts(df: DataFrame, method: str = "exact") -> DataFrame:
    """Cap income and loan at their own 99th percentile."""
    return df.withColumns({name: cap(name, limit) for name, limit in amount_caps(df, method).items()})


def fill_with_group_medians(df: DataFrame, series: dict[str, tuple[list[Column], str]], medians: DataFrame) -> DataFrame:
    """Fill nulls with the median of the row's group, for each series of ``group_counts``.

    A row whose group is null has no median to take.
    """
    found = df
    for name, (groups, column) in series.items():
        own = medians.where(F.col("series") == name).select(F.col("group").alias(f"__{name}"), F.col("median").alias(f"__{name}_median"))
        key = F.array(*[g.cast("string") for g in groups])
        # As a column: equality of lists takes nulls inside for equal, and null groups are not among the medians.
        found = found.withColumn(f"__{name}_key", key).join(own, F.col(f"__{name}_key") == F.col(f"__{name}"), "left")
    filled = {column: F.coalesce(F.col(column), F.col(f"__{name}_median")) for name, (_, column) in series.items()}
    return found.withColumns(filled).select(*df.columns)


def fill_with_group_median(df: DataFrame, column: str, groups: list[Column]) -> DataFrame:
    """Fill nulls of one column with the median of the row's group; the medians are one row per group."""
    series = {"own": (groups, column)}
    return fill_with_group_medians(df, series, group_medians(group_counts(df, series)))


def fill_with_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill nulls of columns by the median of the whole column."""
    medians = quantile_values(df, {name: [0.5] for name in columns})
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(medians[name][0.5])) for name in columns})


def impute_rate_by_grade(df: DataFrame) -> DataFrame:
    return fill_with_group_median(df, "loan_int_rate", [F.col("loan_grade")])


def impute_employment_by_age(df: DataFrame) -> DataFrame:
    return fill_with_group_median(
        df, "person_emp_length", [bands.age_group_open(F.col("person_age"), bands.AGE_RANGES)]
    )


def income_quartile(df: DataFrame, labels=bands.QUARTILE_CODES, **options) -> Column:
    """Quartile label of income by the frame's own interpolated quartiles."""
    cuts = quantile_values(df, {"person_income": [0.25, 0.5, 0.75]})["person_income"]
    return bands.quartile_label(F.col("person_income"), cuts[0.25], cuts[0.5], cuts[0.75], labels, **options)


def impute_rate_stratified(df: DataFrame) -> DataFrame:
    """Fill rates by grade and income quartile, then by the median of the filled column."""
    grouped = fill_with_group_median(df, "loan_int_rate", [F.col("loan_grade"), income_quartile(df)])
    return fill_with_median(grouped, ["loan_int_rate"])


def impute_all_median(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Fill every numeric column with its own median, exact for amounts too."""
    medians = quantile_values(df, {name: [0.5] for name in columns})
    return df.withColumns(
        {name: F.coalesce(F.col(name).cast("double"), F.lit(medians[name][0.5])) for name in columns}
    )


def clean_job(df: DataFrame, method: str = "exact") -> DataFrame:
    """The ingestion job: employment is capped before it is imputed.

    The de-duplicated feed is written once, since caps and medians need passes of their
    own. Both medians come from one count by group.
    """
    base = floor_amounts(cap_constants(staged(drop_duplicates(df), "deduplicated")))
    series = {
        "rate": ([F.col("loan_grade")], "loan_int_rate"),
        "employment": ([bands.age_group_open(F.col("person_age"), bands.AGE_RANGES)], "person_emp_length"),
    }
    medians = group_medians(group_counts(base, series))
    return fill_with_group_medians(cap_amounts(base, method), series, medians)


def clean_script(df: DataFrame) -> DataFrame:
    """The cleaning script: employment is imputed first and capped afterwards."""
    distinct = staged(drop_duplicates(df), "deduplicated")
    floored = floor_amounts(distinct.withColumn("person_age", cap("person_age", MAX_AGE)))
    # Caps and quartiles in one pass: a cap from above moves a quartile only if that is above the cap.
    found = quantile_values(floored, {"person_income": [0.25, 0.5, 0.75, CAP_QUANTILE], "loan_amnt": [CAP_QUANTILE]})
    limits = {name: values[CAP_QUANTILE] for name, values in found.items()}
    capped = floored.withColumns({name: cap(name, limit) for name, limit in limits.items()})
    cuts = [found["person_income"][p] for p in (0.25, 0.5, 0.75)]
    cuts = [cut if cut is None else min(cut, limits["person_income"]) for cut in cuts]
    quartile = bands.quartile_label(F.col("person_income"), *cuts, bands.QUARTILE_CODES)
    series = {
        "rate": ([F.col("loan_grade"), quartile], "loan_int_rate"),
        "employment": ([bands.age_group_closed(F.col("person_age"), bands.AGE_RANGES)], "person_emp_length"),
    }
    # Medians by group, and those of the columns they have filled, from one count.
    counts = group_counts(capped, series)
    medians = group_medians(counts)
    overall = filled_medians(counts, medians)
    filled = fill_with_group_medians(capped, series, medians)
    filled = filled.withColumns({column: F.coalesce(F.col(column), F.lit(overall.get(name))) for name, (_, column) in series.items()})
    return filled.withColumn("person_emp_length", cap("person_emp_length", MAX_EMPLOYMENT))


def clean_stats(df: DataFrame) -> DataFrame:
    """Rows each rule touches, as (rule, rows)."""
    before = df.count()
    distinct = staged(drop_duplicates(df), "deduplicated")
    limits = amount_caps(floor_amounts(distinct))
    hits = distinct.agg(
        F.count(F.lit(1)).alias("rows_after_dedup"),
        F.count_if(F.col("person_age") > MAX_AGE).alias("age_capped"),
        F.count_if(F.col("person_income") < 0).alias("negative_income_fixed"),
        F.count_if(F.col("person_income") > limits["person_income"]).alias("income_capped"),
        F.count_if(F.col("loan_amnt") < 0).alias("negative_loans_fixed"),
        F.count_if(F.col("loan_amnt") > limits["loan_amnt"]).alias("loan_capped"),
        F.count_if(F.col("person_emp_length") > MAX_EMPLOYMENT).alias("employment_capped"),
        F.count_if(F.col("person_emp_length").cast("string").contains("123")).alias("emp_length_impossible"),
        F.count_if(F.col("loan_int_rate").isNull()).alias("interest_rates_missing"),
        F.count_if(F.col("person_emp_length").isNull()).alias("employment_missing"),
    )
    wide = hits.withColumn("duplicates_removed", F.lit(before) - F.col("rows_after_dedup"))
    return as_rows(wide, "rule", "rows")


def as_rows(wide: DataFrame, name: str, value: str) -> DataFrame:
    """A one-row frame as (name, value) rows."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in wide.columns]
    return wide.select(F.inline(F.array(*pairs)))
