"""Profiles of a table: overview, distributions, correlations and issues."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlens.operators.quantiles import number, quantile_values
from creditlens.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

# Texts that stand in for a missing value, and warning limits.
MISSING_TEXTS = ["", " ", "NA", "N/A", "null", "NULL", "nan", "NaN"]
HIGH_CARDINALITY = 50
FEW_VALUES = 10
CATEGORY_IMBALANCE = 10
TARGET_IMBALANCE = 3
HIGH_CORRELATION = 0.7

#: Correlations in one aggregate.
PAIRS_AT_ONCE = 7

RECORDS = "*"


def _per_column(wide: DataFrame, columns: list[str], fields) -> DataFrame:
    """Turn a one-row aggregate into one row per column."""
    rows = [F.struct(F.lit(c).alias("column_name"), *fields(c)) for c in columns]
    return wide.select(F.inline(F.array(*rows)))


def text_pairs(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Rows (column_name, value) of text columns, nulls left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(*keep, F.inline(pairs)).where(F.col("value").isNotNull())


def overview(df: DataFrame) -> DataFrame:
    """Type, nulls and share of nulls per column."""
    kinds = dict(df.dtypes)
    wide = df.agg(F.count(RECORDS).alias("#rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _per_column(
        wide,
        df.columns,
        lambda c: [
            F.lit(kinds[c]).alias("data_type"),
            F.col("#rows").alias("total_rows"),
            F.col(c).alias("null_count"),
            F.try_divide(F.col(c) * F.lit(100.0), F.col("#rows")).alias("null_percentage"),
        ],
    )


def missing(df: DataFrame) -> DataFrame:
    """Nulls and stand-in texts as rows (column_name, representation, rows), where any.

    All columns and all texts are counted in one pass without moving rows.
    """
    texts = [c for c, kind in df.dtypes if kind == "string"]
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}#null") for c in df.columns]
    counts += [F.count_if(F.col(c) == text).alias(f"{c}#{i}") for c in texts for i, text in enumerate(MISSING_TEXTS)]
    wide = df.agg(*counts)

    def row(c: str, name: str, shown: str) -> Column:
        return F.struct(
            F.lit(c).alias("column_name"), F.lit(shown).alias("representation"), F.col(name).alias("rows")
        )

    rows = [row(c, f"{c}#null", "<null>") for c in df.columns]
    rows += [row(c, f"{c}#{i}", f"'{text}'") for c in texts for i, text in enumerate(MISSING_TEXTS)]
    return wide.select(F.inline(F.array(*rows))).where(F.col("rows") > 0)


def numeric_text(df: DataFrame) -> DataFrame:
    """Share of numeric values per text column."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    wide = df.agg(
        *[F.count(c).alias(f"{c}#all") for c in texts],
        *[F.count(F.col(c).try_cast("double")).alias(f"{c}#num") for c in texts],
    )
    return _per_column(
        wide,
        texts,
        lambda c: [
            F.col(f"{c}#all").alias("non_null"),
            F.col(f"{c}#num").alias("numeric_values"),
            F.try_divide(F.col(f"{c}#num"), F.col(f"{c}#all")).alias("numeric_share"),
            (F.col(f"{c}#num") == F.col(f"{c}#all")).alias("only_numeric"),
        ],
    )


def describe(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per numeric column."""
    cuts = quantile_values(df, {c: [0.25, 0.5, 0.75] for c in columns})
    wide = df.agg(
        *[
            F.struct(
                F.count(number(c)).alias("count"),
                F.avg(number(c)).alias("mean"),
                F.stddev_samp(number(c)).alias("std"),
                F.min(number(c)).alias("min"),
                F.max(number(c)).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return _per_column(
        wide,
        columns,
        lambda c: [
            *[F.col(c)[part].alias(part) for part in ("count", "mean", "std", "min")],
            *[F.lit(cuts[c][p]).alias(name) for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))],
            F.col(c)["max"].alias("max"),
        ],
    )


def skewness(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    wide = df.agg(*[F.skewness(number(c)).alias(c) for c in columns])
    return _per_column(
        wide,
        columns,
        lambda c: [
            F.col(c).alias("skewness"),
            F.when(F.col(c) > 1, "Right skewed")
            .when(F.col(c) < -1, "Left skewed")
            .otherwise("Approximately normal")
            .alias("label"),
        ],
    )


def kurtosis(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    wide = df.agg(*[F.kurtosis(number(c)).alias(c) for c in columns])
    return _per_column(
        wide,
        columns,
        lambda c: [
            F.col(c).alias("kurtosis"),
            F.when(F.col(c) > 3, "Heavy tails").when(F.col(c) < -1, "Light tails").otherwise("Normal tails").alias("label"),
        ],
    )


def iqr_outliers(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Values outside 1.5 interquartile ranges, with the bounds."""
    cuts = quantile_values(df, {c: [0.25, 0.75] for c in columns})

    def bounds(c: str) -> tuple[Column, Column]:
        low, high = cuts[c][0.25], cuts[c][0.75]
        if low is None:
            return F.lit(None).cast("double"), F.lit(None).cast("double")
        return F.lit(low - 1.5 * (high - low)), F.lit(high + 1.5 * (high - low))

    wide = df.agg(
        F.count(RECORDS).alias("#rows"),
        *[F.count_if((number(c) < bounds(c)[0]) | (number(c) > bounds(c)[1])).alias(c) for c in columns],
    )
    return _per_column(
        wide,
        columns,
        lambda c: [
            F.col(c).alias("outliers"),
            F.try_divide(F.col(c) * F.lit(100.0), F.col("#rows")).alias("outlier_percentage"),
            bounds(c)[0].alias("lower_bound"),
            bounds(c)[1].alias("upper_bound"),
        ],
    )


def value_counts(df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    return text_pairs(df, columns).groupBy("column_name", "value").agg(F.count(RECORDS).alias("rows"))


def top_values(df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES, k: int = 10) -> DataFrame:
    """The k most frequent values per column.

    Spark keeps k rows per task before the window's shuffle, so a column with very
    many values does not meet in one place.
    """
    order = Window.partitionBy("column_name").orderBy(F.col("rows").desc(), "value")
    return value_counts(df, columns).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def cardinality(df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Distinct values per column with the warnings of the profile."""
    counts = value_counts(df, columns).groupBy("column_name").agg(
        F.count(RECORDS).alias("distinct_values"), F.max("rows").alias("most"), F.min("rows").alias("least")
    )
    ratio = F.try_divide(F.col("most"), F.col("least"))
    return counts.select(
        "column_name",
        "distinct_values",
        (F.col("distinct_values") > HIGH_CARDINALITY).alias("high_cardinality"),
        ratio.alias("imbalance_ratio"),
        ((F.col("distinct_values") <= FEW_VALUES) & (ratio > CATEGORY_IMBALANCE)).alias("imbalanced"),
    )


def target_distribution(df: DataFrame, target: str = "loan_status") -> DataFrame:
    """Count and share per class with the imbalance ratio; one row per class."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(RECORDS).alias("rows"))
    everything = Window.partitionBy(F.lit(0))
    ratio = F.try_divide(F.max("rows").over(everything), F.min("rows").over(everything))
    return counts.select(
        target,
        "rows",
        F.try_divide(F.col("rows") * F.lit(100.0), F.sum("rows").over(everything)).alias("percentage"),
        ratio.alias("imbalance_ratio"),
        (ratio > TARGET_IMBALANCE).alias("imbalanced"),
    )


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, over the rows where both are set.

    Aggregated wide, ``PAIRS_AT_ONCE`` pairs at a time so that the generated code stays
    small enough to be compiled to machine code; only the sums of a task are shuffled,
    and one row per group of pairs is turned into rows.
    """
    pairs = list(combinations(columns, 2))
    source = df.select(*[number(c).alias(c) for c in columns])
    result = None
    for at in range(0, len(pairs), PAIRS_AT_ONCE):
        some = pairs[at : at + PAIRS_AT_ONCE]
        wide = source.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(some)])
        rows = [
            F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"p{i}").alias("correlation"))
            for i, (a, b) in enumerate(some)
        ]
        part = wide.select(F.inline(F.array(*rows)))
        result = part if result is None else result.unionByName(part)
    return result


def high_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    return correlations(df, columns).where(F.abs("correlation") > HIGH_CORRELATION)


def numeric_by_target(df: DataFrame, columns: list[str] = NUMERIC_FEATURES, target: str = "loan_status") -> DataFrame:
    """Mean, deviation and count of each numeric column per class.

    Aggregated wide and unpivoted afterwards: a few rows, not the table, are multiplied.
    """
    wide = df.where(F.col(target).isNotNull()).groupBy(target).agg(
        *[
            F.struct(
                F.avg(number(c)).alias("mean"), F.stddev_samp(number(c)).alias("std"), F.count(number(c)).alias("count")
            ).alias(c)
            for c in columns
        ]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(c)["mean"], F.col(c)["std"], F.col(c)["count"])
        for c in columns
    ]
    return wide.select(target, F.inline(F.array(*rows)))


def crosstab(df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES, target: str = "loan_status") -> DataFrame:
    """Share of each class per category value."""
    counts = text_pairs(df.where(F.col(target).isNotNull()), columns, keep=[target]).groupBy("column_name", "value").agg(
        F.count(RECORDS).alias("rows"), F.count_if(F.col(target) == 1).alias("ones")
    )
    return counts.select(
        "column_name",
        "value",
        F.try_divide(F.col("rows") - F.col("ones"), F.col("rows")).alias("share_0"),
        F.try_divide(F.col("ones"), F.col("rows")).alias("share_1"),
    )


def issues(df: DataFrame) -> DataFrame:
    """Quality problems as messages, one row each."""
    critical = ["person_age", "person_income", "loan_amnt", "loan_status"]
    copies = df.groupBy(*df.columns).agg(F.count(RECORDS).alias("__n"))
    wide = copies.agg(
        (F.sum("__n") - F.count(RECORDS)).alias("duplicates"),
        F.bool_or(F.col("person_age") < 0).alias("negative_age"),
        F.bool_or(F.col("person_income") < 0).alias("negative_income"),
        F.bool_or(F.col("loan_amnt") < 0).alias("negative_loan"),
        F.bool_or(F.col("person_age") > 100).alias("old"),
        F.bool_or(F.col("person_age") < 18).alias("young"),
        *[F.bool_or(F.col(c).isNull()).alias(f"null_{c}") for c in critical],
    )
    found = [
        F.when(
            F.col("duplicates") > 0,
            F.concat(F.lit("Found "), F.col("duplicates").cast("string"), F.lit(" duplicate rows")),
        ),
        F.when(F.col("negative_age"), "Negative ages found"),
        F.when(F.col("negative_income"), "Negative incomes found"),
        F.when(F.col("negative_loan"), "Negative loan amounts found"),
        F.when(F.col("old"), "Ages over 100 found"),
        F.when(F.col("young"), "Ages under 18 found"),
        *[F.when(F.col(f"null_{c}"), f"Missing values in critical column: {c}") for c in critical],
    ]
    return wide.select(F.explode(F.array_compact(F.array(*found))).alias("issue"))


def normality(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Jarque-Bera test per numeric column over all rows.

    Its statistic has two degrees of freedom, where the chi-square tail is
    exp(-x/2).
    """
    wide = df.agg(
        *[
            F.struct(F.count(number(c)).alias("n"), F.skewness(number(c)).alias("s"), F.kurtosis(number(c)).alias("k")).alias(c)
            for c in columns
        ]
    )

    def fields(c: str) -> list[Column]:
        part = F.col(c)
        statistic = part["n"] / F.lit(6.0) * (part["s"] * part["s"] + part["k"] * part["k"] / F.lit(4.0))
        p = F.exp(-statistic / 2)
        return [statistic.alias("statistic"), p.alias("p_value"), (p > 0.05).alias("normal")]

    return _per_column(wide, columns, fields)


def summary(df: DataFrame, target: str = "loan_status") -> DataFrame:
    """One row of headline figures."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    copies = df.groupBy(*df.columns).agg(F.count(RECORDS).alias("__n"))
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    known = F.sum(F.when(F.col(target).isNotNull(), F.col("__n")))
    return copies.agg(
        F.sum("__n").alias("total_records"),
        F.lit(len(df.columns)).alias("total_features"),
        F.lit(len(df.columns) - len(texts)).alias("numeric_features"),
        F.lit(len(texts)).alias("categorical_features"),
        F.sum(nulls * F.col("__n")).alias("missing_values"),
        (F.sum("__n") - F.count(RECORDS)).alias("duplicate_rows"),
        F.try_divide(F.sum(F.when(F.col(target) == 1, F.col("__n")).otherwise(0)) * F.lit(100.0), known).alias(
            "default_rate"
        ),
        F.try_divide(F.sum(F.when(F.col(target) == 0, F.col("__n")).otherwise(0)) * F.lit(100.0), known).alias(
            "non_default_rate"
        ),
    )


