"""Derived features, encodings, scaling and splits."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlens.functions import bands
from creditlens.functions.bands import flag
from creditlens.functions.scoring import lookup
from creditlens.operators.profiling import value_counts
from creditlens.operators.quantiles import number, quantile_values
from creditlens.schemas import HOME_OWNERSHIP, LOAN_INTENTS, NUMERIC_FEATURES

SCALED = [*NUMERIC_FEATURES, "employment_stability", "income_to_loan_ratio"]
ENCODED = [
    "person_home_ownership",
    "loan_intent",
    "age_group",
    "income_quartile",
    "risk_grade_group",
    "loan_amount_category",
    "interest_rate_category",
]
#: Slices of the hash range in a stratified split, and seeds of the splits.
SPLIT_BITS = 20
TRAIN_SHARE = 0.8


def income_cuts(df: DataFrame) -> dict[float, float | None]:
    return quantile_values(df, {"person_income": [0.25, 0.5, 0.75]})["person_income"]


def derive_job(df: DataFrame, cuts: dict[float, float | None] | None = None) -> DataFrame:
    """Features of the feature job. Without given income cuts the frame's own quartiles are taken."""
    cuts = cuts or income_cuts(df)
    income = F.col("person_income")
    return df.withColumns(
        {
            "age_group": bands.age_group_open(F.col("person_age")),
            "income_quartile": bands.quartile_label(income, cuts[0.25], cuts[0.5], cuts[0.75], null_last=True),
            "has_high_income": flag(income > cuts[0.75]),
            "employment_stability": bands.employment_stability(),
            "has_stable_employment": flag(bands.employment_stability() > 0.3),
            "debt_to_income_ratio": F.col("loan_percent_income"),
            "income_to_loan_ratio": bands.income_to_loan(),
            "has_high_debt_ratio": flag(F.col("loan_percent_income") > 0.4),
            "risk_grade_group": bands.grade_group_open(F.col("loan_grade")),
            "has_historical_default": flag(F.col("cb_person_default_on_file") == "Y"),
            "loan_amount_category": bands.loan_size(F.col("loan_amnt")),
            "interest_rate_category": bands.rate_band(F.col("loan_int_rate")),
        }
    )


def derive_script(df: DataFrame) -> DataFrame:
    """Features of the cleaning script: closed age bins, ratios with a floor of one."""
    cuts = quantile_values(df, {"person_income": [0.25, 0.5, 0.75]})["person_income"]
    income = F.col("person_income")
    return df.withColumns(
        {
            "age_group": bands.age_group_closed(F.col("person_age")),
            "income_quartile": bands.quartile_label(income, cuts[0.25], cuts[0.5], cuts[0.75]),
            "has_high_income": flag(income > cuts[0.75]),
            "employment_stability": bands.employment_stability(floor_years=True),
            "has_stable_employment": flag(bands.employment_stability(floor_years=True) > 0.3),
            "debt_to_income_ratio": F.col("loan_percent_income"),
            "income_to_loan_ratio": bands.income_to_loan(floor_loan=True),
            "has_high_debt_ratio": flag(F.col("loan_percent_income") > 0.4),
            "risk_grade_group": bands.grade_group_closed(F.col("loan_grade")),
            "has_historical_default": flag(F.col("cb_person_default_on_file") == "Y"),
        }
    )


def derive_inference(df: DataFrame, fixed_income: bool = False) -> DataFrame:
    """Features before prediction; fixed income bands online, quartiles in a batch."""
    income = F.col("person_income")
    if fixed_income:
        quartile, high = bands.income_band(income), income > 75000
    else:
        cuts = quantile_values(df, {"person_income": [0.25, 0.5, 0.75]})["person_income"]
        quartile = bands.quartile_label(income, cuts[0.25], cuts[0.5], cuts[0.75])
        high = income > cuts[0.75]
    return df.withColumns(
        {
            "age_group": bands.age_group_closed(F.col("person_age"), bands.AGE_RANGES),
            "income_quartile": quartile,
            "employment_stability": bands.employment_stability(),
            "has_stable_employment": flag(bands.employment_stability() > 0.3),
            "debt_to_income_ratio": F.col("loan_percent_income"),
            "income_to_loan_ratio": bands.income_to_loan(),
            "has_high_debt_ratio": flag(F.col("loan_percent_income") > 0.4),
            "has_high_income": flag(high),
            "has_historical_default": flag(F.col("cb_person_default_on_file") == "Y"),
            "risk_grade_group": bands.grade_group_closed(F.col("loan_grade")),
        }
    )


def scoring_encodings() -> dict[str, Column]:
    """Fixed-vocabulary codes of online scoring."""
    codes = {
        f"home_ownership_{value}": flag(F.col("person_home_ownership") == value) for value in HOME_OWNERSHIP
    }
    codes |= {f"loan_intent_{value}": flag(F.col("loan_intent") == value) for value in LOAN_INTENTS}
    codes["loan_grade_encoded"] = lookup(F.col("loan_grade"), bands.GRADE_DESCENDING, 4)
    codes |= {
        f"cb_person_default_on_file_{value}": flag(F.col("cb_person_default_on_file") == value)
        for value in ("Y", "N")
    }
    return codes


def scoring_derived() -> dict[str, Column]:
    """Flags and ratios of online scoring. An age of 25.5 falls in no age group."""
    age, income, employment = F.col("person_age"), F.col("person_income"), F.col("person_emp_length")
    debt, loan = F.col("loan_percent_income"), F.col("loan_amnt")
    return {
        "age_group_18_25": flag(age.between(18, 25)),
        "age_group_26_35": flag(age.between(26, 35)),
        "age_group_36_45": flag(age.between(36, 45)),
        "age_group_46_plus": flag(age >= 46),
        "income_quartile_1": flag(income < 30000),
        "income_quartile_2": flag((income >= 30000) & (income < 50000)),
        "income_quartile_3": flag((income >= 50000) & (income < 80000)),
        "income_quartile_4": flag(income >= 80000),
        "employment_stable": flag(employment >= 5),
        "employment_new": flag(employment < 2),
        "debt_to_income_ratio": debt.cast("double"),
        "high_debt_ratio": flag(debt > 0.3),
        "income_to_loan_ratio": F.when(loan > 0, F.try_divide(income, loan.cast("double"))).otherwise(F.lit(0.0)),
        "has_default_history": flag(F.col("cb_person_default_on_file") == "Y"),
        "low_credit_history": flag(F.col("cb_person_cred_hist_length") < 2),
    }


def scoring_features(df: DataFrame, key: str = "application_id") -> DataFrame:
    """The full feature row of online scoring: 7 numbers, 13 codes, 15 derived."""
    numbers = {name: F.col(name).cast("double") for name in NUMERIC_FEATURES}
    columns = {**numbers, **scoring_encodings(), **scoring_derived()}
    return df.select(key, *[value.alias(name) for name, value in columns.items()])


def levels_of(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted distinct values per column.

    Dummy columns are one per level, so the level names have to reach the driver to
    name them; a caller that knows them passes its own lists to ``dummies``.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    distinct = df.select(F.inline(pairs)).where(F.col("v").isNotNull()).distinct()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in distinct.collect():
        found[row["c"]].append(row["v"])
    return {name: sorted(values) for name, values in found.items()}


def dummies(df: DataFrame, levels: dict[str, list[str]], drop_first: bool) -> DataFrame:
    """0/1 columns per level in place of each category column."""
    made = {
        f"{name}_{value}": flag(F.col(name) == value)
        for name, values in levels.items()
        for value in (values[1:] if drop_first else values)
    }
    return df.withColumns(made).drop(*levels)


def encode_ordinal(df: DataFrame, unknown_flag_null: bool = True) -> DataFrame:
    """Grade as 1..7 and the default flag as 0/1."""
    on_file = F.col("cb_person_default_on_file")
    other = F.lit(None).cast("int") if unknown_flag_null else F.lit(0)
    return df.withColumns(
        {
            "loan_grade_encoded": lookup(F.col("loan_grade"), bands.GRADE_ASCENDING),
            "cb_person_default_on_file": F.when(on_file == "Y", 1).when(on_file == "N", 0).otherwise(other),
        }
    ).drop("loan_grade")


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / sample deviation, as ``<column>_scaled``."""
    row = df.agg(
        *[F.avg(c).alias(f"{c}#m") for c in columns], *[F.stddev_samp(c).alias(f"{c}#s") for c in columns]
    ).first()
    return df.withColumns(
        {
            f"{c}_scaled": F.try_divide(F.col(c) - F.lit(row[f"{c}#m"]), F.lit(row[f"{c}#s"]))
            for c in columns
        }
    )


def medians_of(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Median per column, 0 for a column without values."""
    return {c: found[0.5] or 0.0 for c, found in quantile_values(df, {c: [0.5] for c in columns}).items()}


def complete_numbers(df: DataFrame, columns: list[str], medians: dict[str, float] | None = None) -> DataFrame:
    """Medians for nulls and NaN, since an assembled vector takes none; the frame's own unless given."""
    medians = medians or medians_of(df, columns)
    return df.withColumns({c: F.coalesce(number(c), F.lit(medians[c])) for c in columns})


def indexers(df: DataFrame, categories: list[str]) -> list[StringIndexerModel]:
    """Levels of all categories, most frequent first, from one counting pass.

    Every level is kept: an index model holds them all, and sparse vectors have no
    trouble with width.
    """
    rows = value_counts(df, categories).where(F.col("value").isNotNull()).collect()
    levels: dict[str, list[str]] = {name: [] for name in categories}
    for row in sorted(rows, key=lambda r: (r["column_name"], -r["rows"], r["value"])):
        levels[row["column_name"]].append(row["value"])
    return [
        StringIndexerModel.from_labels(
            levels[name], inputCol=name, outputCol=f"{name}_indexed", handleInvalid="keep"
        )
        for name in categories
    ]


def encoding_stages(df: DataFrame, categories: list[str] = ENCODED) -> list:
    """Index and one-hot encode the categories."""
    encoder = OneHotEncoder(
        inputCols=[f"{name}_indexed" for name in categories],
        outputCols=[f"{name}_encoded" for name in categories],
    )
    return [*indexers(df, categories), encoder]


def fit_features(df: DataFrame, numbers: list[str] = SCALED, categories: list[str] = ENCODED) -> PipelineModel:
    """Index, one-hot encode, scale and assemble, fitted as one model."""
    encoded = [f"{name}_encoded" for name in categories]
    stages = [
        *encoding_stages(df, categories),
        VectorAssembler(inputCols=numbers, outputCol="numerical_features"),
        StandardScaler(inputCol="numerical_features", outputCol="scaled_features", withMean=True, withStd=True),
        VectorAssembler(inputCols=["scaled_features", *encoded], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(df)


def hash_value(key: str) -> Column:
    """32 bits of the key's md5: the same on every run and partitioning."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")


def split_by_hash(df: DataFrame, key: str, share: float = TRAIN_SHARE) -> DataFrame:
    """Mark each row train or test by its key alone; no shuffle, stable on reruns."""
    in_train = hash_value(key) % 1000 < round(share * 1000)
    return df.withColumn("split", F.when(in_train, "train").otherwise("test"))


def split_stratified(df: DataFrame, key: str, label: str, shares: dict[str, float]) -> DataFrame:
    """Split every class in the given proportions, exact to the row; null is a class too.

    Rows of a class are ordered by (hash, key) and cut at whole ranks. To find the
    cuts without ordering a class, hashes are counted in 2**20 slices; only the
    slices a cut falls in, a millionth of the rows each, are ranked. The cuts are
    a few rows per class and the table itself is only scanned.
    """
    slice_of = F.shiftright("__hash", 32 - SPLIT_BITS)
    hashed = df.withColumn("__hash", hash_value(key))
    counts = hashed.groupBy(F.col(label).alias("__label"), slice_of.alias("__slice")).agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy("__label")
    upto = counts.withColumns(
        {
            "upto": F.sum("n").over(by_class.orderBy("__slice")),
            "total": F.sum("n").over(by_class.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )
    names = list(shares)
    edges, reached = [], 0.0
    for name in names[:-1]:
        reached += shares[name]
        edges.append((name, reached))
    ranks = F.array(
        *[F.struct(F.lit(i).alias("cut"), F.floor(F.col("total") * F.lit(share)).alias("rank")) for i, (_, share) in enumerate(edges)]
    )
    cut_slices = (
        upto.select("*", F.inline(ranks))
        .where((F.col("upto") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
        .select("__label", "__slice", "cut", (F.col("rank") - F.col("upto") + F.col("n")).alias("inside"))
    )
    order = Window.partitionBy("__label", "cut").orderBy("__hash", key)
    near = hashed.select(key, F.col(label).alias("__row_label"), "__hash", slice_of.alias("__row_slice"))
    here = F.col("__row_label").eqNullSafe(F.col("__label")) & (F.col("__row_slice") == F.col("__slice"))
    cuts = (
        near.join(cut_slices, here)
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") == F.col("inside"))
        .groupBy("__label")
        .agg(
            *[
                F.max(F.when(F.col("cut") == i, F.struct("__hash", F.col(key).alias("__key")))).alias(f"__cut{i}")
                for i in range(len(edges))
            ]
        )
    )
    joined = hashed.join(cuts.withColumnRenamed("__label", "__of"), F.col(label).eqNullSafe(F.col("__of")), "left")
    here = F.struct(F.col("__hash"), F.col(key).alias("__key"))
    chosen = F.lit(names[-1])
    for i in reversed(range(len(edges))):
        chosen = F.when(here <= F.col(f"__cut{i}"), edges[i][0]).otherwise(chosen)
    return joined.select(*df.columns, chosen.alias("split"))


def with_weights(df: DataFrame, label: str, counted: DataFrame | None = None) -> DataFrame:
    """Balanced class weights: rows / (classes * rows of the class), 1 for classes not counted.

    The classes are counted in ``counted``, the training rows, where that is given.
    """
    counts = (df if counted is None else counted).groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per class meets here.
    every = Window.partitionBy(F.lit(0))
    weight = F.sum("__n").over(every) / (F.count(F.lit(1)).over(every) * F.col("__n"))
    weights = counts.select("__class", weight.alias("__weight"))
    # Dealt by class, all rows of a class would meet in one task: the few weights go to the rows.
    joined = df.join(F.broadcast(weights), F.col(label).eqNullSafe(F.col("__class")), "left")
    return joined.select(*df.columns, F.coalesce("__weight", F.lit(1.0)).alias("weight"))
