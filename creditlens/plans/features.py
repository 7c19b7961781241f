"""Queries: features, encodings, scaling and splits."""

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditlens.functions import bands
from creditlens.functions.bands import flag
from creditlens.operators import features as ops
from creditlens.operators.cleaning import clean_job
from creditlens.plans.fixtures import AS_OF, Tables
from creditlens.plans.registry import query
from creditlens.plans.shape import rounded
from creditlens.schemas import HOME_OWNERSHIP, LOAN_INTENTS, NUMERIC_FEATURES

AGE_NAMED = """CASE WHEN person_age > 0 AND person_age <= 25 THEN '{0}' WHEN person_age > 25 AND person_age <= 35 THEN '{1}'
  WHEN person_age > 35 AND person_age <= 45 THEN '{2}' WHEN person_age > 45 AND person_age <= 100 THEN '{3}' END"""
AGE_OPEN = """CASE WHEN person_age <= 25 THEN 'Young' WHEN person_age <= 35 THEN 'Adult' WHEN person_age <= 45 THEN 'Middle' ELSE 'Senior' END"""


def flag_sql(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


@query(
    "feat_age_group",
    uses=("apps",),
    sql=f"""SELECT application_id, {AGE_OPEN} AS age_group_job, {AGE_NAMED.format('Young', 'Adult', 'Middle', 'Senior')} AS age_group_script,
  {AGE_NAMED.format('18-25', '26-35', '36-45', '45+')} AS age_group_inference FROM apps""",
)
def feat_age_group(t: Tables):
    age = F.col("person_age")
    return t.apps.select(
        "application_id",
        bands.age_group_open(age).alias("age_group_job"),
        bands.age_group_closed(age).alias("age_group_script"),
        bands.age_group_closed(age, bands.AGE_RANGES).alias("age_group_inference"),
    )


QUARTILES = """q AS (SELECT quantile_cont(person_income, 0.25) AS q1, quantile_cont(person_income, 0.5) AS q2, quantile_cont(person_income, 0.75) AS q3 FROM apps)"""
QUARTILE = """CASE WHEN person_income <= q1 THEN 'Low' WHEN person_income <= q2 THEN 'Medium' WHEN person_income <= q3 THEN 'High' ELSE 'VeryHigh' END"""


@query(
    "feat_income_quartile",
    uses=("apps",),
    sql=f", {QUARTILES} SELECT application_id, {QUARTILE} AS income_quartile, {flag_sql('person_income > q3')} AS has_high_income FROM apps CROSS JOIN q",
)
def feat_income_quartile(t: Tables):
    return ops.derive_script(t.apps).select("application_id", "income_quartile", "has_high_income")


@query(
    "feat_income_band",
    uses=("apps",),
    sql=f"""SELECT application_id, CASE WHEN person_income > 0 AND person_income <= 25000 THEN 'Low' WHEN person_income > 25000 AND person_income <= 50000 THEN 'Medium'
  WHEN person_income > 50000 AND person_income <= 75000 THEN 'High' WHEN person_income > 75000 AND person_income <= 1000000 THEN 'VeryHigh' END AS income_quartile,
  {flag_sql('person_income > 75000')} AS has_high_income FROM apps""",
)
def feat_income_band(t: Tables):
    return ops.derive_inference(t.apps, fixed_income=True).select(
        "application_id", "income_quartile", "has_high_income"
    )


STABLE = "person_emp_length / nullif((person_age - 18)::DOUBLE, 0)"
STABLE_SCRIPT = "person_emp_length / greatest((person_age - 18)::DOUBLE, 1)"


@query(
    "feat_employment",
    uses=("apps",),
    sql=f"""SELECT application_id, round({STABLE}, 9) + 0.0::DOUBLE AS stability_job, {flag_sql(f'{STABLE} > 0.3::DOUBLE')} AS stable_job,
  round({STABLE_SCRIPT}, 9) + 0.0::DOUBLE AS stability_script, {flag_sql(f'{STABLE_SCRIPT} > 0.3::DOUBLE')} AS stable_script FROM apps""",
)
def feat_employment(t: Tables):
    job, script = bands.employment_stability(), bands.employment_stability(floor_years=True)
    frame = t.apps.select(
        "application_id",
        job.alias("stability_job"),
        flag(job > 0.3).alias("stable_job"),
        script.alias("stability_script"),
        flag(script > 0.3).alias("stable_script"),
    )
    return rounded(frame, "stability_job", "stability_script", digits=9)


@query(
    "feat_debt",
    uses=("apps",),
    sql=f"""SELECT application_id, loan_percent_income AS debt_to_income_ratio, round(person_income / nullif(loan_amnt, 0), 6) AS ratio_job,
  round(person_income / greatest(loan_amnt, 1), 6) AS ratio_script, round(CASE WHEN loan_amnt > 0 THEN person_income / loan_amnt ELSE 0 END, 6) AS ratio_scoring,
  {flag_sql('loan_percent_income > 0.4::DOUBLE')} AS has_high_debt_ratio, {flag_sql('loan_percent_income > 0.3::DOUBLE')} AS high_debt_ratio FROM apps""",
)
def feat_debt(t: Tables):
    scoring = ops.scoring_derived()
    frame = t.apps.select(
        "application_id",
        F.col("loan_percent_income").alias("debt_to_income_ratio"),
        bands.income_to_loan().alias("ratio_job"),
        bands.income_to_loan(floor_loan=True).alias("ratio_script"),
        scoring["income_to_loan_ratio"].alias("ratio_scoring"),
        flag(F.col("loan_percent_income") > 0.4).alias("has_high_debt_ratio"),
        scoring["high_debt_ratio"].alias("high_debt_ratio"),
    )
    return rounded(frame, "ratio_job", "ratio_script", "ratio_scoring")


GROUP_OPEN = "CASE WHEN loan_grade IN ('A','B') THEN 'LowRisk' WHEN loan_grade IN ('C','D') THEN 'MediumRisk' ELSE 'HighRisk' END"
GROUP_CLOSED = "CASE WHEN loan_grade IN ('A','B') THEN 'LowRisk' WHEN loan_grade IN ('C','D') THEN 'MediumRisk' WHEN loan_grade IN ('E','F','G') THEN 'HighRisk' END"


@query(
    "feat_grade_group",
    uses=("raw",),
    sql=f"""SELECT application_id, {GROUP_OPEN} AS group_job, {GROUP_CLOSED} AS group_script,
  {flag_sql("cb_person_default_on_file = 'Y'")} AS has_historical_default FROM raw""",
)
def feat_grade_group(t: Tables):
    return t.raw.select(
        "application_id",
        bands.grade_group_open(F.col("loan_grade")).alias("group_job"),
        bands.grade_group_closed(F.col("loan_grade")).alias("group_script"),
        flag(F.col("cb_person_default_on_file") == "Y").alias("has_historical_default"),
    )


@query(
    "feat_loan_bands",
    uses=("apps",),
    sql="""SELECT application_id, CASE WHEN loan_amnt <= 5000 THEN 'Small' WHEN loan_amnt <= 15000 THEN 'Medium' WHEN loan_amnt <= 25000 THEN 'Large' ELSE 'VeryLarge' END AS loan_amount_category,
  CASE WHEN loan_int_rate <= 10 THEN 'Low' WHEN loan_int_rate <= 15 THEN 'Medium' ELSE 'High' END AS interest_rate_category FROM apps""",
)
def feat_loan_bands(t: Tables):
    return t.apps.select(
        "application_id",
        bands.loan_size(F.col("loan_amnt")).alias("loan_amount_category"),
        bands.rate_band(F.col("loan_int_rate")).alias("interest_rate_category"),
    )


def dummies_sql(levels: dict[str, list[str]], drop_first: bool) -> str:
    parts = [
        f"""{flag_sql(f"{name} = '{value}'")} AS "{name}_{value}\""""
        for name, values in levels.items()
        for value in sorted(values)[1 if drop_first else 0 :]
    ]
    return ", ".join(parts)


DUMMIES = {"person_home_ownership": HOME_OWNERSHIP, "loan_intent": LOAN_INTENTS}


@query(
    "enc_dummies",
    uses=("apps",),
    sql=f"SELECT application_id, {dummies_sql(DUMMIES, True)} FROM apps",
)
def enc_dummies(t: Tables):
    frame = t.apps.select("application_id", *DUMMIES)
    return ops.dummies(frame, ops.levels_of(frame, list(DUMMIES)), drop_first=True)


@query(
    "enc_dummies_all",
    uses=("apps",),
    sql=f"SELECT application_id, {dummies_sql(DUMMIES, False)} FROM apps",
)
def enc_dummies_all(t: Tables):
    frame = t.apps.select("application_id", *DUMMIES)
    return ops.dummies(frame, ops.levels_of(frame, list(DUMMIES)), drop_first=False)


DESCENDING = "CASE loan_grade WHEN 'A' THEN 7 WHEN 'B' THEN 6 WHEN 'C' THEN 5 WHEN 'D' THEN 4 WHEN 'E' THEN 3 WHEN 'F' THEN 2 WHEN 'G' THEN 1 ELSE 4 END"


@query(
    "enc_ordinal",
    uses=("raw",),
    sql=f"""SELECT application_id, nullif(position(loan_grade IN 'ABCDEFG'), 0)::INTEGER AS loan_grade_encoded,
  {DESCENDING} AS loan_grade_scoring, CASE cb_person_default_on_file WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS cb_person_default_on_file FROM raw""",
)
def enc_ordinal(t: Tables):
    with_scoring = t.raw.select(
        "application_id",
        "loan_grade",
        "cb_person_default_on_file",
        ops.scoring_encodings()["loan_grade_encoded"].alias("loan_grade_scoring"),
    )
    return ops.encode_ordinal(with_scoring)


ENCODINGS_SQL = (
    ", ".join(f"{flag_sql(f"person_home_ownership = '{v}'")} AS \"home_ownership_{v}\"" for v in HOME_OWNERSHIP)
    + ", "
    + ", ".join(f"{flag_sql(f"loan_intent = '{v}'")} AS \"loan_intent_{v}\"" for v in LOAN_INTENTS)
    + f", {DESCENDING} AS loan_grade_encoded, "
    + ", ".join(
        f"{flag_sql(f"cb_person_default_on_file = '{v}'")} AS \"cb_person_default_on_file_{v}\"" for v in ("Y", "N")
    )
)
DERIVED_SQL = f"""{flag_sql('person_age BETWEEN 18 AND 25')} AS age_group_18_25, {flag_sql('person_age BETWEEN 26 AND 35')} AS age_group_26_35,
  {flag_sql('person_age BETWEEN 36 AND 45')} AS age_group_36_45, {flag_sql('person_age >= 46')} AS age_group_46_plus,
  {flag_sql('person_income < 30000')} AS income_quartile_1, {flag_sql('person_income >= 30000 AND person_income < 50000')} AS income_quartile_2,
  {flag_sql('person_income >= 50000 AND person_income < 80000')} AS income_quartile_3, {flag_sql('person_income >= 80000')} AS income_quartile_4,
  {flag_sql('person_emp_length >= 5')} AS employment_stable, {flag_sql('person_emp_length < 2')} AS employment_new,
  loan_percent_income AS debt_to_income_ratio, {flag_sql('loan_percent_income > 0.3::DOUBLE')} AS high_debt_ratio,
  round(CASE WHEN loan_amnt > 0 THEN person_income / loan_amnt ELSE 0 END, 6) AS income_to_loan_ratio,
  {flag_sql("cb_person_default_on_file = 'Y'")} AS has_default_history, {flag_sql('cb_person_cred_hist_length < 2')} AS low_credit_history"""


@query("enc_scoring", uses=("apps",), sql=f"SELECT application_id, {ENCODINGS_SQL} FROM apps")
def enc_scoring(t: Tables):
    return t.apps.select("application_id", *[c.alias(n) for n, c in ops.scoring_encodings().items()])


@query("feat_scoring", uses=("apps",), sql=f"SELECT application_id, {DERIVED_SQL} FROM apps")
def feat_scoring(t: Tables):
    frame = t.apps.select("application_id", *[c.alias(n) for n, c in ops.scoring_derived().items()])
    return rounded(frame, "income_to_loan_ratio")


@query(
    "scoring_features",
    uses=("apps",),
    sql=f"SELECT application_id, {', '.join(f'{c}::DOUBLE AS {c}' for c in NUMERIC_FEATURES)}, {ENCODINGS_SQL}, {DERIVED_SQL} FROM apps",
)
def scoring_features(t: Tables):
    return rounded(ops.scoring_features(t.apps), "income_to_loan_ratio")


@query(
    "scale_numeric",
    uses=("apps",),
    sql=f", derived AS (SELECT *, {STABLE} AS employment_stability, person_income / nullif(loan_amnt, 0) AS income_to_loan_ratio FROM apps) "
    + "SELECT application_id, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM derived)) / (SELECT stddev_samp({c}) FROM derived), 6) AS {c}_scaled"
        for c in ops.SCALED
    )
    + " FROM derived",
)
def scale_numeric(t: Tables):
    derived = t.apps.withColumns(
        {"employment_stability": bands.employment_stability(), "income_to_loan_ratio": bands.income_to_loan()}
    )
    names = [f"{c}_scaled" for c in ops.SCALED]
    return rounded(ops.standardise(derived, ops.SCALED).select("application_id", *names), *names)


HASH = "CAST('0x' || substr(md5(application_id::VARCHAR), 1, 8) AS BIGINT)"


@query(
    "split_hash",
    uses=("apps",),
    sql=f"SELECT application_id, loan_status, CASE WHEN {HASH} % 1000 < 800 THEN 'train' ELSE 'test' END AS split FROM apps",
)
def split_hash(t: Tables):
    return ops.split_by_hash(t.apps, "application_id").select("application_id", "loan_status", "split")


@query(
    "split_counts",
    uses=("apps",),
    sql=f"""SELECT CASE WHEN {HASH} % 1000 < 800 THEN 'train' ELSE 'test' END AS split, loan_status, count(*) AS rows FROM apps GROUP BY ALL""",
)
def split_counts(t: Tables):
    marked = ops.split_by_hash(t.apps, "application_id")
    return marked.groupBy("split", "loan_status").agg(F.count(F.lit(1)).alias("rows"))


RANKED = f""", ranked AS (SELECT application_id, loan_status, row_number() OVER (PARTITION BY loan_status ORDER BY {HASH}, application_id) AS r,
  count(*) OVER (PARTITION BY loan_status) AS n FROM apps)"""


@query(
    "split_stratified",
    uses=("apps",),
    sql=f"{RANKED} SELECT application_id, loan_status, CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM ranked",
)
def split_stratified(t: Tables):
    frame = t.apps.select("application_id", "loan_status")
    return ops.split_stratified(frame, "application_id", "loan_status", {"train": 0.8, "test": 0.2})


@query(
    "split_three_way",
    uses=("apps",),
    sql=f"""{RANKED} SELECT application_id, loan_status, CASE WHEN r <= floor(n * 0.7::DOUBLE) THEN 'train'
  WHEN r <= floor(n * (0.7::DOUBLE + 0.1::DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM ranked""",
)
def split_three_way(t: Tables):
    frame = t.apps.select("application_id", "loan_status")
    shares = {"train": 0.7, "validation": 0.1, "test": 0.2}
    return ops.split_stratified(frame, "application_id", "loan_status", shares)


def _derived(t: Tables):
    return ops.complete_numbers(ops.derive_job(t.apps), ops.SCALED)


@query("enc_onehot_vector")
def enc_onehot_vector(t: Tables):
    derived = _derived(t)
    encoded = Pipeline(stages=ops.encoding_stages(derived)).fit(derived).transform(derived)
    return encoded.select(
        "application_id", *[vector_to_array(f"{c}_encoded").alias(f"{c}_encoded") for c in ops.ENCODED]
    )


@query("ml_features")
def ml_features(t: Tables):
    derived = _derived(t)
    vectors = ops.fit_features(derived).transform(derived)
    return vectors.select("application_id", vector_to_array("features").alias("features"), "loan_status")


@query("feature_job")
def feature_job(t: Tables):
    """Cleaned feed to feature vectors with the split, as the feature job does."""
    from creditlens.sources.writers import with_processing_columns

    cleaned = with_processing_columns(clean_job(t.feed_dup), AS_OF, "feature-engineering", 1.0)
    derived = ops.complete_numbers(ops.derive_job(cleaned), ops.SCALED)
    vectors = ops.fit_features(derived).transform(derived)
    split = ops.split_by_hash(vectors, "application_id")
    return split.select(
        "application_id",
        vector_to_array("features").alias("features"),
        "loan_status",
        F.col("processing_date").cast("string").alias("processing_date"),
        "job_name",
        "split",
    )


@query(
    "feat_inference",
    uses=("apps",),
    sql=f""", {QUARTILES} SELECT application_id, {AGE_NAMED.format('18-25', '26-35', '36-45', '45+')} AS age_group, {QUARTILE} AS income_quartile,
  round({STABLE}, 9) + 0.0::DOUBLE AS employment_stability, {flag_sql(f'{STABLE} > 0.3::DOUBLE')} AS has_stable_employment,
  loan_percent_income AS debt_to_income_ratio, round(person_income / nullif(loan_amnt, 0), 6) AS income_to_loan_ratio,
  {flag_sql('loan_percent_income > 0.4::DOUBLE')} AS has_high_debt_ratio, {flag_sql('person_income > q3')} AS has_high_income,
  {flag_sql("cb_person_default_on_file = 'Y'")} AS has_historical_default, {GROUP_CLOSED} AS risk_grade_group FROM apps CROSS JOIN q""",
)
def feat_inference(t: Tables):
    """The batch features of the inference job, with the batch's own quartiles."""
    names = ["age_group", "income_quartile", "employment_stability", "has_stable_employment", "debt_to_income_ratio", "income_to_loan_ratio"]
    names += ["has_high_debt_ratio", "has_high_income", "has_historical_default", "risk_grade_group"]
    frame = ops.derive_inference(t.apps).select("application_id", *names)
    return rounded(rounded(frame, "employment_stability", digits=9), "income_to_loan_ratio")


#: What the feature job derives, with gaps filled by medians; then every level's place, most frequent first.
JOB_TABLES = f""", {QUARTILES},
derived AS (SELECT *, {AGE_OPEN} AS age_group, {QUARTILE} AS income_quartile, {STABLE} AS employment_stability,
  person_income / nullif(loan_amnt, 0) AS income_to_loan_ratio, {GROUP_OPEN} AS risk_grade_group,
  CASE WHEN loan_amnt <= 5000 THEN 'Small' WHEN loan_amnt <= 15000 THEN 'Medium' WHEN loan_amnt <= 25000 THEN 'Large' ELSE 'VeryLarge' END AS loan_amount_category,
  CASE WHEN loan_int_rate <= 10 THEN 'Low' WHEN loan_int_rate <= 15 THEN 'Medium' ELSE 'High' END AS interest_rate_category FROM apps CROSS JOIN q),
complete AS (SELECT * REPLACE ({", ".join(f"coalesce({c}::DOUBLE, (SELECT median({c}::DOUBLE) FROM derived)) AS {c}" for c in ops.SCALED)}) FROM derived),
levels AS (SELECT name, level, rank() OVER (PARTITION BY name ORDER BY n DESC, level) - 1 AS place, count(*) OVER (PARTITION BY name) AS size FROM (
  {" UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS level, count(*) AS n FROM derived GROUP BY {c}" for c in ops.ENCODED)})),
starts AS (SELECT k, name, coalesce((SELECT sum(size) FROM (SELECT DISTINCT name, size FROM levels) l JOIN (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(ops.ENCODED))}) o(j, other) ON l.name = other WHERE j < k), 0) AS start
  FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(ops.ENCODED))}) v(k, name))"""
SCALED_CELLS = " UNION ALL ".join(
    f"SELECT application_id, {i} AS position, round(({c} - (SELECT avg({c}) FROM complete)) / (SELECT stddev_samp({c}) FROM complete), 6) + 0.0::DOUBLE AS value FROM complete"
    for i, c in enumerate(ops.SCALED)
)
ONE_HOT_CELLS = " UNION ALL ".join(
    f"SELECT application_id, ({len(ops.SCALED)} + start + place)::INTEGER, 1.0::DOUBLE FROM derived JOIN levels l ON l.name = '{c}' AND l.level = {c} JOIN starts s ON s.name = '{c}'"
    for c in ops.ENCODED
)


def _cells(vectors, column: str = "features"):
    """The entries of vectors as rows: all of the scaled numbers, and those of the rest that are not 0."""
    entries = vectors.select("application_id", F.posexplode(vector_to_array(column)).alias("position", "value"))
    return rounded(entries.where(f"position < {len(ops.SCALED)} OR value <> 0"), "value")


@query("ml_features_cells", uses=("apps",), sql=f"{JOB_TABLES} {SCALED_CELLS} UNION ALL {ONE_HOT_CELLS}")
def ml_features_cells(t: Tables):
    derived = _derived(t)
    return _cells(ops.fit_features(derived).transform(derived))


@query(
    "enc_onehot_cells",
    uses=("apps",),
    sql=f"{JOB_TABLES} " + " UNION ALL ".join(f"SELECT application_id, '{c}' AS name, place::INTEGER AS position, size::INTEGER AS width FROM derived JOIN levels l ON l.name = '{c}' AND l.level = {c}" for c in ops.ENCODED),
)
def enc_onehot_cells(t: Tables):
    """The place of the one in each category's vector, and the vector's length."""
    derived = _derived(t)
    encoded = Pipeline(stages=ops.encoding_stages(derived)).fit(derived).transform(derived)
    pairs = [F.struct(F.lit(c).alias("name"), vector_to_array(f"{c}_encoded").alias("v")) for c in ops.ENCODED]
    rows = encoded.select("application_id", F.inline(F.array(*pairs)))
    return rows.select("application_id", "name", (F.array_position("v", 1.0) - 1).cast("int").alias("position"), F.size("v").alias("width"))
