"""Queries: profiles of the feed."""

from itertools import combinations

from pyspark.sql import functions as F

from creditlens.operators import normal, profiling as ops
from creditlens.plans.fixtures import CLEAN_COLUMNS, Tables
from creditlens.plans.quality import TEXTS, WIDTH, MISSING_SUM, kind_of
from creditlens.plans.registry import query
from creditlens.plans.shape import rounded
from creditlens.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES


def per(columns, body, source="feed", tail="") -> str:
    return " UNION ALL ".join(f"SELECT {body(c)} FROM {source}{tail}" for c in columns)


@query(
    "profile_overview",
    uses=("feed",),
    sql=per(
        CLEAN_COLUMNS,
        lambda c: f"""'{c}' AS column_name, '{kind_of(c)}' AS data_type, count(*) AS total_rows,
  count(*) FILTER (WHERE {c} IS NULL) AS null_count, round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS null_percentage""",
    ),
)
def profile_overview(t: Tables):
    return rounded(ops.overview(t.feed), "null_percentage")


RAW_TEXTS = [c for c in CLEAN_COLUMNS if c not in ("application_id", "loan_status")]
STAND_INS = ["", " ", "NA", "N/A", "null", "NULL", "nan", "NaN"]


@query(
    "profile_missing",
    uses=("raw",),
    sql=f"""SELECT * FROM ({per(CLEAN_COLUMNS, lambda c: f"'{c}' AS column_name, '<null>' AS representation, count(*) FILTER (WHERE {c} IS NULL) AS rows", "raw")}
UNION ALL SELECT column_name, '''' || v || '''', count(*) FROM (
  {per(RAW_TEXTS, lambda c: f"'{c}' AS column_name, {c} AS v", "raw")}) WHERE v IN ('', ' ', 'NA', 'N/A', 'null', 'NULL', 'nan', 'NaN') GROUP BY ALL) WHERE rows > 0""",
)
def profile_missing(t: Tables):
    return ops.missing(t.raw)


@query(
    "profile_types",
    uses=("raw",),
    sql=per(
        RAW_TEXTS,
        lambda c: f"""'{c}' AS column_name, count({c}) AS non_null, count(TRY_CAST({c} AS DOUBLE)) AS numeric_values,
  round(count(TRY_CAST({c} AS DOUBLE))::DOUBLE / count({c}), 6) AS numeric_share, count(TRY_CAST({c} AS DOUBLE)) = count({c}) AS only_numeric""",
        "raw",
    ),
)
def profile_types(t: Tables):
    return rounded(ops.numeric_text(t.raw), "numeric_share")


@query(
    "profile_describe",
    uses=("feed",),
    sql=per(
        NUMERIC_FEATURES,
        lambda c: f"""'{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25)::DOUBLE, 6) AS q25, round(quantile_cont({c}, 0.5)::DOUBLE, 6) AS q50, round(quantile_cont({c}, 0.75)::DOUBLE, 6) AS q75,
  max({c})::DOUBLE AS max""",
    ),
)
def profile_describe(t: Tables):
    return rounded(ops.describe(t.feed), "mean", "std", "q25", "q50", "q75")


MOMENTS = """SELECT '{c}' AS column_name, count(v) AS n, avg(power(v - m, 2)) AS m2, avg(power(v - m, 3)) AS m3, avg(power(v - m, 4)) AS m4
FROM (SELECT {c}::DOUBLE AS v, (SELECT avg({c}) FROM feed) AS m FROM feed WHERE {c} IS NOT NULL)"""


def moments(columns) -> str:
    return " UNION ALL ".join(MOMENTS.format(c=c) for c in columns)


@query(
    "profile_skew",
    uses=("feed",),
    sql=f"""SELECT column_name, round(s, 6) AS skewness, CASE WHEN s > 1 THEN 'Right skewed' WHEN s < -1 THEN 'Left skewed' ELSE 'Approximately normal' END AS label
FROM (SELECT column_name, m3 / power(m2, 1.5) AS s FROM ({moments(NUMERIC_FEATURES)}))""",
)
def profile_skew(t: Tables):
    return rounded(ops.skewness(t.feed), "skewness")


@query(
    "profile_kurtosis",
    uses=("feed",),
    sql=f"""SELECT column_name, round(k, 6) AS kurtosis, CASE WHEN k > 3 THEN 'Heavy tails' WHEN k < -1 THEN 'Light tails' ELSE 'Normal tails' END AS label
FROM (SELECT column_name, m4 / (m2 * m2) - 3 AS k FROM ({moments(NUMERIC_FEATURES)}))""",
)
def profile_kurtosis(t: Tables):
    return rounded(ops.kurtosis(t.feed), "kurtosis")


@query(
    "profile_iqr",
    uses=("feed",),
    sql=" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers,
  round(count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0::DOUBLE / count(*), 6) AS outlier_percentage, round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound
FROM feed CROSS JOIN (SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi
  FROM (SELECT quantile_cont({c}, 0.25)::DOUBLE AS q1, quantile_cont({c}, 0.75)::DOUBLE AS q3 FROM feed))"""
        for c in NUMERIC_FEATURES
    ),
)
def profile_iqr(t: Tables):
    return rounded(ops.iqr_outliers(t.feed), "outlier_percentage", "lower_bound", "upper_bound")


VALUES_SQL = per(CATEGORICAL_FEATURES, lambda c: f"'{c}' AS column_name, {c} AS value")


@query(
    "profile_categorical",
    uses=("feed",),
    sql=f"""SELECT column_name, value, rows, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY rows DESC, value) AS INTEGER) AS rank
FROM (SELECT column_name, value, count(*) AS rows FROM ({VALUES_SQL}) WHERE value IS NOT NULL GROUP BY ALL)) WHERE rank <= 10""",
)
def profile_categorical(t: Tables):
    return ops.top_values(t.feed)


@query(
    "profile_cardinality",
    uses=("feed",),
    sql=f"""SELECT column_name, count(*) AS distinct_values, count(*) > 50 AS high_cardinality,
  round(max(rows)::DOUBLE / min(rows), 6) AS imbalance_ratio, count(*) <= 10 AND max(rows)::DOUBLE / min(rows) > 10 AS imbalanced
FROM (SELECT column_name, value, count(*) AS rows FROM ({VALUES_SQL}) WHERE value IS NOT NULL GROUP BY ALL) GROUP BY column_name""",
)
def profile_cardinality(t: Tables):
    return rounded(ops.cardinality(t.feed), "imbalance_ratio")


@query(
    "profile_target",
    uses=("feed",),
    sql=""", c AS (SELECT loan_status, count(*) AS rows FROM feed GROUP BY loan_status)
SELECT loan_status, rows, round(rows * 100.0::DOUBLE / (SELECT sum(rows) FROM c), 6) AS percentage,
  round((SELECT max(rows)::DOUBLE / min(rows) FROM c), 6) AS imbalance_ratio, (SELECT max(rows)::DOUBLE / min(rows) FROM c) > 3 AS imbalanced FROM c""",
)
def profile_target(t: Tables):
    return rounded(ops.target_distribution(t.feed), "percentage", "imbalance_ratio")


CORRELATED = [*NUMERIC_FEATURES, "loan_status"]


@query(
    "profile_corr",
    uses=("feed",),
    sql=" UNION ALL ".join(
        f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 6) AS correlation FROM feed"
        for a, b in combinations(CORRELATED, 2)
    ),
)
def profile_corr(t: Tables):
    return rounded(ops.correlations(t.feed, CORRELATED), "correlation")


RATIOS = {"income_to_loan": "person_income / (loan_amnt + 1)", "monthly_payment": "loan_amnt * (1 + loan_int_rate / 100) / 12"}
WITH_RATIOS = [*CORRELATED, *RATIOS]


@query(
    "profile_corr_high",
    uses=("feed",),
    sql=f", ratios AS (SELECT *, {', '.join(f'{text} AS {name}' for name, text in RATIOS.items())} FROM feed) SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 6) AS correlation FROM ratios"
        for a, b in combinations(WITH_RATIOS, 2)
    )
    + ") WHERE abs(correlation) > 0.7",
)
def profile_corr_high(t: Tables):
    """The feed's columns and two ratios, one of which follows the loan closely."""
    frame = t.feed.withColumns({name: F.expr(text) for name, text in RATIOS.items()})
    return rounded(ops.high_correlations(frame, WITH_RATIOS), "correlation")


@query(
    "profile_num_by_target",
    uses=("feed",),
    sql=per(
        NUMERIC_FEATURES,
        lambda c: f"loan_status, '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, count({c}) AS count",
        tail=" GROUP BY loan_status",
    ),
)
def profile_num_by_target(t: Tables):
    return rounded(ops.numeric_by_target(t.feed), "mean", "std")


@query(
    "profile_crosstab",
    uses=("feed",),
    sql=per(
        CATEGORICAL_FEATURES,
        lambda c: f"""'{c}' AS column_name, {c} AS value, round(count(*) FILTER (WHERE loan_status = 0)::DOUBLE / count(*), 6) AS share_0,
  round(count(*) FILTER (WHERE loan_status = 1)::DOUBLE / count(*), 6) AS share_1""",
        tail=" GROUP BY ALL",
    ),
)
def profile_crosstab(t: Tables):
    return rounded(ops.crosstab(t.feed), "share_0", "share_1")


@query(
    "profile_issues",
    uses=("feed_dup",),
    sql=""", w AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM feed_dup)) AS dup, min(person_age) AS a0, max(person_age) AS a1,
  min(person_income) AS i0, min(loan_amnt) AS l0, count(person_age) < count(*) AS na, count(person_income) < count(*) AS ni,
  count(loan_amnt) < count(*) AS nl, count(loan_status) < count(*) AS ns FROM feed_dup)
SELECT issue FROM (SELECT unnest([CASE WHEN dup > 0 THEN 'Found ' || dup::VARCHAR || ' duplicate rows' END, CASE WHEN a0 < 0 THEN 'Negative ages found' END,
  CASE WHEN i0 < 0 THEN 'Negative incomes found' END, CASE WHEN l0 < 0 THEN 'Negative loan amounts found' END,
  CASE WHEN a1 > 100 THEN 'Ages over 100 found' END, CASE WHEN a0 < 18 THEN 'Ages under 18 found' END,
  CASE WHEN na THEN 'Missing values in critical column: person_age' END, CASE WHEN ni THEN 'Missing values in critical column: person_income' END,
  CASE WHEN nl THEN 'Missing values in critical column: loan_amnt' END, CASE WHEN ns THEN 'Missing values in critical column: loan_status' END]) AS issue FROM w)
WHERE issue IS NOT NULL""",
)
def profile_issues(t: Tables):
    return ops.issues(t.feed_dup)


@query(
    "profile_normality",
    uses=("feed",),
    sql=f"""SELECT column_name, round(jb, 4) AS statistic, round(exp(-jb / 2), 6) AS p_value, exp(-jb / 2) > 0.05 AS normal
FROM (SELECT column_name, n / 6.0::DOUBLE * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0::DOUBLE) AS jb FROM ({moments(NUMERIC_FEATURES)}))""",
)
def profile_normality(t: Tables):
    return rounded(rounded(ops.normality(t.feed), "statistic", digits=4), "p_value")


def _poly_sql(values: list[float], x: str) -> str:
    return " + ".join(f"({v!r}::DOUBLE) * power({x}, {k})" for k, v in enumerate(values))


@query(
    "profile_shapiro",
    uses=("feed",),
    sql=f""", cells AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, {c}::DOUBLE AS x FROM feed WHERE {c} IS NOT NULL" for c in NUMERIC_FEATURES)}),
ranked AS (SELECT column_name, x - avg(x) OVER w AS x, row_number() OVER (PARTITION BY column_name ORDER BY x) AS i, count(*) OVER w AS n
  FROM cells WINDOW w AS (PARTITION BY column_name)),
shares AS (SELECT *, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM ranked),
parts AS (SELECT *, p - 0.5::DOUBLE AS q, 0.180625::DOUBLE - (p - 0.5::DOUBLE) * (p - 0.5::DOUBLE) AS m, sqrt(-ln(least(p, 1 - p))) AS d FROM shares),
scored AS (SELECT *, CASE WHEN abs(q) <= 0.425::DOUBLE THEN q * {normal._ratio(normal.MIDDLE, "m")}
  ELSE sign(q) * CASE WHEN d <= 5 THEN {normal._ratio(normal.SHOULDER, "(d - 1.6::DOUBLE)")} ELSE {normal._ratio(normal.TAIL, "(d - 5::DOUBLE)")} END END AS z FROM parts),
ends AS (SELECT column_name, n, sum(z * z) AS squares, max(z) AS top, max(z) FILTER (i = n - 1) AS second FROM scored GROUP BY ALL),
weighed AS (SELECT *, {_poly_sql(normal.LAST_WEIGHT, "(1 / sqrt(n))")} + top / sqrt(squares) AS a1, {_poly_sql(normal.NEXT_WEIGHT, "(1 / sqrt(n))")} + second / sqrt(squares) AS a2 FROM ends),
rest AS (SELECT *, sqrt((squares - 2 * top * top - 2 * second * second) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS r FROM weighed),
tested AS (SELECT s.column_name, s.n, power(sum(x * CASE WHEN i = s.n THEN a1 WHEN i = 1 THEN -a1 WHEN i = s.n - 1 THEN a2 WHEN i = 2 THEN -a2 ELSE z / r END), 2) / sum(x * x) AS w
  FROM scored s JOIN rest USING (column_name) GROUP BY ALL)
SELECT column_name, n, round(w, 6) AS statistic,
  (ln(1 - w) - ({_poly_sql(normal.LARGE_MEAN, "ln(n)")})) / exp({_poly_sql(normal.LARGE_SPREAD, "ln(n)")}) < 1.6448536269514722::DOUBLE AS normal FROM tested""",
)
def profile_shapiro(t: Tables):
    return rounded(normal.shapiro(t.feed), "statistic").drop("p_value")


@query(
    "profile_summary",
    uses=("feed_dup",),
    sql=f"""SELECT count(*) AS total_records, {WIDTH} AS total_features, {WIDTH - len(TEXTS)} AS numeric_features, {len(TEXTS)} AS categorical_features,
  {MISSING_SUM} AS missing_values, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM feed_dup)) AS duplicate_rows,
  round(count(*) FILTER (WHERE loan_status = 1) * 100.0::DOUBLE / count(*), 6) AS default_rate,
  round(count(*) FILTER (WHERE loan_status = 0) * 100.0::DOUBLE / count(*), 6) AS non_default_rate FROM feed_dup""",
)
def profile_summary(t: Tables):
    return rounded(ops.summary(t.feed_dup), "default_rate", "non_default_rate")
