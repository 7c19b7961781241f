"""Quantiles, ranks, splits and test statistics against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlens.functions.special import chi_square_p_value, ks_p_value
from creditlens.operators import features, monitoring, profiling, quality, quantiles
from creditlens.operators.features import split_by_hash, split_stratified
from creditlens.operators.quantiles import area_under_roc, exact_quantiles, largest_gap, quantile_values, value_counts

RANDOM = np.random.default_rng(7)
SAMPLES = {
    "uniform": RANDOM.uniform(-5, 5, 30000),
    # A third of all rows hold one value.
    "hot": np.concatenate([np.full(10000, 42.0), RANDOM.normal(40, 3, 20000)]),
    "heavy_tail": np.exp(RANDOM.normal(0, 6, 30000)),
    "few": RANDOM.integers(0, 3, 5000).astype(float),
    "one": np.array([3.5]),
    "two": np.array([1.0, 2.0]),
    "five": np.array([5.0, 1.0, 4.0, 2.0, 3.0]),
}


def frame_of(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double").repartition(7)


@pytest.mark.parametrize("name", SAMPLES)
def test_quantiles_are_exact(spark, name):
    values = SAMPLES[name]
    probabilities = [0.0, 0.01, 0.25, 0.3, 0.5, 0.75, 0.99, 1.0]
    found = quantile_values(frame_of(spark, values), {"x": probabilities})["x"]
    for p in probabilities:
        assert found[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_quantiles_skip_nulls_and_empty_columns(spark):
    frame = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "x double, y double")
    rows = {r["column"]: r["quantile"] for r in exact_quantiles(frame, {"x": [0.5], "y": [0.5]}).collect()}
    assert rows == {"x": 2.0}
    assert quantile_values(frame, {"y": [0.5]}) == {"y": {0.5: None}}
    assert quantile_values(frame.where("false"), {"x": [0.5]}) == {"x": {0.5: None}}


def test_nan_counts_as_missing(spark):
    frame = frame_of(spark, [1.0, float("nan"), 3.0]).withColumn("person_age", F.col("x"))
    assert quantile_values(frame, {"x": [0.5], "person_age": [0.5]}) == {"x": {0.5: 2.0}, "person_age": {0.5: 2.0}}


def test_small_domains_take_the_plain_way(spark):
    frame = spark.createDataFrame([(v, float(v)) for v in range(1, 10)], "person_age int, person_income double")
    found = quantile_values(frame, {"person_age": [0.25, 0.5], "person_income": [0.25, 0.5]})
    assert found == {"person_age": {0.25: 3.0, 0.5: 5.0}, "person_income": {0.25: 3.0, 0.5: 5.0}}


@pytest.mark.parametrize("scores", ["continuous", "tied", "hot"])
def test_auc_against_all_pairs(spark, scores):
    labels = RANDOM.integers(0, 2, 600)
    values = {
        "continuous": RANDOM.uniform(0, 1, 600) + labels * 0.2,
        "tied": RANDOM.integers(0, 5, 600) / 4.0,
        "hot": np.where(np.arange(600) % 3 == 0, 0.5, RANDOM.uniform(0, 1, 600)),
    }[scores]
    frame = spark.createDataFrame(list(zip(values.tolist(), labels.tolist())), "s double, y int").repartition(5)
    pos, neg = values[labels == 1], values[labels == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert area_under_roc(frame, "s", "y").first()["auc"] == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    frame = spark.createDataFrame([(0.1, 1), (0.9, 1)], "s double, y int")
    assert area_under_roc(frame, "s", "y").first()["auc"] is None


def test_largest_gap_against_sorting(spark):
    left, right = RANDOM.normal(0, 1, 3000), RANDOM.normal(0.1, 1.2, 2000)
    rows = [(float(v), 0) for v in left] + [(float(v), 1) for v in right]
    frame = spark.createDataFrame(rows, "x double, side int").repartition(6)
    counts = value_counts(
        frame,
        ["x"],
        {"l": F.when(F.col("side") == 0, 1).otherwise(0), "r": F.when(F.col("side") == 1, 1).otherwise(0)},
        keep=["side"],
    )
    grid = np.sort(np.concatenate([left, right]))
    expected = np.abs(
        np.searchsorted(np.sort(left), grid, "right") / 3000 - np.searchsorted(np.sort(right), grid, "right") / 2000
    ).max()
    assert largest_gap(counts, "l", "r").first()["gap"] == pytest.approx(expected, abs=1e-12)


# Known tail probabilities of the chi-square distribution.
@pytest.mark.parametrize(
    "statistic, df, p",
    [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (16.918977604620448, 9, 0.05), (6.6348966, 1, 0.01), (0.0, 3, 1.0), (9000.0, 4, 0.0)],
)
def test_chi_square_tail(spark, statistic, df, p):
    frame = spark.createDataFrame([(statistic, df)], "s double, df int")
    assert frame.select(chi_square_p_value(F.col("s"), F.col("df")).alias("p")).first()["p"] == pytest.approx(p, abs=1e-8)


def test_ks_tail(spark):
    # At a scaled distance of 1.358099 the asymptotic tail is 0.05.
    frame = spark.createDataFrame([(1.358099 / math.sqrt(500), 1000, 1000), (0.0, 10, 10)], "d double, n bigint, m bigint")
    found = [r["p"] for r in frame.select(ks_p_value(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    assert found == [pytest.approx(0.05, abs=1e-5), 1.0]


def test_psi_against_histogram(spark):
    base, now = RANDOM.normal(0, 1, 4000), RANDOM.normal(0.5, 1, 3000)
    edges = np.linspace(min(base.min(), now.min()), max(base.max(), now.max()), 11)
    b, c = np.histogram(base, edges)[0] / 4000, np.histogram(now, edges)[0] / 3000
    keep = (b > 0) & (c > 0)
    expected = ((c - b)[keep] * np.log(c[keep] / b[keep])).sum()
    row = monitoring.drift_psi(frame_of(spark, base), frame_of(spark, now), ["x"]).first()
    assert row["psi"] == pytest.approx(expected, abs=1e-9) and row["drift_detected"]


def test_splits_do_not_depend_on_partitioning(spark):
    frame = spark.range(2000).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    few, many = frame.coalesce(1), frame.repartition(13)
    assert set(split_by_hash(few, "id").where("split = 'train'").collect()) == set(
        split_by_hash(many, "id").where("split = 'train'").collect()
    )


def test_stratified_split_is_exact_per_class(spark):
    frame = spark.range(5003).withColumn("y", (F.col("id") % 10 == 0).cast("int")).repartition(9)
    counts = {
        (r["y"], r["split"]): r["count"]
        for r in split_stratified(frame, "id", "y", {"train": 0.8, "test": 0.2}).groupBy("y", "split").count().collect()
    }
    for label, total in ((0, 4502), (1, 501)):
        assert counts[(label, "train")] == math.floor(total * 0.8)
        assert counts[(label, "test")] == total - math.floor(total * 0.8)


def test_quality_of_an_empty_and_an_all_null_table(spark):
    columns = (
        "person_age int, person_income double, person_emp_length double, loan_amnt double, loan_int_rate double, "
        "loan_percent_income double, loan_grade string, loan_status int"
    )
    empty = spark.createDataFrame([], columns)
    row = quality.dimensions(empty, "2001-08-02").first()
    assert row["completeness"] is None and row["uniqueness"] is None
    nulls = spark.createDataFrame([(None,) * 8] * 3, columns)
    row = quality.dimensions(nulls, "2001-08-02").first()
    assert row["completeness"] == 0.0 and row["validity"] == 0.0
    assert row["uniqueness"] == pytest.approx(1 / 3)


@pytest.fixture
def narrow_slices(monkeypatch):
    """Few values per slice, so that small frames need many slices."""
    monkeypatch.setattr(quantiles, "SLICE_VALUES", 40)


def test_quantiles_of_distinct_doubles_over_many_slices(spark, narrow_slices):
    values = [((i * 7919) % 3001) / 7 for i in range(3001)]
    frame = spark.createDataFrame([(v, i % 3 if i % 5 else None) for i, v in enumerate(values)], "x double, g int")
    wanted = [0.0, 0.13, 0.5, 0.999, 1.0]
    found = quantiles.quantile_values(frame, {"x": wanted})["x"]
    assert [found[p] for p in wanted] == pytest.approx([float(np.quantile(values, p)) for p in wanted])
    counts = quantiles.group_counts(frame, {"x": ([F.col("g")], "x")})
    medians = {int(r["group"][0]): r["median"] for r in quantiles.group_medians(counts).collect()}
    assert set(medians) == {0, 1, 2}
    for group in medians:
        own = [v for i, v in enumerate(values) if (i % 3 if i % 5 else None) == group]
        assert medians[group] == pytest.approx(float(np.median(own)))
    ranges = quantiles.in_ranges(frame.select(F.lit("x").alias("column"), F.col("x").alias("value"), F.lit(1).alias("n")), ["n"])
    sizes = [r["count"] for r in ranges.groupBy("range").count().collect()]
    assert len(sizes) > 60 and max(sizes) <= 60


def test_medians_after_filling(spark):
    rows = [("a", 1.0, None), ("a", 3.0, 2.0), ("a", None, None), (None, None, 8.0), (None, 9.0, 4.0), ("b", None, 4.0)]
    frame = spark.createDataFrame(rows, "g string, x double, y double")
    counts = quantiles.group_counts(frame, {"x": ([F.col("g")], "x"), "y": ([F.col("g"), F.col("x").isNull()], "y")})
    medians = quantiles.group_medians(counts)
    assert {(r["series"], tuple(r["group"])): r["median"] for r in medians.collect()} == {
        ("x", ("a",)): 2.0,
        ("y", ("a", "false")): 2.0,
        ("y", ("b", "true")): 4.0,
    }
    # x becomes 1, 3, 2, null, 9, null; y becomes 2, 2, null, 8, 4, 4.
    assert quantiles.filled_medians(counts, medians) == {"x": 2.5, "y": 4.0}


def test_area_and_gap_over_many_slices(spark, narrow_slices):
    rows = [(i, ((i * 37) % 500) / 500, int((i * 53) % 500 > (i * 37) % 500)) for i in range(500)]
    frame = spark.createDataFrame(rows, "id int, score double, label int")
    pos = [s for _, s, y in rows if y]
    neg = [s for _, s, y in rows if not y]
    expected = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert quantiles.area_under_roc(frame, "score", "label").first()["auc"] == pytest.approx(expected)


def test_nan_is_missing_in_drift_and_profiles(spark):
    clean = spark.createDataFrame([(float(i),) for i in range(1, 6)] * 4, "x double")
    dirty = clean.union(spark.createDataFrame([(float("nan"),)], "x double"))
    other = spark.createDataFrame([(float(i),) for i in range(3, 9)] * 4, "x double")
    for side in (clean, dirty):
        assert monitoring.drift_psi(side, other, ["x"]).first()["psi"] == pytest.approx(monitoring.drift_psi(clean, other, ["x"]).first()["psi"])
    assert monitoring.drift_psi(dirty, other, ["x"]).first()["psi"] > 0
    assert profiling.describe(dirty, ["x"]).collect() == profiling.describe(clean, ["x"]).collect()
    for test in (profiling.skewness, profiling.kurtosis, profiling.normality):
        assert test(dirty, ["x"]).collect() == test(clean, ["x"]).collect()
    pairs = [frame.withColumn("y", F.col("x") * 2) for frame in (clean, dirty)]
    assert [profiling.correlations(p, ["x", "y"]).first()["correlation"] for p in pairs] == [pytest.approx(1.0)] * 2


def test_null_labels_are_split_like_a_class(spark):
    frame = spark.range(300).withColumn("y", F.when(F.col("id") < 100, F.lit(None)).otherwise(F.col("id") % 2).cast("int"))
    shares = features.split_stratified(frame, "id", "y", {"train": 0.8, "test": 0.2}).groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]): r["count"] for r in shares} == {(y, s): n for y in (None, 0, 1) for s, n in (("train", 80), ("test", 20))}


def test_every_level_is_encoded(spark):
    frame = spark.range(1000).select(F.concat(F.lit("l"), F.col("id") % 500).alias("c"))
    levels = features.levels_of(frame, ["c"])
    assert len(levels["c"]) == 500 and len(features.dummies(frame, levels, False).columns) == 500
    (indexer,) = features.indexers(frame, ["c"])
    assert len(indexer.labels) == 500


def exact_tail(statistic, df):
    """The chi-square tail by sums of exact terms; df even."""
    from decimal import Decimal, getcontext

    getcontext().prec = 50
    x, total, term = Decimal(statistic) / 2, Decimal(0), Decimal(1)
    for k in range(df // 2):
        total += term
        term = term * x / (k + 1)
    return float(total * (-x).exp())


def test_chi_square_tail_to_ten_digits_at_any_size(spark):
    rows = [(df * f, df) for df in (2, 4, 10, 100, 1000, 20_000) for f in (0.01, 0.5, 0.9, 1.0, 1.1, 2.0, 5.0)]
    frame = spark.createDataFrame(rows + [(1e6 + 1500.0, 10**6), (1.0, 10**6)], "s double, df int")
    found = [r["p"] for r in frame.select(chi_square_p_value(F.col("s"), F.col("df")).alias("p")).collect()]
    for (s, df), p in zip(rows, found):
        assert p == pytest.approx(exact_tail(s, df), rel=1e-10, abs=1e-300)
    # Half degrees, by the error function; and the normal limit far out.
    halves = spark.createDataFrame([(v, 1) for v in (1e-6, 0.3, 1.0, 4.0, 60.0, 900.0)], "s double, df int")
    for r in halves.select("s", chi_square_p_value(F.col("s"), F.col("df")).alias("p")).collect():
        assert r["p"] == pytest.approx(math.erfc(math.sqrt(r["s"] / 2)), rel=1e-9)
    assert found[-2] == pytest.approx(0.5 * math.erfc(1500 / math.sqrt(2e6) / math.sqrt(2)), abs=1e-3) and found[-1] == 1.0


# Shapiro-Wilk

WEIGHTS_GIVEN = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]


def plain_shapiro(values):
    from statistics import NormalDist

    from creditlens.operators import normal

    x, n = np.sort(np.asarray(values, float)), len(values)
    score = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    squares, u = math.fsum(s * s for s in score), 1 / math.sqrt(n)
    last = normal._poly(normal.LAST_WEIGHT, u) + score[-1] / math.sqrt(squares)
    second = normal._poly(normal.NEXT_WEIGHT, u) + score[-2] / math.sqrt(squares)
    rest = (squares - 2 * score[-1] ** 2 - 2 * score[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)
    a = [-last, -second, *[s / math.sqrt(rest) for s in score[2:-2]], second, last]
    return math.fsum(w * v for w, v in zip(a, x)) ** 2 / math.fsum((x - x.mean()) ** 2)


def test_shapiro_of_a_published_example(spark):
    from creditlens.operators.normal import shapiro

    row = shapiro(frame_of(spark, WEIGHTS_GIVEN), ["x"]).first()
    assert row["statistic"] == pytest.approx(0.79, abs=0.005) and row["p_value"] == pytest.approx(0.0067, abs=0.0005) and not row["normal"]


@pytest.mark.parametrize("kind", ["normal", "uniform", "ties", "hot", "few"])
def test_shapiro_equals_a_plain_computation(spark, monkeypatch, kind):
    from creditlens.operators import normal

    rng = np.random.default_rng(11)
    values = {
        "normal": rng.normal(50_000, 9_000, 6000),
        "uniform": rng.uniform(0, 1, 3000),
        "ties": np.round(rng.normal(0, 3, 9000)),
        "hot": np.concatenate([np.full(4000, 0.25), rng.normal(0, 1, 6000)]),
        "few": rng.normal(0, 1, 9),
    }[kind]
    row = normal.shapiro(frame_of(spark, values), ["x"]).first()
    assert row["n"] == len(values) and row["statistic"] == pytest.approx(plain_shapiro(values), abs=1e-9)
    monkeypatch.setattr(quantiles, "SLICE_VALUES", 500)
    assert normal.shapiro(frame_of(spark, values), ["x"]).first()["statistic"] == pytest.approx(row["statistic"], abs=1e-12)


def test_shapiro_edges(spark):
    from creditlens.operators.normal import shapiro

    frame = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (4.0, 5.0, float("nan")), (None, 5.0, 1.0)], "a double, b double, c double")
    rows = {r["column_name"]: r for r in shapiro(frame, ["a", "b", "c"]).collect()}
    assert rows["a"]["statistic"] == pytest.approx(0.9643, abs=1e-4) and rows["a"]["p_value"] == pytest.approx(0.6369, abs=1e-4)
    assert rows["b"]["statistic"] is None and rows["c"]["n"] == 1 and rows["c"]["p_value"] is None


def test_normal_quantile_in_sql(spark):
    from statistics import NormalDist

    from creditlens.operators.normal import quantiles_sql

    points = [1e-300, 1e-20, 1e-9, 1e-4, 0.01, 0.0749, 0.0751, 0.3, 0.5, 0.77, 0.93, 0.999, 1 - 1e-12]
    found = spark.createDataFrame([(points,)], "p array<double>").select(F.expr(quantiles_sql("p")).alias("z")).first()["z"]
    assert found == pytest.approx([NormalDist().inv_cdf(p) for p in points], rel=1e-12, abs=1e-15)


def test_stored_baselines_merge_and_keep_their_rank_bound(spark):
    from creditlens.operators import baselines

    rng = np.random.default_rng(21)
    values = np.concatenate([rng.normal(0, 1, 15_000), np.full(5_000, 0.3)])
    rng.shuffle(values)
    rows = [(float(v) if i % 50 else None, i % 40) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "x double, d int").repartition(5)
    days = baselines.daily(frame, F.col("d"), ["x"])
    assert days.agg(F.sum("n")).first()[0] == frame.where("x IS NOT NULL").count()
    kept = np.sort([v for v, _ in rows if v is not None])
    merged = baselines.window(days.repartition(3))
    shares = [0.01, 0.1, 0.25, 0.5, 0.6, 0.75, 0.99]
    asked = [baselines.quantile("sketch", p).alias(f"q{i}") for i, p in enumerate(shares)]
    row = merged.select("n", "mean", "low", "high", *asked).first()
    assert row["n"] == len(kept) and row["low"] == kept[0] and row["high"] == kept[-1] and row["mean"] == pytest.approx(kept.mean())
    for i, p in enumerate(shares):
        below, upto = (np.searchsorted(kept, row[f"q{i}"], side) / len(kept) for side in ("left", "right"))
        assert below - 3 * baselines.ERROR <= p <= upto + 3 * baselines.ERROR


def test_drift_from_stored_baselines(spark):
    from creditlens.operators import baselines

    rng = np.random.default_rng(22)
    base, same, moved = rng.normal(0, 1, 8000), rng.normal(0, 1, 8000), rng.normal(0.8, 1, 8000)

    def stored(values):
        return baselines.window(baselines.daily(frame_of(spark, values).withColumn("d", F.lit(1)), F.col("d"), ["x"]))

    calm, shifted = (baselines.drift(stored(base), stored(v)).first() for v in (same, moved))
    grid = np.sort(np.concatenate([base, moved]))
    gap = np.abs(np.searchsorted(np.sort(base), grid, "right") - np.searchsorted(np.sort(moved), grid, "right")).max() / 8000
    assert shifted["distance"] == pytest.approx(gap, abs=6 * baselines.ERROR + 1 / baselines.POINTS) and shifted["drift_detected"]
    assert calm["distance"] < 0.06 and not calm["drift_detected"]
    edges = np.quantile(base, np.linspace(0, 1, 11)[1:-1])
    a, b = (np.histogram(v, [-np.inf, *edges, np.inf])[0] / 8000 for v in (base, moved))
    assert shifted["psi"] == pytest.approx(((b - a) * np.log(b / a)).sum(), rel=0.1)
