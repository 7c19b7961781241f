"""Shapiro-Wilk test over all rows, by global ranks.

The statistic weighs order statistics with normal scores of their ranks. Values are counted
and ranked in slices, so a value's ranks are known without a sort of the whole column, and a value that
holds many ranks takes the sum of their scores in closed form. Per column a few sums
reach the driver.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.operators.quantiles import value_counts, with_running_total
from creditlens.schemas import NUMERIC_FEATURES
from creditlens.session import staged

# Coefficients of the rational approximations of the normal quantile (AS 241),
# highest power last, for the middle, the shoulders and the tails.
MIDDLE = (
    [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4]
    + [4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3],
    [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3]
    + [2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3],
)
SHOULDER = (
    [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0]
    + [1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4],
    [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1]
    + [1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9],
)
TAIL = (
    [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1]
    + [2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
    [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2]
    + [7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15],
)
# Polynomials of the test's weights and of its p-value, lowest power first.
LAST_WEIGHT = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
NEXT_WEIGHT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SMALL_MEAN = [0.544, -0.39978, 0.025054, -6.714e-4]
SMALL_SPREAD = [1.3822, -0.77857, 0.062767, -0.0020322]
LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
LARGE_SPREAD = [-0.4803, -0.082676, 0.0030302]
SMALL_LIMIT = [-2.273, 0.459]
FEW = 11

#: Ranks of one value that are summed one by one; more are summed in closed form between the edges.
SINGLE = 1024
EDGE = 64


def _number(x: float) -> str:
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def _ratio(parts, variable: str) -> str:
    def horner(values) -> str:
        text = _number(values[-1])
        for value in reversed(values[:-1]):
            text = f"({text} * {variable} + {_number(value)})"
        return text

    return f"({horner(parts[0])} / {horner(parts[1])})"


def quantiles_sql(shares: str) -> str:
    """Standard normal quantiles of a list of shares strictly between 0 and 1, as SQL text.

    In two steps, so that what the formula uses often is worked out once.
    """
    parts = "struct(p - 0.5e0 AS q, 0.180625e0 - (p - 0.5e0) * (p - 0.5e0) AS m, sqrt(-ln(least(p, 1e0 - p))) AS d)"
    deep = f"CASE WHEN x.d <= 5e0 THEN {_ratio(SHOULDER, '(x.d - 1.6e0)')} ELSE {_ratio(TAIL, '(x.d - 5e0)')} END"
    one = f"CASE WHEN abs(x.q) <= 0.425e0 THEN x.q * {_ratio(MIDDLE, 'x.m')} ELSE sign(x.q) * {deep} END"
    return f"transform(transform({shares}, p -> {parts}), x -> {one})"


def _scores(ranks: str) -> str:
    """Normal scores of a list of ranks."""
    return quantiles_sql(f"transform({ranks}, i -> (i - 0.375e0) / (n_all + 0.25e0))")


def _sequence(first: str, last: str) -> str:
    whole = f"sequence(CAST({first} AS bigint), CAST({last} AS bigint))"
    return f"CASE WHEN {first} <= {last} THEN transform({whole}, i -> CAST(i AS double)) ELSE array() END"


def with_scores(ranked: DataFrame) -> DataFrame:
    """Add ``score``, the sum of the scores of the ranks from ``first`` to ``upto``.

    Many ranks of one value are summed in closed form (Euler and Maclaurin, by midpoints),
    but for those near the edges.
    """
    edges = f"concat({_sequence('first', f'least(upto, {EDGE})')}, {_sequence(f'greatest(first, n_all - {EDGE - 1})', 'upto')})"
    singles = f"CASE WHEN n <= {SINGLE} THEN {_sequence('first', 'upto')} ELSE {edges} END"
    inside = f"n > {SINGLE} AND greatest(first, {EDGE + 1}) <= least(upto, n_all - {EDGE})"
    ends = f"CASE WHEN {inside} THEN array(greatest(first, {EDGE + 1}) - 0.5e0, least(upto, n_all - {EDGE}) + 0.5e0) ELSE array() END"
    found = ranked.withColumns({"singles": F.expr(singles), "ends": F.expr(ends)})
    found = found.withColumns({"singles": F.expr(_scores("singles")), "ends": F.expr(_scores("ends"))})
    density = f"exp(-z * z / 2e0) / {_number(math.sqrt(2 * math.pi))}"
    found = found.withColumn("ends", F.expr(f"transform(ends, z -> struct(z, (n_all + 0.25e0) * {density} AS height))"))
    third = "7e0 * (1e0 + 2e0 * e.z * e.z) / (e.height * e.height * e.height) / 5760e0"
    found = found.withColumn("ends", F.expr(f"transform(ends, e -> -e.height - 1e0 / (24e0 * e.height) + {third})"))
    total = "aggregate(singles, 0e0, (s, z) -> s + z) + CASE WHEN size(ends) > 0 THEN ends[1] - ends[0] ELSE 0e0 END"
    return found.withColumn("score", F.expr(total)).drop("singles", "ends")


def _squares(n: int) -> float:
    """Sum of the squared scores of all ranks."""
    normal = NormalDist()

    def score(i: float) -> float:
        return normal.inv_cdf((i - 0.375) / (n + 0.25))

    if n <= 4 * SINGLE:
        return math.fsum(score(i) ** 2 for i in range(1, n + 1))
    first, last = EDGE + 1, n - EDGE

    def edge(i: float) -> float:
        z, wide = score(i), n + 0.25
        density = math.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        slope = 1 / (wide * density)
        # The antiderivative of z^2 and two odd derivatives of it.
        below = wide * ((i - 0.375) / wide - z * density)
        third = 2 * slope**3 * (4 * z + 2 * z**3) + 2 * z * slope**3 * (1 + 2 * z * z) - 2 * z * slope**3
        return below - 2 * z * slope / 24 + 7 * third / 5760

    ends = math.fsum(score(i) ** 2 for i in range(1, EDGE + 1))
    return 2 * ends + edge(last + 0.5) - edge(first - 0.5)


def _poly(values: list[float], x: float) -> float:
    return sum(v * x**k for k, v in enumerate(values))


def weights(n: int) -> tuple[float, float, float]:
    """Weights of the last and the last but one order statistic, and what divides the scores of the others."""
    normal = NormalDist()
    if n == 3:
        return math.sqrt(0.5), 0.0, 1.0
    squares = _squares(n)
    top, second = (normal.inv_cdf((n - k - 0.375) / (n + 0.25)) for k in (0, 1))
    u = 1 / math.sqrt(n)
    last = _poly(LAST_WEIGHT, u) + top / math.sqrt(squares)
    if n <= 5:
        return last, second / math.sqrt((squares - 2 * top**2) / (1 - 2 * last**2)), math.sqrt((squares - 2 * top**2) / (1 - 2 * last**2))
    next_ = _poly(NEXT_WEIGHT, u) + second / math.sqrt(squares)
    rest = (squares - 2 * top**2 - 2 * second**2) / (1 - 2 * last**2 - 2 * next_**2)
    return last, next_, math.sqrt(rest)


def p_value(w: float, n: int) -> float:
    """Royston's approximation; made for up to 5,000 rows and carried on beyond."""
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w >= 1:
        return 1.0
    y, x = math.log(1 - w), math.log(n)
    if n <= FEW:
        limit = _poly(SMALL_LIMIT, n)
        if y >= limit:
            return 0.0
        y, mean, spread = -math.log(limit - y), _poly(SMALL_MEAN, n), math.exp(_poly(SMALL_SPREAD, n))
    else:
        mean, spread = _poly(LARGE_MEAN, x), math.exp(_poly(LARGE_SPREAD, x))
    return 0.5 * math.erfc((y - mean) / spread / math.sqrt(2))


def shapiro(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Statistic, p-value and verdict per numeric column over all its rows.

    Fewer than three rows, or one value alone, have no statistic.
    """
    counts = staged(value_counts(df, columns, {"n": F.lit(1)}), "value-counts")
    # One row per column.
    means = counts.groupBy("column").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    ranked = with_running_total(counts, ["column"], "n").join(F.broadcast(means), "column")
    ranked = ranked.withColumns({"first": F.col("upto") - F.col("n") + 1, "away": F.col("value") - F.col("mean")})
    ranked = with_scores(ranked)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (rank <= F.col("upto")), F.col("away")))

    last = F.col("n_all")
    rows = ranked.groupBy("column").agg(
        F.max("n_all").alias("n"),
        F.sum(F.col("score") * F.col("away")).alias("weighed"),
        F.sum(F.col("n") * F.col("away") * F.col("away")).alias("squares"),
        at(F.lit(1)).alias("x1"),
        at(F.lit(2)).alias("x2"),
        at(last - 1).alias("y2"),
        at(last).alias("y1"),
    )
    found = {r["column"]: r for r in rows.collect()}
    out = []
    for name in columns:
        r, w = found.get(name), None
        if r and r["n"] >= 3 and r["squares"] > 0:
            w = statistic(r["n"], r["weighed"], r["squares"], r["x1"], r["x2"], r["y2"], r["y1"])
        p = None if w is None else p_value(w, r["n"])
        out.append((name, r["n"] if r else 0, w, p, None if p is None else p > 0.05))
    return df.sparkSession.createDataFrame(out, "column_name string, n long, statistic double, p_value double, normal boolean")


def statistic(n: int, weighed: float, squares: float, x1: float, x2: float, y2: float, y1: float) -> float:
    """W from the sum of scores times values, the sum of squares and the two values at each end."""
    last, next_, rest = weights(n)
    normal = NormalDist()
    top, second = (normal.inv_cdf((n - k - 0.375) / (n + 0.25)) for k in (0, 1))
    if n == 3:
        total = last * (y1 - x1)
    elif n <= 5:
        total = (weighed - top * (y1 - x1)) / rest + last * (y1 - x1)
    else:
        inside = weighed - top * (y1 - x1) - second * (y2 - x2)
        total = inside / rest + last * (y1 - x1) + next_ * (y2 - x2)
    return min(1.0, total * total / squares)
