"""A stored baseline that merges: one quantile sketch per column and day.

Drift then needs no second look at the old rows. A day is sketched once, when it is
over; a window of days is the merge of their sketches, a few kilobytes per column whatever the
rows behind it. Ranks are off by at most about ``ERROR`` of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.operators.monitoring import PSI_LIMIT
from creditlens.operators.quantiles import unpivoted
from creditlens.schemas import NUMERIC_FEATURES

#: Size of the sketches; their rank error, two-sided at 99 %, is about 2.5 over it.
SIZE = 800
ERROR = 2.5 / SIZE
#: Points of both distributions at which a drift is looked for, and bins of the stability index.
POINTS = 400
BINS = 10


def daily(df: DataFrame, day: Column, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Rows (column_name, day, n, total, low, high, sketch); days and columns without values have none."""
    cells = unpivoted(df.withColumn("__day", day), columns, ["__day"])
    return cells.groupBy(F.col("column").alias("column_name"), F.col("__day").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.kll_sketch_agg_double("value", SIZE).alias("sketch"),
    )


def window(stored: DataFrame) -> DataFrame:
    """One row per column from the stored days of a window."""
    return stored.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        (F.sum("total") / F.sum("n")).alias("mean"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch", SIZE).alias("sketch"),
    )


def quantile(sketch: Column | str, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(share)))


def drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Distance of the distributions and stability index by column, from two windows' sketches alone.

    The distance is the largest gap of the two distributions at ``POINTS`` quantiles of each; the
    index counts the current rows in the baseline's quantile bins.
    """
    both = baseline.select("column_name", F.col("sketch").alias("old")).join(
        current.select("column_name", F.col("sketch").alias("new"), "n"), "column_name"
    )
    shares = F.array(*[F.lit((i - 0.5) / POINTS) for i in range(1, POINTS + 1)])
    listed = both.withColumns({f"{side}_q": F.kll_sketch_get_quantile_double(side, shares) for side in ("old", "new")})
    cuts = F.array_distinct(F.kll_sketch_get_quantile_double("old", F.array(*[F.lit(i / BINS) for i in range(1, BINS)])))
    listed = listed.withColumns({"points": F.concat("old_q", "new_q"), "cuts": cuts})

    def ranks(side: str, at: str) -> Column:
        """The share of the side's quantiles up to each point: its distribution, to half a step."""
        return F.transform(at, lambda v: F.size(F.filter(f"{side}_q", lambda q: q <= v)) / F.lit(float(POINTS)))

    ranked = listed.withColumns({f"{side}_{at}": ranks(side, at) for side in ("old", "new") for at in ("points", "cuts")})
    gaps = F.zip_with("old_points", "new_points", lambda a, b: F.abs(a - b))

    def steps(name: str) -> Column:
        whole = F.concat(F.array(F.lit(0.0)), F.col(name), F.array(F.lit(1.0)))
        return F.transform(F.slice(whole, 2, F.size(whole) - 1), lambda x, i: x - F.element_at(whole, i + 1))

    term = F.zip_with(
        steps("old_cuts"), steps("new_cuts"), lambda a, b: F.when((a > 0) & (b > 0), (b - a) * F.log(b / a)).otherwise(F.lit(0.0))
    )
    psi = F.aggregate(term, F.lit(0.0), lambda s, x: s + x)
    return ranked.select("column_name", F.array_max(gaps).alias("distance"), psi.alias("psi")).withColumn("drift_detected", F.col("psi") > PSI_LIMIT)
