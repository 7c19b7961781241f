"""Exact quantiles, running totals and rank statistics without one big task.

Spark's own ``percentile`` and ``median`` keep every distinct value of a group in one
task. Here values are counted first and the counts cut into slices, as many as their
number asks for, so a task orders one slice and the last step one row per slice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlens.session import staged

#: Relative rank error of the sketch is one over this.
ACCURACY = 10000
#: Distinct values that a slice holds, about.
SLICE_VALUES = 1_000_000


def number(name: str) -> Column:
    """A column as double, with NaN as null: statistics leave both out."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def unpivoted(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Rows (column, value) of numeric columns, as doubles, without nulls."""
    pairs = F.array(
        *[F.struct(F.lit(name).alias("column"), number(name).alias("value")) for name in columns]
    )
    return df.select(*keep, F.inline(pairs)).where(F.col("value").isNotNull())


def _literal(value: float) -> str:
    return f"CAST('{value!r}' AS double)"


def _brackets(cuts: list[float]) -> list[tuple[float, float]]:
    """Disjoint ranges of values from pairs of edges, in order."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(zip(cuts[::2], cuts[1::2])):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> DataFrame:
    """Interpolated quantiles as rows (column, probability, quantile)."""
    return df.sparkSession.createDataFrame(_exact(df, wanted), "column string, probability double, quantile double")


def _exact(df: DataFrame, wanted: dict[str, list[float]]) -> list[tuple[str, float, float]]:
    """Interpolated quantiles as (column, probability, quantile).

    Three scans, all run here. The first sketches each column and brackets every wanted rank. The
    second counts the values below each bracket. The third shuffles and orders the
    values inside the brackets alone (about six in ten thousand rows per quantile, fewer where
    values repeat). The driver gets a few numbers per bracket. The ranks are then exact;
    should a sketch break its promise the query fails instead of giving a near value.
    """
    columns = list(wanted)
    margin = 3.0 / ACCURACY
    asked = {name: sorted(set(wanted[name])) for name in columns}
    # Expressions as text: built one by one they would take longer than the query.
    source = df.select(*[number(name).alias(f"c{i}") for i, name in enumerate(columns)])
    sketched = []
    for i, name in enumerate(columns):
        edges = ", ".join(f"{edge!r}D" for p in asked[name] for edge in (max(0.0, p - margin), min(1.0, p + margin)))
        sketched += [f"count(c{i}) AS n{i}", f"percentile_approx(c{i}, array({edges}), {ACCURACY}) AS cuts{i}"]
    sketch = source.selectExpr(*sketched).first()
    parts = [(i, low, high) for i in range(len(columns)) for low, high in _brackets(sketch[f"cuts{i}"] or [])]
    found: list[tuple[str, float, float]] = []
    if parts:
        around = source.selectExpr(
            *[
                f"struct(count_if(c{i} < {_literal(low)}) AS n, max(CASE WHEN c{i} < {_literal(low)} THEN c{i} END) AS before, "
                f"min(CASE WHEN c{i} > {_literal(high)} THEN c{i} END) AS after) AS p{k}"
                for k, (i, low, high) in enumerate(parts)
            ]
        ).first()
        inside = [f"c{i} BETWEEN {_literal(low)} AND {_literal(high)}" for i, low, high in parts]
        cells = ", ".join(f"CASE WHEN {test} THEN struct({k} AS part, c{parts[k][0]} AS value) END" for k, test in enumerate(inside))
        held = (
            source.where(" OR ".join(inside))
            .selectExpr(f"inline(filter(array({cells}), x -> x IS NOT NULL))")
            .groupBy("part", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        ranked = with_running_total(staged(held, "bracketed"), ["part"], "n", fixed=True)
        # Wanted ranks, counted from the start of the bracket that their probability is in.
        positions, ranks = [], {k: set() for k in range(len(parts))}
        for i, name in enumerate(columns):
            n, cuts = sketch[f"n{i}"], sketch[f"cuts{i}"] or []
            for p, low in zip(asked[name], cuts[::2]):
                k = next(k for k, (j, a, b) in enumerate(parts) if j == i and a <= low <= b)
                position = p * max(n - 1, 0)
                below, above = math.floor(position) - around[f"p{k}"]["n"], math.ceil(position) - around[f"p{k}"]["n"]
                positions.append((name, p, k, below, above, position - math.floor(position)))
                ranks[k] |= {below, above}
        lists = ", ".join(f"{k}, array({', '.join(f'{r}L' for r in sorted(own))})" for k, own in ranks.items())
        first = "upto - n"
        rows = ranked.where(f"exists(element_at(map({lists}), part), r -> {first} <= r AND r < upto)").collect()
        sizes = {r["part"]: r["n_all"] for r in rows}

        def value_at(k: int, rank: int) -> float:
            for r in rows:
                if r["part"] == k and r["upto"] - r["n"] <= rank < r["upto"]:
                    return r["value"]
            edge = around[f"p{k}"]["before"] if rank == -1 else around[f"p{k}"]["after"] if rank == sizes.get(k) else None
            if edge is None:
                raise ValueError("quantile rank outside its bracket")
            return edge

        for name, p, k, below, above, share in positions:
            lower, upper = value_at(k, below), value_at(k, above)
            found.append((name, p, lower + (upper - lower) * share if upper != lower else lower))
    return found


def quantile_values(
    df: DataFrame, wanted: dict[str, list[float]], method: str = "exact"
) -> dict[str, dict[float, float | None]]:
    """Quantiles as driver-side numbers, one per wanted (column, probability).

    Thresholds are few and small; as literals they keep the plans that use them
    short and let Spark push them down.
    """
    if method == "approx":
        row = df.agg(
            *[F.percentile_approx(number(name), F.array(*[F.lit(p) for p in ps]), ACCURACY).alias(name) for name, ps in wanted.items()]
        ).first()
        return {name: dict(zip(ps, row[name] or [None] * len(ps))) for name, ps in wanted.items()}
    found = {(name, p): value for name, p, value in _exact(df, wanted)}
    return {name: {p: found.get((name, p)) for p in ps} for name, ps in wanted.items()}


def group_counts(df: DataFrame, series: dict[str, tuple[list[Column], str]]) -> DataFrame:
    """Rows (series, group, value, n) of several columns, each by groups of its own, from one pass; stored.

    ``series`` has the group columns and the column counted. A group is a list of texts and null
    where any of its columns is; values may be null. Copies collapse before the shuffle.
    """
    cells = []
    for name, (groups, column) in series.items():
        keys = [g.cast("string") for g in groups]
        known = F.lit(True)
        for key in keys:
            known = known & key.isNotNull()
        cells.append(
            F.struct(F.lit(name).alias("series"), F.when(known, F.array(*keys)).alias("group"), number(column).alias("value"))
        )
    counted = df.select(F.inline(F.array(*cells))).groupBy("series", "group", "value").agg(F.count(F.lit(1)).alias("n"))
    return staged(counted, "group-values")


def count_medians(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Exact median per key of stored counts (keys, value, n); null values have no part."""
    ranked = with_running_total(counts.where(F.col("value").isNotNull()), keys, "n", fixed=False)
    first, last = F.floor((F.col("n_all") - 1) / 2), F.floor(F.col("n_all") / 2)
    start = F.col("upto") - F.col("n")
    holds = [(start <= rank) & (rank < F.col("upto")) for rank in (first, last)]
    return (
        ranked.where(holds[0] | holds[1])
        .groupBy(*keys)
        .agg(*[F.max(F.when(held, F.col("value"))).alias(name) for held, name in zip(holds, ("lower", "upper"))])
        .select(*keys, ((F.col("lower") + F.col("upper")) / 2).alias("median"))
    )


def group_medians(counts: DataFrame) -> DataFrame:
    """Exact median by series and group of ``group_counts``; a null group has none."""
    return count_medians(counts.where(F.col("group").isNotNull()), ["series", "group"])


def filled_medians(counts: DataFrame, medians: DataFrame) -> dict[str, float | None]:
    """Median of each series after its null values took the median of their group, where that has one."""
    joined = counts.join(medians, ["series", "group"], "left")
    filled = joined.groupBy("series", F.coalesce("value", "median").alias("value")).agg(F.sum("n").alias("n"))
    return {r["series"]: r["median"] for r in count_medians(staged(filled, "filled-values"), ["series"]).collect()}


def with_running_total(counts: DataFrame, keys: list[str], measure: str, fixed: bool = True) -> DataFrame:
    """Add ``upto``, the sum of a measure up to each value of its key, and ``<measure>_all``.

    ``counts`` is stored: it is read more than once.
    """
    slices = slices_of(counts)
    if slices == 1:
        ordered = Window.partitionBy(*keys).orderBy("value")
        whole = Window.partitionBy(*keys)
        return counts.withColumns({"upto": F.sum(measure).over(ordered), f"{measure}_all": F.sum(measure).over(whole)})
    placed = in_ranges(counts, [measure], keys, fixed, slices)
    inside = Window.partitionBy(*keys, "range").orderBy("value")
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*keys, "range").agg(F.sum(measure).alias("__in"))
    starts = starts.withColumn("__start", F.coalesce(F.sum("__in").over(before), F.lit(0))).drop("__in")
    return (
        placed.withColumn("upto", F.sum(measure).over(inside))
        .join(starts, [*keys, "range"])
        .withColumn("upto", F.col("upto") + F.col("__start"))
        .drop("__start")
    )


def value_counts(df: DataFrame, columns: list[str], measures: dict[str, Column], keep: list[str] = ()) -> DataFrame:
    """Sums of the measures per (column, value); copies collapse before the shuffle."""
    return unpivoted(df, columns, keep).groupBy("column", "value").agg(
        *[F.sum(measure).alias(name) for name, measure in measures.items()]
    )


def slices_of(counts: DataFrame) -> int:
    """How many slices stored counts are cut into, so that a task orders about ``SLICE_VALUES`` rows."""
    return max(1, -(-counts.count() // SLICE_VALUES))


def in_ranges(
    counts: DataFrame, measures: list[str], keys: list[str] = ["column"], fixed: bool = True, slices: int | None = None
) -> DataFrame:
    """Add ``range``, an ordered slice of each key's distinct values, and ``<measure>_all``.

    ``counts`` is stored. Rows are dealt by range of (keys, value) into as many slices as their
    number asks for, with no upper limit, and stored with the number of their slice. Results never depend
    on where the cuts fall; rows that fit one slice stay where they are. ``fixed`` says that the keys are a fixed
    list of columns, whose totals are few enough to broadcast.
    """
    slices = slices or slices_of(counts)
    placed = counts.withColumn("range", F.lit(0))
    if slices > 1:
        dealt = counts.repartitionByRange(slices, *keys, "value")
        placed = staged(dealt.withColumn("range", F.spark_partition_id()), "slices")
    totals = placed.groupBy(*keys).agg(*[F.sum(name).alias(f"{name}_all") for name in measures])
    return placed.join(F.broadcast(totals) if fixed else totals, keys)


def largest_gap(counts: DataFrame, left: str, right: str) -> DataFrame:
    """Largest distance of two cumulative distributions per column.

    ``counts`` has (column, value, left, right). Running totals are taken inside
    each slice, every slice is reduced to its totals and extreme gaps, and the
    slices are chained: no task sees more than one slice, and the last step
    only one row per slice.
    """
    left_all, right_all = f"{left}_all", f"{right}_all"
    inside = Window.partitionBy("column", "range").orderBy("value")
    gap = F.sum(left).over(inside) / F.col(left_all) - F.sum(right).over(inside) / F.col(right_all)
    slices = (
        in_ranges(staged(counts, "value-counts"), [left, right])
        .withColumn("gap", gap)
        .groupBy("column", "range", F.col(left_all).alias("left_all"), F.col(right_all).alias("right_all"))
        .agg(
            F.sum(left).alias("left_in"),
            F.sum(right).alias("right_in"),
            F.min("gap").alias("gap_min"),
            F.max("gap").alias("gap_max"),
        )
    )
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("left_in").over(before), F.lit(0)) / F.col("left_all") - F.coalesce(
        F.sum("right_in").over(before), F.lit(0)
    ) / F.col("right_all")
    return (
        slices.withColumn("start", start)
        .groupBy("column", "left_all", "right_all")
        .agg(
            F.max(
                F.greatest(F.abs(F.col("start") + F.col("gap_min")), F.abs(F.col("start") + F.col("gap_max")))
            ).alias("gap")
        )
    )


def area_under_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve as one row, ties counted half.

    Counts per distinct score first, then slices as in ``largest_gap``: a slice
    needs only the number of negatives below it to finish its own sum.
    """
    positive, negative = F.when(F.col(label) == 1, 1).otherwise(0), F.when(F.col(label) == 0, 1).otherwise(0)
    counts = value_counts(
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull()),
        [score],
        {"pos": positive, "neg": negative},
        keep=[label],
    )
    inside = Window.partitionBy("column", "range").orderBy("value")
    below = F.sum("neg").over(inside) - F.col("neg")
    slices = (
        in_ranges(staged(counts, "value-counts"), ["pos", "neg"])
        .withColumn("pairs", F.col("pos") * (below + F.col("neg") / F.lit(2.0)))
        .groupBy("column", "range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("pairs").alias("pairs"))
    )
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        slices.withColumn("start", F.coalesce(F.sum("neg").over(before), F.lit(0)))
        .agg(
            F.sum(F.col("pairs") + F.col("pos") * F.col("start").cast("double")).alias("pairs"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
        )
        .select(
            F.try_divide(F.col("pairs"), F.col("pos").cast("double") * F.col("neg").cast("double")).alias("auc"),
            F.col("pos").alias("positives"),
            F.col("neg").alias("negatives"),
        )
    )
