"""p-values as column expressions, for results of a few rows."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def ks_p_value(distance: Column, left: Column, right: Column) -> Column:
    """Two-sample Kolmogorov-Smirnov p-value by the asymptotic series.

    Below a scaled distance of 0.2 the p-value is 1 to twelve digits and the series
    converges slowly, so it is not summed there.
    """
    scaled = F.sqrt(left.cast("double") * right / (left.cast("double") + right)) * distance
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


#: Gauss-Legendre nodes of the chi-square tail, and how many powers of e its density falls off in.
NODES = 120
REACH = 32.0


@functools.cache
def _nodes() -> Column:
    places, weights = np.polynomial.legendre.leggauss(NODES)

    def numbers(values: list[float]) -> str:
        return f"transform(split('{','.join(map(repr, values))}', ','), s -> CAST(s AS double))"

    # As two texts: hundreds of literals would take longer than the query.
    return F.expr(f"zip_with({numbers(places.tolist())}, {numbers(weights.tolist())}, (x, w) -> struct(x, w))")


def chi_square_p_value(statistic: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution for any degrees of freedom from 1 on.

    The density in the logarithm of its variable, relative to its peak, integrated beyond the
    statistic and divided by the integral over all. Both take the same fixed number of
    nodes, from where the density is below e^-32 of its largest value to where it is so again,
    so the cost is the same for every value.
    """
    half, x = df.cast("double") / 2, F.greatest(statistic.cast("double") / 2, F.lit(1e-300))
    place = F.log(x) - F.log(half)

    def above(y: Column) -> Column:
        return F.log1p(REACH / y + F.sqrt(2 * REACH / y))

    def integral(low: Column, high: Column) -> Column:
        return (high - low) / 2 * F.aggregate(
            _nodes(),
            F.lit(0.0),
            lambda total, node: total + node["w"] * _density(half, low + (high - low) * (node["x"] + 1) / 2),
        )

    left = -(F.sqrt(2 * REACH / half) + REACH / half)
    tail = integral(F.greatest(place, left), F.greatest(place, F.lit(0.0)) + above(F.greatest(half, x)))
    whole = integral(left, above(half))
    return F.when((df < 1) | (statistic <= 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), tail / whole))


def _density(half: Column, v: Column) -> Column:
    return F.exp(half * (v - F.expm1(v)))
