"""Result shapes that compare across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round sums and quotients, whose last bits depend on the order of addition."""
    return df.withColumns({name: F.round(F.col(name).cast("double"), digits) for name in names})


def as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def joined(df: DataFrame, *names: str) -> DataFrame:
    """Lists as one text."""
    return df.withColumns({name: F.array_join(name, " | ") for name in names})
