"""Range filter and null profile."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import name


def in_range(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    """Rows with ``low <= column <= high``; NULL is in no range. Reaches the file scan."""
    return df.filter(name(column).between(F.lit(low), F.lit(high)))


def null_counts(df: DataFrame, prefix: str = "null_cnt_") -> DataFrame:
    """One row with the number of NULLs of every column, from a single scan.

    Each task sends one row of partial sums. Over zero rows every count is NULL.
    """
    return df.agg(*[F.sum(name(c).isNull().cast("int")).alias(prefix + c) for c in df.columns])
