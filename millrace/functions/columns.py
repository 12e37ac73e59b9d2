"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(column: str) -> str:
    """The exact name in backticks, for names holding a dot, a blank or a backtick."""
    return "`" + column.replace("`", "``") + "`"


def name(column: str) -> Column:
    """Column by its exact name."""
    return F.col(quoted(column))


def columns_of(columns: str | Iterable[str]) -> list[str]:
    """One name or several, as a non-empty list."""
    names = [columns] if isinstance(columns, str) else list(columns)
    if not names:
        raise ValueError("at least one column is needed")
    return names


def free(df: DataFrame, base: str) -> str:
    """``base``, extended until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def matches(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality on every pair of (left, right) columns: NULL equals NULL."""
    return reduce(and_, [left[quoted(l)].eqNullSafe(right[quoted(r)]) for l, r in pairs])


def equal(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Plain equality on every pair of (left, right) columns: NULL matches nothing."""
    return reduce(and_, [left[quoted(l)] == right[quoted(r)] for l, r in pairs])
