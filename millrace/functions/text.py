"""Splitting text lines into tokens and counting them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import columns_of, name

# Fixed value: what a token has to hold to count.
LETTER = "[a-zA-Z]"


def tokens(
    df: DataFrame,
    column: str = "value",
    keep: Sequence[str] = (),
    pattern: str | None = LETTER,
    into: str = "token",
) -> DataFrame:
    """One row per token of ``column``, split on single blanks, next to the ``keep`` columns.

    Only tokens containing ``pattern`` stay; ``None`` keeps all, empty ones too. No shuffle.
    """
    split = df.select(
        *[name(c) for c in keep], F.explode(F.split(name(column), " ")).alias(into)
    )
    return split if pattern is None else split.filter(name(into).rlike(pattern))


def token_count(df: DataFrame, column: str = "value", pattern: str | None = LETTER) -> DataFrame:
    """One row with ``n``, the number of tokens."""
    return tokens(df, column, pattern=pattern).agg(F.count(F.lit(1)).alias("n"))


def token_frequency(
    df: DataFrame,
    column: str = "value",
    by: str | Sequence[str] = (),
    pattern: str | None = LETTER,
    into: str = "token",
    count: str = "n",
) -> DataFrame:
    """Count ``n`` per token, and per ``by`` column where given.

    Counts are combined in each task before the shuffle, so a frequent token costs one row
    per task. ``into`` and ``count`` name the new columns; they must differ from the ``by`` columns.
    """
    keep = columns_of(by) if by else []
    taken = [c.lower() for c in keep]
    if {into.lower(), count.lower()} & set(taken) or into.lower() == count.lower():
        raise ValueError(f"{into!r} and {count!r} cannot be new columns next to {keep}; name others")
    found = tokens(df, column, keep, pattern, into)
    return found.groupBy(*[name(c) for c in [*keep, into]]).agg(F.count(F.lit(1)).alias(count))
