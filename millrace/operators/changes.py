"""Reducing change records to the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import columns_of, name

# The columns and row kinds of a change feed.
CHANGE_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")
INSERT = "insert"
UPDATE_BEFORE = "update_preimage"
UPDATE_AFTER = "update_postimage"
DELETE = "delete"


def change_rows(df: DataFrame) -> DataFrame:
    """Rows of a change feed that state a key's new content: all but the old images."""
    return df.filter(F.col("_change_type").isin(INSERT, UPDATE_AFTER, DELETE))


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    change_feed: bool = False,
) -> DataFrame:
    """The row of each key with the greatest ``order_by`` columns, compared in listed order.

    NULL keys are one key; a NULL order value is the smallest. Between full ties any row may
    win, so give an order that ends in a unique column. With ``change_feed`` old images are
    ignored and the commit version and time come first in the order.

    Every task reduces its rows to one per key before the shuffle, which bounds a hot key.
    """
    order = columns_of(order_by)
    rows = df
    if change_feed:
        rows = change_rows(df)
        order = ["_commit_version", "_commit_timestamp", *order]
    picked = F.max_by(
        F.struct(*[name(c) for c in df.columns]), F.struct(*[name(c) for c in order])
    )
    return (
        rows.groupBy(*[name(k).alias(f"_key_{i}") for i, k in enumerate(columns_of(keys))])
        .agg(picked.alias("_latest"))
        .select("_latest.*")
    )
