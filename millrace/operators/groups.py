"""Queries that set a row against its group.

A window over a group puts the whole group into one task, which suits groups of moderate size. A
larger group is reduced to one small row instead, with partial aggregation in every task, and that
row is joined back.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import columns_of, free, matches, name
from millrace.workspace import BROADCAST_ROWS, broadcast_if_small, fits_broadcast, written

# A group with more rows is never gathered in one task.
HOT_ROWS = 2_000_000
# Bounds the sizes that are broadcast, one number per bucket.
SIZE_BUCKETS = 65_536
MOST_BUCKETS = 1 << 25


def compare_to_group_avg(
    df: DataFrame,
    group: str | Sequence[str],
    value: str,
    avg_column: str | None = None,
    label_column: str = "comparision",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the average of ``value`` in the row's group and how the row compares with it.

    The label is ``Higher``, ``equal`` (null-safe, so NULL equals the NULL average of an all-NULL
    group) or ``lower`` (also a NULL value in a group that has an average). NULL groups are one
    group.

    Few groups: their averages are measured and broadcast, and the rows are not shuffled. Many
    groups: a window does those of at most ``hot_rows`` rows, and only the averages of larger
    ones are joined to the rows. Groups are counted and averaged when this is called.
    """
    keys = columns_of(group)
    average = avg_column or f"avg_{value}"
    # The columns to be replaced go first, so that every way gives the same result.
    if {average, label_column} & {*keys, value}:
        raise ValueError("the average and the label need names of their own")
    df = df.drop(average, label_column)
    pairs = [(k, free(df, f"_group_{i}")) for i, k in enumerate(keys)]

    def averages(rows: DataFrame) -> DataFrame:
        groups = rows.groupBy(*[name(k).alias(r) for k, r in pairs])
        return written(groups.agg(F.avg(name(value)).alias(average)), "averages")

    def windowed(rows: DataFrame) -> DataFrame:
        whole_group = Window.partitionBy(*[name(k) for k in keys])
        return rows.withColumn(average, F.avg(name(value)).over(whole_group))

    def with_averages(rows: DataFrame, side: DataFrame) -> DataFrame:
        joined = rows.join(side, matches(rows, side, pairs), "left")
        return joined.drop(*[r for _, r in pairs])

    def with_own_averages(rows: DataFrame) -> DataFrame:
        return with_averages(rows, broadcast_if_small(averages(rows), broadcast_rows))

    sizes = _bucket_sizes(df, keys, hot_rows)
    few = averages(df) if sizes.groups <= broadcast_rows else None
    if few is not None and fits_broadcast(few, broadcast_rows):
        compared = with_averages(df, F.broadcast(few))
    else:
        compared = _hot_apart(df, pairs, sizes, hot_rows, windowed, with_own_averages)
    own, mean = name(value), name(average)
    label = F.when(own > mean, "Higher").when(own.eqNullSafe(mean), "equal").otherwise("lower")
    return compared.withColumn(label_column, label)


def nth_highest(
    df: DataFrame,
    group: str | Sequence[str],
    value: str,
    n: int,
    columns: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows holding the ``n``-th highest distinct ``value`` of their group, ties included.

    NULL ranks last, as one value. Groups of at most ``hot_rows`` rows are ranked by a window,
    for which every task keeps only its own ``n`` highest values per group before the shuffle.
    That does not thin out ties, so larger groups are not sent to one task at all: their
    ``n``-th value is found by aggregation and joined back. Group sizes are counted when this is
    called.
    """
    if n < 1:
        raise ValueError("n counts from 1")
    keys = columns_of(group)
    pairs = [(k, free(df, f"_group_{i}")) for i, k in enumerate(keys)]
    output = [name(c) for c in (columns or df.columns)]

    def ranked(rows: DataFrame) -> DataFrame:
        return _ranked(rows, keys, value, n, free(rows, "_rank")).select(*output)

    def joined(rows: DataFrame) -> DataFrame:
        own_value = free(rows, "_value")
        nth = _nth_values(rows, pairs, value, n).withColumnRenamed("_value", own_value)
        wanted = broadcast_if_small(nth)
        same_value = matches(rows, wanted, [*pairs, (value, own_value)])
        return rows.join(wanted, same_value, "left_semi").select(*output)

    return _hot_apart(df, pairs, _bucket_sizes(df, keys, hot_rows), hot_rows, ranked, joined)


@dataclass(frozen=True)
class _BucketSizes:
    """Hash buckets of group keys, each with at least the rows of any group in it."""

    buckets: int
    per_bucket: DataFrame
    total: int
    largest: int
    groups: float


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[name(k) for k in keys]), F.lit(buckets)).alias("_bucket")


def _bucket_sizes(
    df: DataFrame, keys: Sequence[str], hot_rows: int, buckets: int = SIZE_BUCKETS
) -> _BucketSizes:
    """One pass over the keys, which shuffles no more than the sizes of the buckets.

    The number of groups is estimated from the buckets in use (linear counting). If the average
    bucket comes near ``hot_rows``, a second pass takes as many buckets as the rows call for.
    """
    per_bucket = df.groupBy(_bucket(keys, buckets)).agg(F.count(F.lit(1)).alias("_rows"))
    used, total, largest = per_bucket.agg(
        F.count(F.lit(1)), F.sum("_rows"), F.max("_rows")
    ).first()
    wanted = min(MOST_BUCKETS, 8 * (total or 0) // max(1, hot_rows))
    if buckets == SIZE_BUCKETS and wanted > buckets and hot_rows >= SIZE_BUCKETS:
        return _bucket_sizes(df, keys, hot_rows, wanted)
    free_buckets = buckets - used
    groups = buckets * math.log(buckets / free_buckets) if free_buckets else math.inf
    return _BucketSizes(buckets, per_bucket, total or 0, largest or 0, groups)


def _hot_apart(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    sizes: _BucketSizes,
    hot_rows: int,
    moderate: Callable[[DataFrame], DataFrame],
    hot: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``moderate`` of the rows in groups up to ``hot_rows``, and ``hot`` of the other rows.

    Mostly the sizes of the buckets prove that no group is hot. Only groups in larger buckets
    are counted one by one.
    """
    if sizes.largest <= hot_rows:
        return moderate(df)
    crowded = sizes.per_bucket.filter(F.col("_rows") > hot_rows).select("_bucket")
    found = written(
        df.select(*[name(k).alias(r) for k, r in pairs], _bucket([k for k, _ in pairs], sizes.buckets))
        .join(F.broadcast(crowded), "_bucket", "left_semi")
        .groupBy(*[r for _, r in pairs])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows),
        "hot-groups",
    )
    covered = found.agg(F.sum("_rows")).first()[0]
    if covered is None:
        return moderate(df)
    if covered == sizes.total:
        return hot(df)
    found = broadcast_if_small(found.drop("_rows"))
    in_hot = matches(df, found, pairs)
    return moderate(df.join(found, in_hot, "left_anti")).unionByName(
        hot(df.join(found, in_hot, "left_semi"))
    )


def _ranked(
    df: DataFrame, keys: Sequence[str], value: str, n: int, rank: str = "_rank"
) -> DataFrame:
    highest_first = Window.partitionBy(*[name(k) for k in keys]).orderBy(name(value).desc())
    return df.withColumn(rank, F.dense_rank().over(highest_first)).filter(F.col(rank) == n)


def _nth_values(
    df: DataFrame, pairs: Sequence[tuple[str, str]], value: str, n: int
) -> DataFrame:
    """The ``n``-th highest value of each group, by aggregation only.

    Values are dealt into hash buckets. The ``n``-th highest of the buckets' maxima is a value of
    the group, so the ``n``-th highest of the group is no lower. Few distinct values pass this
    floor, and those are ranked. A group with fewer maxima has no floor.
    """
    values = df.select(*[name(k).alias(r) for k, r in pairs], name(value).alias("_value"))
    group = [r for _, r in pairs]
    bucket = F.pmod(F.xxhash64("_value"), F.lit(max(64, 8 * n))).alias("_bucket")
    maxima = values.groupBy(*group, bucket).agg(F.max("_value").alias("_top"))
    # A value is in one bucket only, so the maxima are distinct; a task keeps the highest n of a group.
    highest_first = Window.partitionBy(*group).orderBy(F.col("_top").desc_nulls_last())
    top = maxima.withColumn("_at", F.row_number().over(highest_first)).filter(F.col("_at") <= n)
    floors = written(
        top.groupBy(*group).agg(F.max(F.when(F.col("_at") == n, F.col("_top"))).alias("_floor")),
        "floors",
    ).withColumnsRenamed({r: f"{r}_of_floor" for r in group})
    floors = broadcast_if_small(floors)
    candidates = (
        values.join(floors, matches(values, floors, [(r, f"{r}_of_floor") for r in group]))
        .filter(F.col("_floor").isNull() | (F.col("_value") >= F.col("_floor")))
        .select(*group, "_value")
        .distinct()
    )
    return written(_ranked(candidates, group, "_value", n).drop("_rank"), "nth-highest")
