"""Upsert and delete by key, as joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import columns_of, equal, free, matches, name, quoted
from millrace.operators.changes import DELETE

# A source of at most so many keys gets a filter over the target, of at most so many words of 64 bits: a
# mebibit of words is eight megabytes, and eight bits a key let about one target key in twenty pass by chance.
FILTER_KEYS, FILTER_WORDS = 1 << 23, 1 << 20
# Words a key asks for: more than a few bits in one word fill it too fast.
KEY_BITS = 3


def join_by_key(
    target: DataFrame,
    other: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str,
    bucketed: bool = False,
) -> DataFrame:
    """Join on null-safe equality of key ``pairs``; ``how`` keeps no unmatched row of ``other``.

    The null-safe condition hides a bucketing of the target by its keys from Spark. With
    ``bucketed``, complete keys are therefore compared by plain equality, which needs no shuffle
    of the target, and only rows with a NULL in their key are compared apart.
    """
    if not bucketed:
        return target.join(other, matches(target, other, pairs), how)
    nulls = reduce(or_, [name(k).isNull() for k, _ in pairs])
    other_nulls = reduce(or_, [name(k).isNull() for _, k in pairs])
    complete, other_complete = target.filter(~nulls), other.filter(~other_nulls)
    partial, other_partial = target.filter(nulls), other.filter(other_nulls)
    return complete.join(
        other_complete, equal(complete, other_complete, pairs), how
    ).unionByName(partial.join(other_partial, matches(partial, other_partial, pairs), how))


def replace_keys(
    target: DataFrame,
    changed: DataFrame,
    arriving: DataFrame,
    keys: Sequence[str],
    bucketed: bool = False,
) -> DataFrame:
    """``target`` without the keys found in ``changed``, plus the ``arriving`` rows.

    Only key columns of ``changed`` meet the target. They are broadcast by Catalyst where the
    files they come from are small; a target with one row per key has no skew otherwise.
    """
    pairs = [(k, f"_key_{i}") for i, k in enumerate(keys)]
    changed_keys = changed.select(*[name(k).alias(r) for k, r in pairs]).distinct()
    untouched = join_by_key(target, changed_keys, pairs, "left_anti", bucketed)
    return untouched.unionByName(arriving)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> tuple[int, bool]:
    """How many keys ``df`` has, and whether one has several rows; by one job."""
    n = free(df, "_n")
    counts = df.groupBy(*[name(k) for k in keys]).agg(F.count(F.lit(1)).alias(n))
    found = counts.agg(F.count(F.lit(1)).alias("keys"), F.max(n).alias("most")).first()
    return found["keys"], (found["most"] or 0) > 1


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    delete: bool = False,
    unique_target: bool = False,
) -> DataFrame:
    """``target`` after upserting ``source``: matching rows replaced, other source rows added.

    Keys match null-safely. ``source`` holds one row per key (see ``latest_per_key``) and all of
    the target's columns, which are cast to the target's types; its other columns are ignored.
    With ``delete``, source rows whose ``_change_type`` is ``delete`` remove their key and are
    never added. A source that repeats a key is an error, found by counting its keys when this is
    called.

    Target rows sharing a key are each replaced. Where the target is known to have one row per
    key, ``unique_target`` saves the second look at it: the result is then the untouched target
    rows, found by a join that ships only the source's keys, plus the source.

    No full outer join is used, since neither a small source (broadcast by Catalyst from its
    file size) nor a hot target key (split by adaptive execution) could help it. A source too large
    for that, of up to ``FILTER_KEYS`` keys, becomes a Bloom filter first: target rows that it keeps
    out go straight to the result, so only about as many rows as the source has are shuffled.
    """
    key_names = columns_of(keys)
    gone = F.col("_change_type").eqNullSafe(DELETE) if delete else F.lit(False)
    fields = target.schema.fields
    gone_name = free(target, "_gone")
    changes = source.select(
        *[name(f.name).cast(f.dataType).alias(f.name) for f in fields], gone.alias(gone_name)
    )
    n_keys, repeated = repeated_keys(changes, key_names)
    if repeated:
        raise ValueError(f"the source repeats a key {key_names}")
    passes = None if n_keys > FILTER_KEYS or _is_broadcast(changes) else key_filter(changes, key_names, n_keys)
    if passes is None:
        return _merged(target, changes, gone_name, key_names, unique_target)
    met = _merged(target.filter(passes), changes, gone_name, key_names, unique_target)
    return target.filter(~passes).unionByName(met)


def _merged(
    target: DataFrame, changes: DataFrame, gone_name: str, key_names: list[str], unique_target: bool
) -> DataFrame:
    arriving = changes.filter(~F.col(gone_name)).drop(gone_name)
    if unique_target:
        return replace_keys(target, changes, arriving, key_names)

    fields, new_name = target.schema.fields, free(changes, "_new")
    pairs = [(k, f"_key_{i}") for i, k in enumerate(key_names)]
    changed_keys = changes.select(*[name(k).alias(r) for k, r in pairs])

    lookup = changes.select(
        *[name(k).alias(r) for k, r in pairs],
        F.struct(*[name(f.name) for f in fields]).alias(new_name),
        gone_name,
    )
    old = F.struct(*[target[quoted(f.name)] for f in fields])
    kept = (
        target.join(lookup, matches(target, lookup, pairs), "left")
        .filter(~F.coalesce(gone_name, F.lit(False)))
        .select(F.coalesce(new_name, old).alias("_row"))
        .select("_row.*")
    )
    found_keys = (
        target.join(changed_keys, matches(target, changed_keys, pairs), "left_semi")
        .select(*[name(k).alias(r) for k, r in pairs])
        .distinct()
    )
    added = arriving.join(found_keys, matches(arriving, found_keys, pairs), "left_anti")
    return kept.unionByName(added)


def key_filter(changes: DataFrame, keys: Sequence[str], n_keys: int) -> Column | None:
    """A condition that every row with a key of ``changes`` fulfils, and few other rows do.

    A Bloom filter as an array of words, found by a subquery when the condition is evaluated: a key's hash
    chooses a word, and another one a few bits in it. None for keys whose equality is not that of bytes.
    """
    kinds = {f.name: f.dataType.simpleString() for f in changes.schema.fields}
    if any("collate" in kinds[k] for k in keys):
        return None
    words = 1 << max(4, min(FILTER_WORDS, n_keys // 4 + 1) - 1).bit_length()
    # Zero has two signs, which are equal.
    parts = [name(k) + 0 if kinds[k] in ("float", "double") else name(k) for k in keys]
    place = F.pmod(F.xxhash64(*parts), F.lit(words))
    bits = F.xxhash64(F.lit(1), *parts)
    one = F.lit(1).cast("bigint")
    mask = reduce(
        Column.bitwiseOR,
        [F.call_function("shiftleft", one, F.shiftright(bits, 6 * k).bitwiseAND(63).cast("int")) for k in range(KEY_BITS)],
    )
    filled = changes.select(place.alias("place"), mask.alias("mask")).groupBy("place").agg(F.bit_or("mask").alias("word"))
    spark = changes.sparkSession
    array = (
        spark.range(words)
        .join(filled, F.col("id") == F.col("place"), "left")
        .agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("bigint")).alias("word")))).alias("all"))
        .select(F.col("all.word"))
    )
    return F.get(array.scalar(), place.cast("int")).bitwiseAND(mask) == mask


def _is_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst takes ``df`` for small enough to send it to every task."""
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size <= most
