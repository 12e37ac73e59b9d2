"""Packing by length: optimal buckets from the global histogram, and token-budget batches in them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import chunks, column, free_name, map_batches
from millrace.workspace import written

BUCKETS = 16
# Tokens that a padded batch holds.
BUDGET = 65_536
# Lengths are padded to a multiple of this, which also bounds the histogram.
ROUND_TO = 8
# Documents of a bucket that are numbered in one task; each such group may end in one short batch.
GROUP_ROWS = 8_192


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets that minimise the padding of all documents.

    Dynamic programming over the histogram: the best cost of the first j lengths in k buckets is the
    least, over i, of that of the first i in k - 1 plus padding lengths i to j up to the j-th. Where the
    best i lies only moves up with j, so a row is found by halving.
    """
    order = np.argsort(lengths)
    values, weights = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    n = len(values)
    if n == 0:
        return []
    number = np.concatenate([[0], np.cumsum(weights)]).astype(object if weights.sum() * values[-1] > 1 << 62 else np.int64)
    tokens = np.concatenate([[0], np.cumsum(weights.astype(number.dtype) * values.astype(number.dtype))])

    def pad(i, j):
        """Padding of lengths i to j (exclusive) in one bucket; i may be an array."""
        return (number[j] - number[i]) * int(values[j - 1]) - (tokens[j] - tokens[i])

    buckets = min(buckets, n)
    best = np.array([0] + [pad(0, j) for j in range(1, n + 1)], dtype=number.dtype)
    froms = []
    for k in range(2, buckets + 1):
        new = best.copy()
        where = np.zeros(n + 1, np.int64)
        stack = [(k, n, k - 1, n - 1)]
        while stack:
            low, high, first, last = stack.pop()
            if low > high:
                continue
            middle = (low + high) // 2
            i = np.arange(first, min(last, middle - 1) + 1)
            costs = best[i] + pad(i, middle)
            at = int(np.argmin(costs))
            new[middle], where[middle] = costs[at], i[at]
            stack.append((low, middle - 1, first, int(i[at])))
            stack.append((middle + 1, high, int(i[at]), last))
        froms.append(where)
        best = new
    bounds, j = [], n
    for where in reversed(froms):
        bounds.append(int(values[j - 1]))
        j = int(where[j])
    bounds.append(int(values[j - 1]))
    return sorted(bounds)


@dataclass(frozen=True)
class Plan:
    """Buckets by upper bound, the documents in each, and what they hold in tokens and padding."""

    bounds: tuple[int, ...]
    documents: tuple[int, ...]
    tokens: int
    padding: int


def plan(df: DataFrame, length: str = "n_tokens", buckets: int = BUCKETS, round_to: int = ROUND_TO) -> Plan:
    """Bucket bounds from the histogram of all rows' lengths, rounded up to multiples of ``round_to``.

    The driver gets one row per rounded length: distinct lengths add up to no more than all tokens, so
    there are at most the square root of twice their number. Null lengths count as zero.
    """
    own = F.coalesce(column(length).cast("bigint"), F.lit(0))
    rounded = F.ceil(own / round_to).cast("bigint") * round_to
    found = df.groupBy(rounded.alias("size")).agg(F.count("*").alias("n"), F.sum(own).alias("tokens")).collect()
    sizes = np.asarray([r["size"] for r in found], np.int64)
    counts = np.asarray([r.n for r in found], np.int64)
    bounds = boundaries(sizes, counts, buckets)
    at = np.searchsorted(bounds, sizes) if bounds else np.zeros(0, np.int64)
    documents = [int(counts[at == k].sum()) for k in range(len(bounds))]
    tokens = sum(int(r.tokens) for r in found)
    held = sum(n * b for n, b in zip(documents, bounds, strict=True))
    return Plan(tuple(bounds), tuple(documents), tokens, held - tokens)


def pack(
    df: DataFrame,
    key: str = "doc_id",
    length: str = "n_tokens",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    round_to: int = ROUND_TO,
    mark: str | None = None,
) -> DataFrame:
    """``df`` with a batch for every row: ``bucket`` (from 0 by length), ``padded`` (its upper bound, the
    length all its rows are padded to), ``batch`` (unique over the table) and ``place`` in it (from 0).

    A batch has rows of one bucket whose padded lengths add up to ``budget`` at most; a row longer than
    the budget is a batch by itself. Rows of a bucket are dealt by a hash of a mark that no two rows share to
    groups of about GROUP_ROWS, however alike they are, and a group's last batch may be short. ``mark`` names
    a column of written rows that is such a mark, and is dropped; without it rows are written with one first.
    Null lengths count as zero; rows with no token share a bucket with the shortest. Repeated rows and null
    keys are packed like any other. Columns of those four names are replaced. An empty table gives an empty
    table. Runs jobs when called.
    """
    if mark is None:
        mark = free_name(df, "_mark")
        df = written(df.withColumn(mark, F.monotonically_increasing_id()), "packing-rows")
    made = plan(df, length, buckets, round_to)
    kept = df.drop("bucket", "padded", "batch", "place")
    own = F.coalesce(column(length).cast("bigint"), F.lit(0))
    rounded = F.ceil(own / round_to).cast("bigint") * round_to
    bucket, padded = F.lit(0), F.lit(made.bounds[0] if made.bounds else 0).cast("bigint")
    groups, fits = F.lit(1), F.lit(1)
    for k in range(len(made.bounds) - 1, -1, -1):
        here = rounded <= made.bounds[k]
        share = max(1, -(-made.documents[k] // GROUP_ROWS))
        room = max(1, budget // max(1, made.bounds[k]))
        if k == len(made.bounds) - 1:
            here = F.lit(True)
        bucket = F.when(here, k).otherwise(bucket)
        padded = F.when(here, F.lit(made.bounds[k]).cast("bigint")).otherwise(padded)
        groups = F.when(here, share).otherwise(groups)
        fits = F.when(here, room).otherwise(fits)
    group, fit, row = (free_name(kept, name) for name in ("_group", "_fits", "_row"))
    dealt = kept.withColumns(
        {
            "bucket": bucket.cast("int"),
            "padded": padded,
            group: F.pmod(F.xxhash64(column(mark)), groups).cast("int"),
            fit: fits,
        }
    )
    order = Window.partitionBy("bucket", group).orderBy(column(key), column(length), column(mark))
    numbered = dealt.withColumn(row, F.row_number().over(order) - 1)
    return numbered.withColumns(
        {
            "batch": F.concat_ws("-", "bucket", F.col(group), F.floor(F.col(row) / F.col(fit))),
            "place": (F.col(row) % F.col(fit)).cast("int"),
        }
    ).drop(group, fit, row, mark)


def token_lengths(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` without its texts and with their lengths in tokens of a tokenizers-library vocabulary,
    an end id included; null texts count as empty."""
    from pyspark.sql.types import StructType

    from millrace.llm.token_files import CUT_CHARS, encoder

    kept = df.drop(out)
    at = kept.columns.index(text)
    rest = [f for k, f in enumerate(kept.schema.fields) if k != at]

    def run(batch):
        ids = encoder(path)
        for start, texts in chunks(batch.column(at), CUT_CHARS):
            own = batch.slice(start, len(texts))
            columns = [c for k, c in enumerate(own.columns) if k != at]
            counts = pa.array([count + 1 for count in ids.counts(texts)], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, counts], [*[f.name for f in rest], out])

    return map_batches(kept, run, StructType([*rest, *StructType.fromDDL(f"`{out}` bigint").fields]))


def packed_documents(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Batches for whole documents: ``key``, ``n_tokens``, ``bucket``, ``padded``, ``batch``, ``place``.

    Lengths are written to the shared folder once, as the histogram and the batches both read them.
    """
    lengths = token_lengths(df.select(column(key).alias("key"), column(text).alias("text")), path)
    lengths = written(lengths.withColumn("mark", F.monotonically_increasing_id()), "token-lengths")
    return pack(lengths, "key", mark="mark").withColumnRenamed("key", key)
