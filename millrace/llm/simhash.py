"""Near-duplicates by SimHash: exact comparison of all fingerprints, tile by tile."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import chunks, column, free_name
from millrace.llm.components import components
from millrace.workspace import written

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
# Fingerprints in a tile and in a block, the part of a tile that is compared in one step.
TILE = 32_768
BLOCK = 512
# Tiles in order are dealt to at most so many bands; a task compares the tiles of one band with those of another.
SIDE = 256

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_BITS = np.arange(63, -1, -1, dtype=np.uint64)


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a whole text: a bit is 1 if it is set in over half of the shingles' XXH64."""
    from xxhash import xxh64_intdigest

    found = _WORD.findall(text.encode().translate(_LOWER))
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    count = max(1, len(found) - words + 1)
    last = words - 1 if len(found) >= words else len(found) - 1
    total = np.zeros(64, np.int64)
    for low in range(0, count, 1 << 16):
        high = min(count, low + (1 << 16))
        hashes = [xxh64_intdigest(line[starts[i] : stops[i + last]], seed) for i in range(low, high)]
        raw = np.asarray(hashes, ">u8").view(np.uint8)
        total += np.unpackbits(raw.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > count).view(">u8")[0])


def fingerprints(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """``key``, ``fp`` (long, the 64 bits as a signed number) and ``h``, a hash of the text, of every row;
    null text is empty."""
    picked = df.select(column(key).cast("bigint").alias("key"), column(text).alias("text"), _mark(text).alias("h"))

    def run(batches):
        for batch in batches:
            for start, texts in chunks(batch.column(1)):
                found = np.asarray([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
                own = [batch.column(n).slice(start, len(texts)) for n in (0, 2)]
                yield pa.RecordBatch.from_arrays([own[0], pa.array(found), own[1]], ["key", "fp", "h"])

    return picked.mapInArrow(run, "key bigint, fp bigint, h bigint")


def _mark(text: str) -> Column:
    """A hash by which equal texts are known; null is the empty text."""
    return F.xxhash64(F.coalesce(column(text), F.lit("")))


def _population(values: np.ndarray) -> np.ndarray:
    """Set bits of each of the four 16-bit words, one row per fingerprint."""
    return np.bitwise_count(values.view("<u2").reshape(-1, 4)).astype(np.int16)


def _boxes(values: np.ndarray) -> np.ndarray:
    """Smallest and largest population counts (total and by word) of each block."""
    counts = _population(values)
    counts = np.column_stack([counts.sum(axis=1), counts])
    at = np.arange(0, len(values), BLOCK)
    return np.stack([np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)])


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """A lower bound of the bit distance between any two members, for all pairs of boxes."""
    gap = np.maximum(one[0][:, None] - other[1][None], other[0][None] - one[1][:, None]).clip(0)
    return np.maximum(gap[..., 0], gap[..., 1:].sum(axis=-1))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links that connect the same: each node with the smallest node it reaches."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def compare(one: np.ndarray, other: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints at ``radius`` bits or fewer, thinned to a forest.

    ``one`` against ``other``, or against itself if that is None. Pairs of blocks whose population
    counts differ beyond the radius are skipped, since each differing bit changes them by one.
    """
    same = other is None
    if same:
        other = one
    near = _apart(_boxes(one), _boxes(other)) <= radius
    if same:
        near = np.triu(near)
    left, right, held = [], [], 0
    for i, j in np.argwhere(near).tolist():
        rows, columns = one[i * BLOCK : (i + 1) * BLOCK], other[j * BLOCK : (j + 1) * BLOCK]
        close = np.bitwise_count(rows[:, None] ^ columns[None]) <= radius
        x, y = np.nonzero(np.triu(close, 1) if same and i == j else close)
        if len(x):
            a, b = _forest(rows[x].view(np.int64), columns[y].view(np.int64)) if len(x) > BLOCK else (
                rows[x].view(np.int64),
                columns[y].view(np.int64),
            )
            left.append(a)
            right.append(b)
            held += len(a)
            if held > 1 << 20:
                a, b = _forest(np.concatenate(left), np.concatenate(right))
                left, right, held = [a], [b], len(a)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return _forest(np.concatenate(left), np.concatenate(right))


def _tiles(fps: DataFrame, size: int, side: int) -> DataFrame:
    """Distinct fingerprints in order of their population counts, packed ``size`` or so to a row, and the
    ``band`` of the row, from 0 to ``side`` at most."""
    parts = max(1, -(-fps.count() // size))
    bands = min(side, parts)
    words = [F.bit_count(F.shiftright("fp", 16 * k).bitwiseAND(0xFFFF)) for k in range(4)]
    order = [F.bit_count("fp"), words[0] + words[1], words[0], words[2], F.col("fp")]

    def pack(batches):
        values = [b.column(0).to_numpy() for b in batches]
        values = np.concatenate(values) if values else np.empty(0, np.int64)
        for low in range(0, len(values), size):
            part = np.ascontiguousarray(values[low : low + size]).view(np.uint64)
            counts = _population(part).sum(axis=1)
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    # There may be more partitions than asked for.
                    pa.array([min(bands - 1, number * bands // parts)], pa.int32()),
                    pa.array([(number << 32) + low // size]),
                    pa.array([int(counts.min())], pa.int32()),
                    pa.array([int(counts.max())], pa.int32()),
                    pa.array([part.tobytes()], pa.binary()),
                ],
                ["band", "tile", "low", "high", "fps"],
            )

    dealt = fps.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(dealt.mapInArrow(pack, "band int, tile bigint, low int, high int, fps binary"), "simhash-tiles")


def near_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE, side: int = SIDE) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` that connect all within ``radius`` bits.

    Every pair of tiles whose total population counts come within the radius is compared. The tiles form a
    grid of bands by bands: a task has a row's tiles and a column's, so a tile is sent once for each band
    and not for each tile that it meets. Of the links of a pair of tiles a spanning forest is kept. The
    driver gets the counts' range of each band, of which there are at most ``side``.
    """
    spark = fps.sparkSession
    tiles = _tiles(fps, tile, side)
    ranges = sorted(map(tuple, tiles.groupBy("band").agg(F.min("low"), F.max("high")).collect()))
    cells = [
        (row, across)
        for k, (row, low, high) in enumerate(ranges)
        for across, least, most in ranges[k:]
        if least - radius <= high and low <= most + radius
    ]
    # At most side * (side + 1) / 2 rows of two numbers.
    grid = F.broadcast(spark.createDataFrame(cells, "row int, across int"))
    sent = [
        tiles.join(grid, tiles.band == grid[by]).select("row", "across", F.lit(column_).alias("column"), "tile", "low", "high", "fps")
        for by, column_ in (("row", False), ("across", True))
    ]
    dealt = (
        sent[0]
        .union(sent[1])
        .repartition(max(1, len(cells)), "row", "across")
        .sortWithinPartitions("row", "across", "column", "tile")
    )

    def run(batches):
        cell, held = None, []
        for batch in batches:
            row, across, is_column, number, low, high = (batch.column(k).to_pylist() for k in range(6))
            for at in range(batch.num_rows):
                if (row[at], across[at]) != cell:
                    cell, held = (row[at], across[at]), []
                if not is_column[at]:
                    # A batch's memory goes when the next one comes.
                    own = np.frombuffer(batch.column(6)[at].as_py(), np.uint64)
                    held.append((number[at], low[at], high[at], own))
                    continue
                two = np.frombuffer(batch.column(6)[at].as_buffer(), np.uint64)
                for other, least, most, one in held:
                    if other > number[at] or least - radius > high[at] or low[at] > most + radius:
                        continue
                    a, b = compare(one, None if other == number[at] else two, radius)
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _groups(found: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """Per distinct ``fp`` its ``first`` key and its ``component``; per component its ``least`` key."""
    distinct = written(found.groupBy("fp").agg(F.min("key").alias("first")), "simhash-distinct")
    links = near_links(distinct.select("fp"), radius)
    reached = components(links)
    groups = (
        distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first", F.coalesce("component", "fp").alias("component"))
    )
    groups = written(groups, "simhash-groups")
    return groups, groups.groupBy("component").agg(F.min("first").alias("least"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """Per row ``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key reachable.

    Rows whose fingerprints differ in ``radius`` bits or fewer are linked; components follow links
    through any number of rows. Null and wordless texts have the fingerprint zero and are linked like
    any other. Repeated rows each give a row. A row with a null key keeps a null key, connects what it
    is near to, and gets the smallest key that is not null (null if its component has none). Columns
    other than key and text are ignored; an empty table gives an empty table.
    """
    found = written(fingerprints(df, key, text, words).select("key", "fp"), "simhash")
    groups, least = _groups(found, radius)
    named = groups.join(least, "component").select("fp", F.col("least").alias("component_id"))
    return found.join(named, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row with the smallest key.

    If several rows of a component have that key, the one with the smallest text stays, null first. Rows
    of other components under the same key are judged by themselves. Rows without a key cannot be
    named by a component, so they all stay. Every column is kept as it is.
    """
    found = written(fingerprints(df, key, text), "simhash")
    groups, least = _groups(found, RADIUS)
    own, mark, group, rank = (free_name(df, name) for name in ("_key", "_mark", "_group", "_rank"))
    elected = groups.join(least, "component").select("fp", "component", F.col("least").alias("key"))
    first = (
        found.join(elected, ["fp", "key"])
        .select(F.col("key").alias(own), F.col("h").alias(mark), F.col("component").alias(group))
        .distinct()
    )
    rows = df.withColumns({own: column(key).cast("bigint"), mark: _mark(text)}).where(F.col(own).isNotNull())
    kept = (
        rows.join(written(first, "simhash-kept"), [own, mark])
        .withColumn(rank, F.row_number().over(Window.partitionBy(own, group).orderBy(column(text))))
        .where(F.col(rank) == 1)
    )
    return kept.select(*[column(c) for c in df.columns]).union(df.where(column(key).isNull()))
