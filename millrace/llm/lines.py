"""Line dedup: a segment-partition edit join of all lines of a corpus.

Two lines are linked if few edits (of code points) turn one into the other: as many as the shorter one's
length allows, none for very short lines, which would all be near each other. The shorter line is split into
one segment more than the edits; a line within that distance holds one of them unchanged, at a place that
the difference in length bounds. So segments are looked up, by length, among the substrings of the other
lines, and what meets is verified by a banded bit-parallel edit distance.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import chunks, column, free_name
from millrace.llm.components import components
from millrace.workspace import broadcast_if_small, written

# From so many code points of the shorter line on, so many edits link two lines. Shorter lines must be equal.
Ladder = tuple[tuple[int, int], ...]
LADDER: Ladder = ((13, 1), (24, 2))
# Keys of lines that a task looks through together before it hands them on, and lines that it remembers so as
# not to take them twice; more are forgotten, which costs time only.
KEYS_AT_ONCE, REMEMBERED = 1 << 20, 1 << 20
# Lines under one key, indexed and probing, that meet in one group; more are split over a grid of groups.
TILE = 512


def edits(size: int, ladder: Ladder) -> int:
    """Edits that link a line of ``size`` with one that is no shorter."""
    return max((n for least, n in ladder if size >= least), default=0)


def segments(size: int, threshold: int) -> list[tuple[int, int]]:
    """Start and length of each segment of a line; the later ones are longer by one if need be."""
    short, longer = divmod(size, threshold + 1)
    out, at = [], 0
    for number in range(threshold + 1):
        length = short + (number >= threshold + 1 - longer)
        out.append((at, length))
        at += length
    return out


def places(size: int, other: int, number: int, start: int, length: int, threshold: int) -> range:
    """Where in a line of ``size`` a segment of a line of ``other`` may stand, so that the edits before
    and after it both leave room for the threshold."""
    shift, after = size - other, threshold - number
    low = max(0, start - number, start + shift - after)
    high = min(size - length, start + number, start + shift + after)
    return range(low, high + 1)


# A piece of a line that is a key: from where to where, the number of the segment, and the hash's seed.
Piece = tuple[int, int, int, int]


@lru_cache(maxsize=4096)
def pieces_of(size: int, ladder: Ladder) -> tuple[list[Piece], list[Piece]]:
    """Pieces under which a line of ``size`` is looked up, and under which it looks for others. The seed has
    the length of the line that is looked up and the number of its segment."""
    index, probes = [], []
    for other in range(size - ladder[-1][1], size + 1):
        threshold = edits(other, ladder)
        if size - other > threshold or not threshold:
            continue
        for number, (a, n) in enumerate(segments(other, threshold)):
            seed = other << 8 | number
            probes.extend((at, at + n, number, seed) for at in places(size, other, number, a, n, threshold))
            if other == size:
                index.append((a, a + n, number, seed))
    return index, probes


def keys_of(line: str, ladder: Ladder = LADDER) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Index keys and probe keys of a line, each with its segment's number."""
    from xxhash import xxh64_intdigest

    index, probes = pieces_of(len(line), ladder)
    return (
        [(xxh64_intdigest(line[a:b], seed), number) for a, b, number, seed in index],
        list({(xxh64_intdigest(line[a:b], seed), number) for a, b, number, seed in probes}),
    )


def first_shared(short: str, long: str, threshold: int) -> int:
    """The first segment of ``short`` that stands in ``long`` at a place it may, or -1."""
    size, other = len(long), len(short)
    for number, (a, n) in enumerate(segments(other, threshold)):
        part = short[a : a + n]
        for at in places(size, other, number, a, n, threshold):
            if long.startswith(part, at):
                return number
    return -1


def _shared_front(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def within(a: str, b: str, threshold: int) -> bool:
    """Whether the edit distance is at most ``threshold``."""
    front = _shared_front(a, b)
    a, b = a[front:], b[front:]
    back = _shared_front(a[::-1], b[::-1])
    if back:
        a, b = a[:-back], b[:-back]
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > threshold:
        return False
    if not a or len(b) <= threshold:
        return True
    # The lower edge of the band has to begin inside the matrix.
    return _banded(a, b, threshold) if len(a) > threshold else _table(a, b) <= threshold


def _table(a: str, b: str) -> int:
    """Edit distance by the plain table, for a few code points."""
    last = list(range(len(b) + 1))
    for row, x in enumerate(a, 1):
        new = [row]
        for column_, y in enumerate(b, 1):
            new.append(min(last[column_] + 1, new[-1] + 1, last[column_ - 1] + (x != y)))
        last = new
    return last[-1]


def _banded(a: str, b: str, k: int) -> bool:
    """Bit-parallel columns of the distance matrix, of which only a band around the diagonal is kept.

    Bit r of a word stands for row j - k + r of ``a`` in column j of ``b``. The word moves down by one
    row a column, so its top bit follows the lower edge of the band until that meets the last row.
    """
    rows, width = len(a), 2 * k + 2
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for row, sign in enumerate(a):
        where[sign] = where.get(sign, 0) | 1 << (row + k + 1)
    # Column 0: each row is one more than the one above, for rows 0 to k.
    up, down = (full << (width - k - 1)) & full, 0
    top, score = 1 << (width - 1), k
    for j, sign in enumerate(b):
        match = (where.get(sign, 0) >> j) & full
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right_up = (down | ~(diagonal | up)) & full
        right_down = diagonal & up
        if j < rows - k:
            score += not diagonal & top
        else:
            bit = top >> (j - (rows - k) + 1)
            score += bool(right_up & bit) - bool(right_down & bit)
        if score > k + max(0, len(b) - j - 1) + k:
            return False
        moved = diagonal >> 1
        up = (right_down | ~(moved | right_up)) & full
        down = moved & right_up
    return score <= k


def _documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """``k`` and ``u``, which tell documents apart and order them, and ``t``; null keys come first."""
    own = column(key).cast("bigint")
    return df.select(
        F.coalesce(own, F.lit(-(1 << 63))).alias("k"),
        F.xxhash64(F.coalesce(column(text), F.lit("")), own.isNull()).alias("u"),
        F.coalesce(column(text), F.lit("")).alias("t"),
    )


def _marks(line: Column) -> tuple[Column, Column]:
    """Two hashes by which equal lines are known."""
    return F.xxhash64(line), F.xxhash64(F.lit(1), line)


# What a key row says of its line: it is looked up under the key and looks there, it only looks, or it is known to
# have met another line.
INDEX, PROBE, MET = range(3)


def _key_rows(docs: DataFrame, ladder: Ladder) -> DataFrame:
    """Keys of all lines long enough to be joined: ``key``, ``h`` and ``kind``; a line mostly once a task."""

    def run(batches):
        from xxhash import xxh64_intdigest

        seen: set[int] = set()
        keys: list[int] = []
        marks: list[int] = []
        kinds: list[int] = []
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                for text in texts:
                    for line in text.split("\n"):
                        if len(line) < ladder[0][0]:
                            continue
                        mark = xxh64_intdigest(line, 42)
                        if mark in seen:
                            continue
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(mark)
                        index, probes = pieces_of(len(line), ladder)
                        # A line looks under its own index keys too; it needs no second row there.
                        own = [xxh64_intdigest(line[a:b], seed) for a, b, _, seed in index]
                        keys += own
                        keys += {xxh64_intdigest(line[a:b], seed) for a, b, _, seed in probes}.difference(own)
                        kinds += [INDEX] * len(own)
                        kinds += [PROBE] * (len(keys) - len(kinds))
                        marks += [mark] * (len(keys) - len(marks))
                        if len(keys) > KEYS_AT_ONCE:
                            yield thinned(keys, marks, kinds)
                            keys, marks, kinds = [], [], []
        if keys:
            yield thinned(keys, marks, kinds)

    return docs.select("t").mapInArrow(run, "key bigint, h bigint, kind tinyint")


def thinned(keys: list[int], marks: list[int], kinds: list[int]) -> pa.RecordBatch:
    """Key rows with two of each key under which lines have met already; these lines follow as MET, spread.

    One of the two is looked up, the other is another line, so whatever comes under the key elsewhere still
    meets one of them. So a frequent key costs a task few rows."""
    key, h = (np.array(c, np.uint64).view(np.int64) for c in (keys, marks))
    kind = np.array(kinds, np.int8)
    order = np.lexsort((kind, key))
    key, h, kind = key[order], h[order], kind[order]
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(begins, len(key)))
    # The first row of a key is looked up if any is.
    other = np.repeat(h[begins], sizes) != h
    differs = np.add.reduceat(other, begins) > 0
    met = differs & (kind[begins] == INDEX)
    keep = np.repeat(~met, sizes)
    keep[begins] = True
    place = np.where(other, np.arange(len(key)), len(key))
    second = np.minimum.reduceat(place, begins)[met]
    keep[second] = True
    known = np.unique(h[np.repeat(met, sizes)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([key[keep], known])),
            pa.array(np.concatenate([h[keep], known])),
            pa.array(np.concatenate([kind[keep], np.full(len(known), MET, np.int8)])),
        ],
        ["key", "h", "kind"],
    )


def lines_that_meet(batches):
    """Of key rows in the order of key and kind, ``h`` of the lines under a key that is looked up and has
    another line. Of a key that goes on in the next batch only two marks are remembered."""
    last = None  # key, whether it is looked up, least and largest mark
    for batch in batches:
        key, h, kind = (c.to_numpy() for c in batch.columns)
        out = [h[kind == MET]]
        key, h, kind = (c[kind != MET] for c in (key, h, kind))
        if len(key):
            begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            found = kind[begins] == INDEX
            low, high = np.minimum.reduceat(h, begins), np.maximum.reduceat(h, begins)
            if last is not None and last[0] == key[0]:
                found[0] = last[1]
                met_before = last[2] != last[3]
                low[0], high[0] = min(low[0], last[2]), max(high[0], last[3])
                if found[0] and low[0] != high[0] and not met_before:
                    out.append(np.array([last[2]], np.int64))
            met = found & (low != high)
            out.append(h[np.repeat(met, np.diff(np.append(begins, len(key))))])
            last = key[-1], found[-1], low[-1], high[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(out)))], ["h"])


def _candidates(docs: DataFrame, ladder: Ladder) -> DataFrame:
    """``h`` of the lines that share a key with another line; nothing is paired yet."""
    rows = _key_rows(docs, ladder).repartition("key").sortWithinPartitions("key", "kind")
    return written(rows.mapInArrow(lines_that_meet, "h bigint").distinct(), "line-candidates")


def _links(active: DataFrame, ladder: Ladder, tile: int) -> DataFrame:
    """Of each line with a link, a few times: ``h``, ``g``, ``first``, ``links`` (how many other lines),
    ``least``, the first occurrence of any of them, and ``root``, that of a line it is linked to through any
    number of links. Links to the root connect all that is linked. ``active`` has h, g, line and first (a
    struct of k, u, p)."""
    fields = ["h", "g", "line", "k", "u", "p"]
    plain = active.select("h", "g", "line", "first.k", "first.u", "first.p")

    def spread(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for low in range(0, len(rows), 500):
                part = rows[low : low + 500]
                number, keys, segment, probe = [], [], [], []
                for n, row in enumerate(part):
                    for role, found in enumerate(keys_of(row["line"], ladder)):
                        number.extend([n] * len(found))
                        keys.extend([key for key, _ in found])
                        segment.extend([s for _, s in found])
                        probe.extend([bool(role)] * len(found))
                own = batch.slice(low, len(part)).take(pa.array(number, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.uint64()).view(pa.int64()),
                        pa.array(segment, pa.int32()),
                        pa.array(probe, pa.bool_()),
                        *own.columns,
                    ],
                    ["key", "segment", "probe", *fields],
                )

    schema = "key bigint, segment int, probe boolean, h bigint, g bigint, line string, k bigint, u bigint, p int"
    rows = written(plain.mapInArrow(spread, schema), "line-segments")
    sizes = rows.groupBy("key").agg(
        F.count(F.when(~F.col("probe"), 1)).alias("indexed"), F.count(F.when(F.col("probe"), 1)).alias("probes")
    )
    shared = written(sizes.where("indexed > 0 AND probes > 0 AND indexed + probes > 2"), "line-shared")
    # A frequent key is a grid of cells: each part of its indexed lines meets each part of its probes.
    down, across = (F.ceil(F.col(c) / tile).cast("int") for c in ("indexed", "probes"))
    mark = F.xxhash64("h", "g")
    row = F.pmod(mark, down).cast("int") * across
    place = F.pmod(mark, across).cast("int")
    met = rows.join(broadcast_if_small(shared), "key").select(
        "key",
        F.explode(
            F.when(F.col("probe"), F.transform(F.sequence(F.lit(0), down - 1), lambda k: k * across + place)).otherwise(
                F.transform(F.sequence(F.lit(0), across - 1), lambda k: row + k)
            )
        ).alias("part"),
        "segment",
        "probe",
        *fields,
    )

    def verify(batches):
        group, index, found, root = None, [], {}, {}
        for batch in batches:
            for row in batch.to_pylist():
                here = row["key"], row["part"], row["segment"]
                if here != group:
                    if found:
                        yield _found(found, root)
                    group, index, found, root = here, [], {}, {}
                mine = (row["h"], row["g"]), row["line"], (row["k"], row["u"], row["p"])
                if not row["probe"]:
                    index.append(mine)
                    continue
                for other in index:
                    # Lines of one length probe each other, so one of the two ways is enough.
                    if other[0] == mine[0] or (len(other[1]) == len(mine[1]) and other[0] > mine[0]):
                        continue
                    threshold = edits(len(other[1]), ladder)
                    if not 0 <= len(mine[1]) - len(other[1]) <= threshold:
                        continue  # only the key's hash is the same
                    # A pair that meets under several segments is dealt with under the first.
                    if first_shared(other[1], mine[1], threshold) != row["segment"]:
                        continue
                    if within(other[1], mine[1], threshold):
                        for one, two in ((mine, other), (other, mine)):
                            _, count, least = found.get(one[0], (None, 0, two[2]))
                            found[one[0]] = one[2], count + 1, min(least, two[2])
                        a, b = _root(root, mine[2]), _root(root, other[2])
                        root[max(a, b)] = min(a, b)
            if len(found) > 100_000:
                yield _found(found, root)
                found, root = {}, {}
        if found:
            yield _found(found, root)

    links = (
        met.repartition("key", "part")
        .sortWithinPartitions("key", "part", "segment", "probe")
        .mapInArrow(verify, "h bigint, g bigint, links bigint, " + ", ".join(f"{c}{n} {t}" for c, n, t in _PLACES))
    )
    places_ = [
        F.struct(*[F.col(c + n).alias(n) for c, n, _ in _PLACES if c == own]).alias(name)
        for own, name in (("f", "first"), ("l", "least"), ("r", "root"))
    ]
    return links.select("h", "g", "links", *places_)


# Three occurrences, each as document and line number.
_PLACES = [(c, n, t) for c in "flr" for n, t in (("k", "bigint"), ("u", "bigint"), ("p", "int"))]


def _root(root: dict, line: tuple) -> tuple:
    """The smallest line known to be linked to ``line``; the way there is halved."""
    while (above := root.setdefault(line, line)) != line:
        root[line] = root[above]
        line = root[line]
    return line


def _found(found: dict, root: dict) -> pa.RecordBatch:
    rows = ((*line, count, *own, *least, *_root(root, own)) for line, (own, count, least) in found.items())
    kinds = [pa.int64()] * 3 + [pa.int64(), pa.int64(), pa.int32()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
        ["h", "g", "links", *(c + n for c, n, _ in _PLACES)],
    )


def line_classes(docs: DataFrame, ladder: Ladder, tile: int = TILE) -> DataFrame:
    """Every occurrence of a line that is not blank: document ``k`` and ``u``, line number ``p``, whether
    it is ``kept``, its ``links`` to different lines, and ``source``, the document (k and u) of the earliest
    line of its class, which is kept. A class holds all lines that links connect."""
    line = F.col("line")
    exploded = docs.select("k", "u", F.posexplode(F.split("t", "\n", -1)).alias("p", "line"))
    marks = _marks(line)
    full = exploded.where(F.trim(line) != "").select(
        "k", "u", "p", marks[0].alias("h"), marks[1].alias("g"), F.char_length(line).alias("size"), "line"
    )
    occurrences = written(full.drop("line", "size"), "lines")
    firsts = written(occurrences.groupBy("h", "g").agg(F.min(F.struct("k", "u", "p")).alias("first")), "lines-first")
    candidates = broadcast_if_small(_candidates(docs, ladder))
    texts = (
        full.where(F.col("size") >= ladder[0][0])
        .join(candidates, "h", "left_semi")
        .groupBy("h", "g")
        .agg(F.min("line").alias("line"))
    )
    active = written(texts.join(firsts, ["h", "g"]), "lines-active")
    links = written(_links(active, ladder, tile), "lines-linked")
    reached = components(links.select(F.col("first").alias("a"), F.col("root").alias("b")))
    linked = (
        links.groupBy("h", "g", "first")
        .agg(F.sum("links").alias("links"), F.min("least").alias("least"))
        .join(reached.withColumnRenamed("node", "first"), "first")
        .drop("first")
    )
    classes = written(firsts.join(linked, ["h", "g"], "left"), "lines-classes")
    own = F.struct("k", "u", "p")
    source = F.coalesce("component", "first")
    return occurrences.join(classes, ["h", "g"]).select(
        "k",
        "u",
        "p",
        ((own == F.col("first")) & (F.col("least").isNull() | (F.col("first") < F.col("least")))).alias("kept"),
        F.coalesce("links", F.lit(0)).alias("links"),
        F.struct(source["k"].alias("k"), source["u"].alias("u")).alias("source"),
    )


def dedup_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ladder: Ladder = LADDER,
    report: str = "line_report",
    with_class: bool = True,
) -> DataFrame:
    """``df`` with ``text`` rid of repeated lines, and a struct ``report`` on what went.

    Lines are what line feeds separate. The first occurrence of a line, by key and line number, stays
    unless a line linked to it occurs earlier; all other occurrences go. Blank lines always stay. ``ladder``
    says from which length of the shorter line on how many edits link two lines, in ascending order; lines
    below its first step are only compared for equality. The report has
    ``n_lines`` (not blank), ``n_removed``, ``n_links`` (of its lines to different lines, all told),
    ``class_id`` (unless it is not wanted: the smallest key of all documents that equal or linked lines
    connect, through any number of documents) and ``sources`` (the keys of the earliest lines, which
    are kept, of the removed lines' classes, ascending). A class of lines is what links connect, so a line
    may be further than that from the earliest of its class.

    Null texts stay null and have no lines. Rows with a null key come first and are null in class_id and
    sources. Rows that repeat both key and text are one document and stay as often as they occur; rows
    that only repeat the key are ordered by a hash of the text. Other columns are kept; one named like
    the report is replaced. An empty table gives an empty table.
    """
    if not ladder or any(least <= n for least, n in ladder) or list(ladder) != sorted(set(ladder)):
        raise ValueError(f"{ladder} is no ascending list of lengths with fewer edits each")
    docs = _documents(df, key, text)
    entry = F.struct("p", "kept", "links", F.col("source.k").alias("source"))
    occurrences = line_classes(docs, ladder)
    if with_class:
        occurrences = written(occurrences, "lines-found")
    found = occurrences.groupBy("k", "u").agg(F.collect_set(entry).alias("lines"))
    if with_class:
        reached = components(occurrences.select(F.struct("k", "u").alias("a"), F.col("source").alias("b")))
        reached = reached.select("node.k", "node.u", F.col("component.k").alias("class"))
        found = found.join(reached, ["k", "u"], "left")
    else:
        found = found.withColumn("class", F.lit(None).cast("bigint"))
    kept = df.drop(report)
    k, u, lines, least = (free_name(kept, name) for name in ("_k", "_u", "_lines", "_class"))
    own = column(key).cast("bigint")
    keyed = kept.withColumns(
        {
            k: F.coalesce(own, F.lit(-(1 << 63))),
            u: F.xxhash64(F.coalesce(column(text), F.lit("")), own.isNull()),
        }
    )
    named = found.select(
        F.col("k").alias(k), F.col("u").alias(u), F.col("lines").alias(lines), F.col("class").alias(least)
    )
    joined = keyed.join(named, [k, u], "left")
    entries = F.coalesce(F.col(lines), F.array().cast("array<struct<p:int,kept:boolean,links:bigint,source:bigint>>"))
    gone = F.filter(entries, lambda e: ~e["kept"])
    numbers = F.transform(gone, lambda e: e["p"])
    rest = F.filter(F.split(column(text), "\n", -1), lambda _, at: ~F.array_contains(numbers, at))
    zero = F.lit(0).cast("bigint")

    def known(value: Column) -> Column:
        return F.when(value != F.lit(-(1 << 63)), value)

    summary = F.struct(
        F.size(entries).cast("bigint").alias("n_lines"),
        F.size(gone).cast("bigint").alias("n_removed"),
        F.aggregate(entries, zero, lambda a, e: a + e["links"]).alias("n_links"),
        *([known(F.coalesce(least, k)).alias("class_id")] if with_class else []),
        F.filter(
            F.array_sort(F.array_distinct(F.transform(gone, lambda e: known(e["source"])))), lambda x: x.isNotNull()
        ).alias("sources"),
    )
    out = joined.withColumn(report, summary).withColumn(
        text, F.when(F.size(gone) > 0, F.array_join(rest, "\n")).otherwise(column(text))
    )
    return out.select(*[column(name) for name in [*kept.columns, report]])
