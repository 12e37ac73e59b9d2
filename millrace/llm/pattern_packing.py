"""Best-fit packing into sequences of a fixed size, by patterns of lengths.

All that packing needs to know of a table is its histogram of lengths. Lengths are first rounded up to a
coarse grid; every set of a few grid lengths that fills a sequence is a pattern, and non-negative least
squares find how often to use each so that together they come nearest to the histogram. The repeats are
rounded and carried out with exact lengths, what room that leaves is filled with the longest of the other
pieces that fit, and what is left is packed in the same way into sequences of its own. The result is a
list of runs of equal sequences; a piece finds its place by its length and its number among the pieces of
that length.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_right, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import (
    ASCII_LETTERS,
    ASCII_SIGNS,
    chunks,
    claim,
    column,
    cut_segments,
    cuts_between,
    free_name,
    map_batches,
    numbered,
    put_together,
)
from millrace.workspace import written

CAPACITY = 4096
END_ID = 1
# Steps of the coarse grid in a sequence, and the pieces of a pattern at most.
GRID, FEW = 128, 3
# Weight of the grid lengths below this share of a sequence in the fit; short pieces fit anywhere later.
SHORT, SHORT_WEIGHT = 1 / 16, 0.1
# Distinct words remembered in a generation (see WordEncoder), characters cut at a time, and new words that
# the library gets in one text.
REMEMBERED, CUT_CHARS, GROUP = 300_000, 1 << 21, 100
LONGEST_REMEMBERED = 64
# Texts are cut around white space, which is dropped, and behind a letter.
SPACES = b" \n"
OTHERS = bytes(b for b in range(256) if b not in SPACES)
CUTS = cuts_between((OTHERS, SPACES), (SPACES, OTHERS), (ASCII_LETTERS, ASCII_SIGNS))
# White space of ASCII besides the space and the line end.
OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
# Stands between words that are encoded in one text; it has a token of its own.
BETWEEN = "\x02"


# Tokens


class WordEncoder:
    """Ids of a tokenizers-library vocabulary whose tokenizer drops white space, as little-endian bytes.

    White space only separates words there, so a text is cut at it, each distinct word is encoded by the
    library once, and the ids are put together again. Where the vocabulary has no upper case, A-Z are lower
    before that, and words are also cut between a letter and a digit or punctuation behind it. Texts with
    other white space than spaces and line ends or with combining marks (which may join letters), and
    vocabularies for which this changes the ids of a few test words, go to the library whole. The strings of
    special tokens in a text are ordinary text. Words are remembered in two generations: a full one becomes
    the old one, and the one before it is forgotten, which costs time and never results.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.other = re.compile("[^\\S \n]|[\u0300-\u036f]")
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        between = self._library([BETWEEN])[0]
        self.between = struct.unpack("<I", between)[0] if len(between) == 4 else None
        words = ["Ab", "c1!", "'s", "É", "日本", "don't", "Az", "it's", "ñc", "x"]
        words += [f"{a}{sign}{b}" for a in ("x", "it's", "ñc") for sign in ASCII_SIGNS.decode() for b in ("", "y", "..", "s")]
        text = " \n" + " ".join(words) + "\n\n"
        parts, numbers, _ = cut_segments([text], CUTS, lower=True, drop=SPACES)
        ids = self._library(parts)
        self.cuts = self.between is not None and self._library([text]) == [b"".join([ids[n] for n in numbers])]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _words(self, fresh: list[str]) -> list[bytes]:
        found = {"": b""}
        plain = [w for w in fresh if w and BETWEEN not in w]
        groups = [plain[k : k + GROUP] for k in range(0, len(plain), GROUP)]
        joined = [f"{BETWEEN} " + f" {BETWEEN} ".join(g) for g in groups]
        for group, raw in zip(groups, self._library(joined), strict=True):
            whole = np.frombuffer(raw, "<u4")
            at = (4 * np.append(np.flatnonzero(whole == self.between), len(whole))).tolist()
            if len(at) != len(group) + 1:
                raise AssertionError("a word holds the token between words")
            for word, low, high in zip(group, at, at[1:], strict=False):
                found[word] = raw[low + 4 : high]
        rest = [w for w in fresh if w not in found]
        found.update(zip(rest, self._library(rest), strict=True))
        return [found[w] for w in fresh]

    def learn(self, wanted: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.known) > REMEMBERED:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        found = list(map(known.get, wanted))
        fresh = []
        for number in [n for n, ids in enumerate(found) if ids is None]:
            ids = found[number] = old.get(wanted[number])
            if ids is None:
                fresh.append(number)
            else:
                known[wanted[number]] = ids
        for number, ids in zip(fresh, self._words([wanted[n] for n in fresh]), strict=True):
            found[number] = ids
            if len(wanted[number]) <= LONGEST_REMEMBERED:
                known[wanted[number]] = ids
        return found

    def plain(self, text: str) -> bool:
        """Whether spaces and line ends are the only white space and no mark joins a letter."""
        if not self.cuts or any(sign in text for sign in OTHER_SPACE):
            return False
        return text.isascii() or not self.other.search(text)

    def encode(self, texts: list[str]) -> list[bytes | memoryview]:
        out: list[bytes | memoryview] = [b""] * len(texts)
        plain = [self.plain(text) for text in texts]
        whole = [n for n, ok in enumerate(plain) if not ok]
        for number, ids in zip(whole, self._library([texts[n] for n in whole]), strict=True):
            out[number] = ids
        cut = [n for n, ok in enumerate(plain) if ok]
        if cut:
            words, numbers, begins = cut_segments([texts[n] for n in cut], CUTS, lower=True, drop=SPACES)
            for number, ids in zip(cut, put_together(self.learn(words), numbers, begins, 4), strict=True):
                out[number] = ids
        return out


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary file, made once per Python worker."""
    if path not in _encoders:
        if TaskContext.get() is not None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library would take all
        _encoders[path] = WordEncoder(path)
    claim(f"words {path}", _encoders.clear)
    return _encoders[path]


def token_pieces(
    df: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each text's ids and ``end_id`` in pieces of ``capacity``, the last one shorter: ``key``, ``piece`` (from
    0), ``start`` (its text's ids before it), ``length`` and ``ids_crc32`` (of little-endian unsigned 32-bit ids).

    A null text is empty, so its only id is the end id. Rows are taken as they are: repeated rows and keys and
    null keys give pieces of their own. Other columns are ignored."""
    tail = struct.pack("<I", end_id)
    most = 4 * capacity

    def run(batch):
        ids = word_encoder(path)
        for start, texts in chunks(batch.column(1), CUT_CHARS):
            rows, piece, starts, length, crc = [], [], [], [], []
            for row, raw in enumerate(ids.encode(texts)):
                size = len(raw) + 4
                for number, low in enumerate(range(0, size, most)):
                    high = min(size, low + most)
                    rows.append(row)
                    piece.append(number)
                    starts.append(low // 4)
                    length.append((high - low) // 4)
                    body = zlib.crc32(raw[low : min(high, size - 4)])
                    crc.append(zlib.crc32(tail, body) if high == size else body)
            keys = batch.column(0).slice(start, len(texts)).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(piece, pa.int32()), *[pa.array(c, pa.int64()) for c in (starts, length, crc)]],
                ["key", "piece", "start", "length", "ids_crc32"],
            )

    schema = "key bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    found = map_batches(df.select(column(key).cast("bigint").alias("key"), column(text)), run, schema)
    return found.withColumnRenamed("key", key)


# The plan


def patterns(capacity: int, few: int, allowed: list[int]) -> np.ndarray:
    """All sets of at most ``few`` of the ``allowed`` sizes (repeats too) that add up to ``capacity``, as a
    column of counts each."""
    place = {size: k for k, size in enumerate(allowed)}
    found: list[list[int]] = []

    def extend(parts: list[int], rest: int, largest: int) -> None:
        if rest == 0:
            found.append(parts)
            return
        left = few - len(parts)
        if left == 1:
            if rest <= largest and rest in place:
                found.append([*parts, rest])
        elif left:
            # The largest of the parts that are left is no less than their mean.
            for size in allowed[: bisect_right(allowed, min(rest, largest))][::-1]:
                if size * left < rest:
                    break
                extend([*parts, size], rest - size, size)

    extend([], capacity, capacity)
    out = np.zeros((len(allowed), len(found)))
    for number, parts in enumerate(found):
        for size in parts:
            out[place[size], number] += 1
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative x with the least squares of ``a x - b``, by an active set: the column with the steepest
    gain enters, those that the unconstrained solution turns negative leave."""
    n = a.shape[1]
    x = np.zeros(n)
    inside = np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(4 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[inside] = -np.inf
        if not n or gain.max() <= tolerance:
            break
        inside[int(np.argmax(gain))] = True
        while True:
            at = np.flatnonzero(inside)
            own = a[:, at]
            try:
                best = np.linalg.solve(own.T @ own, own.T @ b)
            except np.linalg.LinAlgError:
                best = np.linalg.lstsq(own, b, rcond=None)[0]
            if best.min() > 0:
                x[:] = 0
                x[at] = best
                break
            low = best <= 0
            old = x[at]
            step = float(np.min(old[low] / np.maximum(old[low] - best[low], 1e-300)))
            x[at] = old + step * (best - old)
            leaving = at[low & (x[at] <= 1e-9 * max(1.0, float(x.max(initial=0.0))))]
            if not len(leaving):
                leaving = at[low]
            x[leaving] = 0
            inside[leaving] = False
            if not inside.any():
                break
    return x


@dataclass
class Run:
    """Equal sequences: how many, what each holds (length and how often), and the room it has left."""

    times: int
    room: int
    parts: list[tuple[int, int]] = field(default_factory=list)

    def add(self, length: int, often: int) -> None:
        self.parts.append((length, often))
        self.room -= length * often


class Stock:
    """Lengths that are still to be packed, with their numbers."""

    def __init__(self, histogram: dict[int, int]) -> None:
        self.count = {length: n for length, n in histogram.items() if n > 0}
        self.lengths = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.lengths.remove(length)

    def longest(self, room: int) -> int | None:
        at = bisect_right(self.lengths, room)
        return self.lengths[at - 1] if at else None


def fitted(histogram: dict[int, int], capacity: int, grid: int, few: int) -> list[tuple[dict[int, int], int]]:
    """Patterns of grid lengths with their rounded repeats, the most frequent first."""
    step = -(-capacity // grid)
    steps = -(-capacity // step)
    coarse: dict[int, int] = {}
    for length, n in histogram.items():
        size = min(steps, -(-length // step))
        coarse[size] = coarse.get(size, 0) + n
    allowed = sorted(coarse)
    columns = patterns(steps, few, allowed)
    if not columns.shape[1]:
        return []
    wanted = np.array([coarse[size] for size in allowed], float)
    # Errors count by the tokens they leave, and little where the pieces are short.
    weight = np.array(allowed, float) / steps
    weight[weight < SHORT] *= SHORT_WEIGHT
    repeats = np.rint(nnls(columns * weight[:, None], wanted * weight)).astype(np.int64)
    order = np.argsort(-repeats, kind="stable")
    return [
        ({allowed[k]: int(columns[k, at]) for k in np.flatnonzero(columns[:, at])}, int(repeats[at]))
        for at in order
        if repeats[at] > 0
    ]


def drawn(sizes: list[int], repeats: int, capacity: int, step: int, stock: Stock) -> Run | None:
    """At most ``repeats`` equal sequences of a pattern, with the longest exact lengths in stock; none if it
    lacks a length. The last place goes to the longest piece that fits what the others left, which is no
    shorter than the pattern's."""
    run = Run(repeats, capacity)
    held: dict[int, int] = {}
    for place, size in enumerate(sizes):
        last = place == len(sizes) - 1
        length = stock.longest(run.room if last else min(size, run.room))
        # Pieces that the sequences took before are out of stock for this place.
        while length is not None and stock.count[length] <= held.get(length, 0):
            length = stock.longest(length - 1)
        if length is None or length <= size - step:
            return None
        held[length] = held.get(length, 0) + 1
        run.room -= length
        run.times = min(run.times, stock.count[length] // held[length])
    run.parts = list(held.items())
    for length, often in run.parts:
        stock.take(length, often * run.times)
    return run


def plan(histogram: dict[int, int], capacity: int = CAPACITY, grid: int = GRID, few: int = FEW) -> list[Run]:
    """Runs of equal sequences that hold every length of the histogram as often as it occurs."""
    bad = [length for length in histogram if not 0 < length <= capacity]
    if bad:
        raise ValueError(f"lengths must be from 1 to {capacity}, not {bad[:5]}")
    stock = Stock(histogram)
    step = -(-capacity // grid)
    runs: list[Run] = []
    for parts, repeats in fitted(histogram, capacity, grid, few):
        sizes = [size * step for size, often in sorted(parts.items(), reverse=True) for _ in range(often)]
        while repeats and (run := drawn(sizes, repeats, capacity, step, stock)) is not None:
            repeats -= run.times
            runs.append(run)
    # The fullest sequences choose first, as they can take the fewest lengths.
    done: list[Run] = []
    for run in sorted(runs, key=lambda r: r.room):
        fill(run, stock, done)
    while stock.lengths:
        length = stock.lengths[-1]
        n, most = stock.count[length], capacity // length
        run = Run(max(1, n // most), capacity)
        run.add(length, min(n, most))
        stock.take(length, run.times * min(n, most))
        fill(run, stock, done)
    return done


def fill(run: Run, stock: Stock, done: list[Run]) -> None:
    """Give each sequence of a run the longest piece that still fits, again and again; a run whose sequences
    cannot all have one is split."""
    waiting = [run]
    while waiting:
        run = waiting.pop()
        while (length := stock.longest(run.room)) is not None:
            n = stock.count[length]
            if n < run.times:
                rest = Run(run.times - n, run.room, list(run.parts))
                waiting.append(rest)
                run.times = n
            often = min(run.room // length, n // run.times)
            run.add(length, often)
            stock.take(length, often * run.times)
        done.append(run)


@dataclass(frozen=True)
class Places:
    """Where the pieces of each length go: ``first`` is a length and the number of a piece among those of that
    length, from which on they go, ``often`` to a sequence, to the sequences from ``sequence``, at ``offset``."""

    first: np.ndarray
    sequence: np.ndarray
    often: np.ndarray
    offset: np.ndarray
    lengths: np.ndarray
    before: np.ndarray
    sequences: int


# Bits for the number of a piece among those of its length.
NUMBER_BITS = 48


def places(histogram: dict[int, int], runs: list[Run]) -> Places:
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for run in runs:
        offset = 0
        for length, often in run.parts:
            first = used.get(length, 0)
            rows.append(((length << NUMBER_BITS) + first, sequence, often, offset))
            used[length] = first + often * run.times
            offset += often * length
        sequence += run.times
    if used != {length: n for length, n in histogram.items() if n}:
        raise AssertionError("the plan does not hold every piece once")
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    lengths = np.array(sorted(used), np.int64)
    counts = np.array([used[int(length)] for length in lengths], np.int64)
    return Places(*table.T, lengths, np.cumsum(counts) - counts, sequence)


def pack(df: DataFrame, length: str = "length", capacity: int = CAPACITY, grid: int = GRID, few: int = FEW) -> DataFrame:
    """``df`` with the sequence that each row goes to, ``sequence_id`` (from 0), and its ``offset`` in it.

    Lengths must be from 1 to ``capacity``; anything else, a null too, is an error. The rows of a sequence
    follow each other without gaps. Rows of one length, repeated rows among them, take the places for that
    length in any order, which is fixed once they are numbered. Columns of those two names are replaced. An
    empty table gives an empty table. Runs jobs when called: the histogram (``capacity`` rows at most) and a
    count per range of rows reach the driver. The table of places goes to all tasks; it has a row per run of
    equal sequences and length, whose number depends on the capacity and not on the rows.
    """
    spark = df.sparkSession
    kept = df.drop("sequence_id", "offset")
    mark, number = free_name(kept, "_mark"), free_name(kept, "_number")
    rows = written(kept.withColumn(mark, F.monotonically_increasing_id()), "pieces")
    counts = rows.groupBy(column(length).cast("bigint").alias("length")).agg(F.count("*").alias("n")).collect()
    if any(r.length is None for r in counts):
        raise ValueError("a length is null")
    histogram = {r.length: r.n for r in counts}
    shared = spark.sparkContext.broadcast(places(histogram, plan(histogram, capacity, grid, few)))
    ordered = numbered(rows, [column(length), column(mark)], number)
    names = kept.columns
    # Numbered columns, as a function over batches takes no dots in names.
    plain = ordered.select(*[column(c).alias(f"c{k}") for k, c in enumerate(names)], column(number).alias("number"))
    own = names.index(length)
    schema = T.StructType(
        [*plain.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(batch):
        made = shared.value
        sizes = batch.column(own).cast(pa.int64()).to_numpy(zero_copy_only=False)
        within = batch.column(len(names)).to_numpy() - made.before[np.searchsorted(made.lengths, sizes)]
        place = (sizes << NUMBER_BITS) + within
        slot = np.searchsorted(made.first, place, "right") - 1
        turn = place - made.first[slot]
        sequence = made.sequence[slot] + turn // made.often[slot]
        offset = made.offset[slot] + turn % made.often[slot] * sizes
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], schema.names
        )

    return map_batches(plain, run, schema).toDF(*names, "sequence_id", "offset")


def packed_texts(
    df: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all texts (``token_pieces``) with the place of each (``pack``)."""
    return pack(token_pieces(df, path, capacity, end_id, key, text), "length", capacity)
