"""Importance resampling towards a target: hashed n-gram features, log ratios, Gumbel top-k.

The bucket of a feature is its CRC-32. A CRC is affine: that of a string is a constant of its length,
exclusive-or a contribution of each byte that depends on the byte and its distance from the end only. So
the words of many texts lie in one buffer with a space behind each, contributions come from a table by
distance and byte, and ``bitwise_xor.reduceat`` folds them over all features at once. Features longer than
the table is deep are cut into blocks from their end, and a register runs over the blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import chunks, column, map_batches, numbered
from millrace.workspace import written

BUCKETS = 10_000
# Of the texts with at least MIN_WORDS words this share is drawn, with this seed.
PERCENT, MIN_WORDS, SEED = 25, 20, 7
# Distances that the table of contributions has, which is also the size of a block of a longer feature.
DEPTH = 64
# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
FULL = np.uint32(0xFFFFFFFF)
# Words whose features are made at once, which bounds the memory that a very long text takes.
WORDS = 1 << 18

_byte = np.arange(256)
# A-Z in lower case, all other bytes as they are.
_LOWER = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte).astype(np.uint8)
# Bytes of words: digits, letters of ASCII, and every byte of the other code points.
_WORD = (
    ((_byte >= 0x30) & (_byte <= 0x39))
    | ((_byte >= 0x41) & (_byte <= 0x5A))
    | ((_byte >= 0x61) & (_byte <= 0x7A))
    | (_byte >= 0x80)
)


def _bytewise() -> np.ndarray:
    """The register after one byte, from zero."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, (register >> 1) ^ np.uint32(POLYNOMIAL), register >> 1)
    return register


@dataclass(frozen=True)
class Tables:
    """``places[d * 256 + b]``: what byte b contributes from d bytes before the end. ``opening[n]``: what
    the register's initial value has become after n bytes. ``block[j, b]``: byte j of the register, of value
    b, DEPTH bytes later."""

    places: np.ndarray
    opening: np.ndarray
    block: np.ndarray


@cache
def tables() -> Tables:
    one = _bytewise()

    def step(register: np.ndarray) -> np.ndarray:
        return (register >> np.uint32(8)) ^ one[register & np.uint32(255)]

    places = [one]
    for _ in range(DEPTH - 1):
        places.append(step(places[-1]))
    opening = [np.full(1, FULL)]
    for _ in range(DEPTH):
        opening.append(step(opening[-1]))
    block = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(DEPTH):
        block = step(block)
    return Tables(np.concatenate(places), np.concatenate(opening), block)


def long_spans(buffer: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of spans of any length: blocks of DEPTH bytes from the end, the first one shorter."""
    made = tables()
    if not len(begins):
        return np.zeros(0, np.uint32)
    order = np.argsort(begins - ends, kind="stable")  # the longest first, so that those still running are in front
    begins, ends = begins[order], ends[order]
    blocks = -((begins - ends) // DEPTH)
    first = (ends - begins) - (blocks - 1) * DEPTH
    register = np.zeros(len(begins), np.uint32)
    for number in range(int(blocks[0])):
        running = int(np.searchsorted(-blocks, -number, "left"))
        if number == 0:
            sizes, at = first, begins
        else:
            sizes = np.full(running, DEPTH)
            at = begins[:running] + first[:running] + (number - 1) * DEPTH
        offsets = np.cumsum(sizes) - sizes
        inside = np.arange(int(sizes.sum())) - np.repeat(offsets, sizes)
        signs = buffer[np.repeat(at, sizes) + inside]
        distance = np.repeat(sizes, sizes) - 1 - inside
        added = np.bitwise_xor.reduceat(made.places[(distance << 8) | signs], offsets)
        if number == 0:
            register = added ^ made.opening[sizes]
        else:
            old = register[:running]
            for place in range(4):
                added ^= made.block[place][(old >> np.uint32(8 * place)) & np.uint32(255)]
            register[:running] = added
    found = np.empty(len(begins), np.uint32)
    found[order] = register ^ FULL
    return found


def word_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts in lower case with a space behind each, as bytes; their sizes, and how many
    each text has."""
    blobs = [text.encode() for text in texts]
    raw = np.frombuffer(b"\n".join([*blobs, b""]), np.uint8)
    inside = _WORD[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(raw) and inside[0]:
        edges = np.concatenate([[0], edges])
    begins, ends = edges[0::2], edges[1::2]
    bounds = np.cumsum([0, *(len(blob) + 1 for blob in blobs)])
    counts = np.diff(np.searchsorted(begins, bounds))
    behind = np.zeros(len(raw), bool)
    behind[ends] = True
    buffer = _LOWER[raw]
    buffer[ends] = 0x20
    return buffer[inside | behind], ends - begins, counts


def feature_crcs(buffer: np.ndarray, sizes: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of each word, and of each word that ``pairs`` marks with the word behind it.

    ``buffer`` has the words of ``sizes``, each with a space behind it."""
    if not len(sizes):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    made = tables()
    steps = sizes + 1
    ends = np.cumsum(steps)
    begins = ends - steps
    # Distance of each byte from the end of its word; the space behind it has -1 and contributes nothing.
    distance = np.repeat((ends - 2).astype(np.int32), steps) - np.arange(len(buffer), dtype=np.int32)
    signs = buffer.astype(np.int32)
    single = made.places.take((np.minimum(distance, DEPTH - 1) << 8) | signs, mode="clip")
    single[ends - 1] = 0
    own = np.bitwise_xor.reduceat(single, begins)
    words = own ^ made.opening[np.minimum(sizes, DEPTH)] ^ FULL
    far = np.flatnonzero(sizes > DEPTH)
    words[far] = long_spans(buffer, begins[far], begins[far] + sizes[far])

    # In a pair, the first word and the space are further from the end by the second word, whose own
    # contributions are the same as alone.
    behind = np.append(sizes[1:], 0)
    both = sizes + 1 + behind
    apart = distance + np.repeat(behind.astype(np.int32) + 1, steps)
    front = np.bitwise_xor.reduceat(made.places.take((np.minimum(apart, DEPTH - 1) << 8) | signs, mode="clip"), begins)
    joined = front ^ np.append(own[1:], np.uint32(0)) ^ made.opening[np.minimum(both, DEPTH)] ^ FULL
    far = np.flatnonzero((both > DEPTH) & pairs)
    joined[far] = long_spans(buffer, begins[far], begins[far] + both[far])
    return words, joined[pairs]


def text_features(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """In parts of WORDS words: buckets of single words, the text of each, and the same of pairs."""
    buffer, sizes, counts = word_spans(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(sizes + 1)
    for low in range(0, len(sizes), WORDS):
        high = min(len(sizes), low + WORDS)
        # The word behind the part's last one is there for its pair only.
        reach = min(len(sizes), high + 1)
        part = buffer[ends[low] - sizes[low] - 1 : ends[reach - 1]]
        pairs = np.zeros(reach - low, bool)
        pairs[: reach - low - 1] = owner[low : reach - 1] == owner[low + 1 : reach]
        words, joined = feature_crcs(part, sizes[low:reach], pairs)
        yield words[: high - low] % buckets, owner[low:high], joined % buckets, owner[low:reach][pairs]


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task hands on one row per bucket at most,
    and so does the sum over the table to the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                for words, _, joined, _ in text_features(texts, buckets):
                    total += np.bincount(words, minlength=buckets) + np.bincount(joined, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    parts = df.select(column(text)).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares in the target and in the source."""
    buckets = len(source)
    sources, targets = float(int(source.sum()) + buckets), float(int(target.sum()) + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((float(t + 1) * sources) / (float(s + 1) * targets)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _noise(key: int | None, seed: int) -> int:
    """Gumbel noise in thousandths; a null key is drawn for as an empty one."""
    h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(df: DataFrame, gains: np.ndarray, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row."""
    buckets = len(gains)

    def run(batch):
        for start, texts in chunks(batch.column(1)):
            total = np.zeros(len(texts), np.int64)
            words = np.zeros(len(texts), np.int64)
            for singles, owner, joined, pair_owner in text_features(texts, buckets):
                words += np.bincount(owner, minlength=len(texts))
                for found, at in ((singles, owner), (joined, pair_owner)):
                    if len(at):
                        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                        total[at[starts]] += np.add.reduceat(gains[found], starts)
            features = np.maximum(2 * words - 1, 0)
            weight = total // np.maximum(features, 1)
            keys = batch.column(0).slice(start, len(texts))
            noise = np.array([_noise(k, seed) for k in keys.to_pylist()], np.int64)
            columns = [words, features, weight, weight + noise]
            yield pa.RecordBatch.from_arrays(
                [keys, *[pa.array(c, pa.int64()) for c in columns]],
                ["key", "n_words", "n_features", "weight", "score"],
            )

    schema = "key bigint, n_words bigint, n_features bigint, weight bigint, score bigint"
    return map_batches(df.select(column(key).cast("bigint").alias("key"), column(text)), run, schema)


def resample(
    df: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the texts with at least ``min_words`` words, likelier the closer to ``target``.

    Features are all words (runs of digits, letters of ASCII in lower case, and code points above it) and all
    pairs of neighbouring words; repeats count. Returns every row's ``key``, ``n_features``, ``weight`` (the
    floored mean of its features' gains, 0 without any), ``score`` (weight plus noise by seed and key) and
    ``rank`` among the rows drawn: the highest scores, ties to the smaller key; null if not drawn.

    Null texts have no words. A null key gets the noise of an empty one and ranks before others in a tie.
    Rows that repeat a key get the same noise; those that tie in score and key too rank by more features, and
    then in any order. Other columns are ignored. An empty table gives an empty table; an empty target counts
    zero in every bucket. Runs jobs when called: both tables' bucket counts reach the driver (``buckets``
    numbers each), as do counts of ranges.
    """
    gains = bucket_gains(bucket_counts(df, text, buckets), bucket_counts(target, target_text, buckets))
    found = scored(df, gains, seed, key, text).withColumn("mark", F.monotonically_increasing_id())
    found = written(found, "resampling")
    drawable = F.col("n_words") >= min_words
    n = found.where(drawable).count()
    order = [F.desc("score"), F.asc_nulls_first("key"), F.desc("n_features"), F.asc("mark")]
    place = F.col("rank") + 1
    drawn = numbered(found.where(drawable), order, "rank")
    drawn = drawn.withColumn("rank", F.when(place <= percent * n // 100, place))
    rest = found.where(~drawable).withColumn("rank", F.lit(None).cast("bigint"))
    names = [F.col("key").alias(key), "n_features", "weight", "score", "rank"]
    return drawn.select(*names).unionByName(rest.select(*names))
