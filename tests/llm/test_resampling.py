"""Importance resampling against a plain version of it."""

import math
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import ODD
from millrace.llm import resampling
from millrace.llm.common import numbered


def plain_features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return words, [zlib.crc32(gram.encode()) % resampling.BUCKETS for gram in grams]


def plain_resample(table, target, percent, min_words):
    found = [(key, *plain_features(text)) for key, text in table]
    s, t = [0] * resampling.BUCKETS, [0] * resampling.BUCKETS
    for _, _, buckets in found:
        for b in buckets:
            s[b] += 1
    for text in target:
        for b in plain_features(text)[1]:
            t[b] += 1
    S, T = sum(s) + len(s), sum(t) + len(t)
    gains = [math.floor(1000 * math.log((b + 1) * S / ((a + 1) * T))) for a, b in zip(s, t, strict=True)]
    out = []
    for key, words, buckets in found:
        weight = sum(gains[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)])
    order = sorted(
        (row for row in out if row[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, -r[1])
    )
    for place, row in enumerate(order[: percent * len(order) // 100], 1):
        row.append(place)
    return sorted(map(str, (tuple(row[:4]) + (row[5] if len(row) > 5 else None,) for row in out)))


def some_texts(n):
    rng = random.Random(3)
    signs = ["a", "Bc", "d9", "é", "日本", "x" * 70, "-", "'", "\x00", "\t", " ", " ", " "]
    return ["".join(rng.choice(signs) + " " * rng.randint(0, 1) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_crc_of_spans():
    rng = np.random.default_rng(5)
    depth = resampling.DEPTH
    buffer = rng.integers(0, 256, 5000).astype(np.uint8)
    sizes = np.array([0, 1, 2, depth - 1, depth, depth + 1, 2 * depth, 2 * depth + 3, 3000])
    begins = rng.integers(0, 2000, len(sizes))
    keep = sizes > 0
    found = resampling.long_spans(buffer, begins[keep], (begins + sizes)[keep])
    assert found.tolist() == [zlib.crc32(buffer[a : a + n].tobytes()) for a, n in zip(begins[keep], sizes[keep], strict=True)]
    assert resampling.long_spans(buffer, begins[:0], begins[:0]).tolist() == []


@pytest.mark.parametrize("words", [1 << 18, 3])
def test_features_equal_library_crc(monkeypatch, words):
    monkeypatch.setattr(resampling, "WORDS", words)
    texts = [text or "" for _, text in ODD[:7]] + some_texts(40) + ["q" * 31 + " " + "r" * 32, "s" * 32 + " " + "t" * 32]
    found = [[] for _ in texts]
    for singles, owner, pairs, pair_owner in resampling.text_features(texts, resampling.BUCKETS):
        for bucket, at in zip([*singles.tolist(), *pairs.tolist()], [*owner.tolist(), *pair_owner.tolist()], strict=True):
            found[at].append(bucket)
    assert [sorted(x) for x in found] == [sorted(plain_features(text)[1]) for text in texts]
    assert list(resampling.text_features([], 10)) == [] == list(resampling.text_features(["", "- -"], 10))


def test_resampling_equals_brute_force(spark, docs, settings):
    settings(spark__sql__shuffle__partitions="5")
    table = [*ODD, *[(key % 40, text) for key, text in enumerate(some_texts(90), 100)], *[(70, "one text " * 30)] * 30]
    target = [*some_texts(5), None, ""]
    benchmark = spark.createDataFrame([(text,) for text in target], "text string")
    found = resampling.resample(docs(table), benchmark, percent=40, min_words=10).collect()
    assert sorted(map(str, map(tuple, found))) == plain_resample(table, target, 40, 10)


def test_resampling_of_empty_tables(spark, docs):
    target = spark.createDataFrame([("some text",)], "text string")
    assert resampling.resample(docs([]), target).collect() == []
    row = resampling.resample(docs([(1, "w " * 20)]), target.limit(0), percent=100).first()
    assert (row.doc_id, row.n_features, row["rank"]) == (1, 39, 1)


def test_equal_rows_are_numbered_over_several_tasks(spark, docs, settings):
    """One key as all rows: the ranges split it, as every row has a mark of its own."""
    settings(spark__sql__adaptive__enabled="false")
    rows = docs([(1, "one two three four")] * 2000).select("doc_id")
    rows = rows.withColumn("mark", F.monotonically_increasing_id())
    order = [F.asc("doc_id"), F.asc("mark")]
    found = numbered(rows, order, "number").orderBy("mark").collect()
    assert [r.number for r in found] == list(range(2000))
    held = rows.repartitionByRange(*order).rdd.glom().map(len).collect()
    assert max(held) < 1000
