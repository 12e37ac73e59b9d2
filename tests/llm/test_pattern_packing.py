"""Pattern packing against the library's ids, best-fit decreasing and the rules of a packing."""

import random
import string
import zlib
from bisect import bisect_left, insort

import numpy as np
import pytest

from llm.conftest import ODD
from millrace.llm import pattern_packing
from millrace.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def plain_ids(library, text):
    return np.asarray([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def odd_texts(n):
    rng = random.Random(4)
    parts = ["Word", "don't", "it's.", "'S", "42", "a1b2", "É", "é", "J̌", "ΑΣ", "İ", "日本", "...", ").", "x,", "x,,", "Z!?"]
    parts += ["<|endoftext|>", "\x02", "\x1f", "\x00", "​", "́", "😀", " ", " ", " ", "\n", "\t", " ", "_", "ﬁ", "ß."]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_equal_the_library(library, monkeypatch):
    texts = [text or "" for _, text in ODD] + odd_texts(400)
    for remembered in (pattern_packing.REMEMBERED, 5):
        monkeypatch.setattr(pattern_packing, "REMEMBERED", remembered)
        encoder = pattern_packing.WordEncoder(PATH)
        assert encoder.cuts
        for _ in range(2):
            for k in range(0, len(texts), 50):
                part = texts[k : k + 50]
                assert [bytes(ids) for ids in encoder.encode(part)] == [plain_ids(library, t)[:-1].tobytes() for t in part]


def test_words_and_signs(library, monkeypatch):
    """The library gets a word once, whatever sign is behind it."""
    encoder = pattern_packing.WordEncoder(PATH)
    signs = string.digits + string.punctuation
    texts = [f"A word{sign} Word{sign}{sign}\nword{sign}S word{sign}1 (wORd) it's{sign}" for sign in signs]
    rng = random.Random(5)
    texts += ["".join(rng.choices("abZé日 \n" + signs, k=40)) for _ in range(500)]
    assert [bytes(ids) for ids in encoder.encode(texts)] == [plain_ids(library, t)[:-1].tobytes() for t in texts]
    encoder, sent = pattern_packing.WordEncoder(PATH), []
    words = encoder._words
    monkeypatch.setattr(encoder, "_words", lambda fresh: sent.extend(fresh) or words(fresh))
    encoder.encode([f"a word{sign} Word" for sign in signs])
    assert sent.count("word") == 1 and sorted(s for s in sent if s.strip()) == sorted(["a", "word", *signs])


def test_other_vocabularies_go_to_the_library_whole():
    encoder = pattern_packing.WordEncoder(vocabulary("byte_bpe_50k.json"))
    assert not encoder.cuts
    expected = [np.asarray(encoder.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ("a b", "")]
    assert [bytes(ids) for ids in encoder.encode(["a b", ""])] == expected


def test_nnls_meets_its_conditions():
    """At the least squares no column can gain, and columns in use neither gain nor lose."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.random((8, 15)), rng.random(8) * 10 - 2
        x = pattern_packing.nnls(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and gain.max() < 1e-6 and np.abs(gain[x > 0]).max(initial=0) < 1e-6


def test_patterns_are_all_sets_that_fill():
    found = pattern_packing.patterns(12, 3, [1, 3, 4, 5, 6, 12])
    sets = {tuple(int(n) for n in column) for column in found.T}
    assert len(sets) == found.shape[1]
    sizes = [1, 3, 4, 5, 6, 12]
    expected = set()
    for a in range(6):
        for b in [None, *range(a, 6)]:
            for c in [None] if b is None else [None, *range(b, 6)]:
                chosen = [k for k in (a, b, c) if k is not None]
                if sum(sizes[k] for k in chosen) == 12:
                    expected.add(tuple(chosen.count(k) for k in range(6)))
    assert sets == expected


def best_fit_decreasing(histogram, capacity):
    rooms, n = [], 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            at = bisect_left(rooms, length)
            room = rooms.pop(at) if at < len(rooms) else capacity
            n += room == capacity
            if room > length:
                insort(rooms, room - length)
    return n


@pytest.mark.parametrize(
    "make",
    [
        lambda rng: rng.integers(1, 4097, 5000),
        lambda rng: rng.integers(800, 2100, 5000),
        lambda rng: np.clip(rng.lognormal(6, 1, 20000).astype(int), 1, 4096),
        lambda rng: rng.integers(1, 50, 3000),
        lambda rng: np.full(1000, 1500),
        lambda rng: np.full(10, 4096),
        lambda rng: rng.integers(1, 4097, 3),
    ],
)
def test_plan_is_about_as_good_as_best_fit_decreasing(make):
    lengths = make(np.random.default_rng(6))
    histogram = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True), strict=True)}
    runs = pattern_packing.plan(histogram)
    made = pattern_packing.places(histogram, runs)  # checks that every piece has one place
    assert all(run.room >= 0 and run.room == 4096 - sum(a * b for a, b in run.parts) for run in runs)
    assert made.sequences <= 1.01 * best_fit_decreasing(histogram, 4096) + 1


def test_plan_refuses_lengths_that_do_not_fit():
    for length in (0, -1, 4097):
        with pytest.raises(ValueError):
            pattern_packing.plan({length: 1})
    assert pattern_packing.plan({}) == []


def check(found, capacity):
    sequences = {}
    for row in found:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(sequences) == set(range(len(sequences)))
    return len(sequences)


@pytest.mark.parametrize("capacity", [4096, 7])
def test_packed_texts(spark, docs, library, capacity):
    table = [*ODD, *enumerate(odd_texts(60), 100), *[(50, "the same text again")] * 40]
    found = pattern_packing.packed_texts(docs(table), PATH, capacity).collect()
    expected = []
    for key, text in table:
        ids = plain_ids(library, text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            expected.append((key, piece, start, len(own), zlib.crc32(own.tobytes())))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert list(found[0].asDict()) == columns
    assert sorted(map(str, (tuple(row)[:5] for row in found))) == sorted(map(str, expected))
    n = check(found, capacity)
    total = sum(row.length for row in found)
    assert -(-total // capacity) <= n <= 1.1 * -(-total // capacity) + 1


def test_pack_keeps_other_columns_and_splits_equal_rows(spark, settings):
    settings(spark__sql__adaptive__enabled="false")
    rows = [(5, "a", 1.0, None)] * 3000 + [(90, None, None, "mine")] * 20
    df = spark.createDataFrame(rows, "length int, `odd.name` string, _number double, offset string")
    found = pattern_packing.pack(df, "length", 100)
    assert found.columns == ["length", "odd.name", "_number", "sequence_id", "offset"]
    assert found.rdd.glom().map(len).map(lambda n: n < 2000).reduce(lambda a, b: a and b)
    found = found.collect()
    assert check(found, 100) == 3000 // 20 + 18 and len(found) == 3020
    assert sum(r["odd.name"] is None for r in found) == 20


def test_pack_of_empty_tables(spark, docs):
    assert pattern_packing.packed_texts(docs([]), PATH).collect() == []
    with pytest.raises(ValueError):
        pattern_packing.pack(spark.createDataFrame([(None,)], "length int"))
