"""Operators that look at one text at a time: against the libraries, patterns and plain versions."""

import re
import string
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import rows
from llm.conftest import ODD
from millrace.llm import multiset, personal, pieces, quality, token_files
from millrace.llm.common import cut_segments, cuts_between, read_table
from millrace.llm.queries import QUERIES, vocabulary

PIECES, BYTES = vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json")
ASCII_SIGNS = string.digits + string.punctuation


def texts_of(spark, sf_dir):
    return [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


# sentencepiece


def test_pieces_equal_the_library(spark, sf_dir, library):
    found = {r.doc_id: r for r in QUERIES["op2_sentencepiece"](spark, sf_dir).collect()}
    for key, text in texts_of(spark, sf_dir):
        ids = library.encode(text or "")
        assert found[key].n_tokens == len(ids)
        assert found[key].ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[key].decoded_sha256 == sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_texts(docs, library):
    rng = np.random.default_rng(1)
    signs = list("ab  \n▁é日😀the,.\t")
    table = ODD + [(100 + n, "".join(rng.choice(signs, rng.integers(0, 50)))) for n in range(300)]
    encoded = pieces.encode(docs(table), PIECES)
    assert encoded.columns[-1] == "ids" and "score" in encoded.columns
    decoded = pieces.decode(encoded, PIECES).collect()
    assert len(decoded) == len(table)
    for row in decoded:
        assert row.ids == library.encode(row.text or "")
        assert row.decoded == library.decode(row.ids)
    assert pieces.token_digests(docs([]), PIECES).collect() == []


def test_pieces_forget_without_a_trace(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    codec = pieces.PieceCodec(PIECES)
    for n in range(50):
        text = f"some words {n} and some more {n * n}\nagain"
        assert bytes(codec.round_trip([text])[0][0]) == ",".join(map(str, library.encode(text))).encode()


def test_long_and_short_agenda_agree(monkeypatch):
    codec = pieces.PieceCodec(PIECES)
    rng = np.random.default_rng(2)
    words = ["▁" + "".join(rng.choice(list("therandion"), 20)) for _ in range(200)]
    short = [codec.merge(w) for w in words]
    monkeypatch.setattr(pieces, "SHORT", 0)
    assert short == [codec.merge(w) for w in words]


def test_short_segments_are_merged_together(monkeypatch, library):
    """The arrays take all short segments of ordinary characters, and agree with the agenda of one segment."""
    codec = pieces.PieceCodec(PIECES)
    rng = np.random.default_rng(5)
    signs = list("therandion▁▁é.,(日")
    words = ["▁" + "".join(rng.choice(signs, rng.integers(0, 31))) for _ in range(2000)]
    words += ["▁" * n for n in range(1, 40)] + ["▁the", "x", "▁😀", "▁" + "word" * 20]
    rows, sizes, _ = codec.agenda.merge(words)
    ids, begins = codec.merge_all(words)
    one = [codec.merge(w) for w in words]
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:], strict=False)] == one
    assert sizes.tolist() == [len(one[n]) for n in rows]
    plain = ["▁" + "".join(rng.choice(list("therandion"), rng.integers(1, 31))) for _ in range(500)]
    monkeypatch.setattr(codec, "merge", lambda _: pytest.fail("a segment was merged by itself"))
    assert len(codec.merge_all(plain)[1]) == 501


def test_pieces_of_words_and_signs(monkeypatch, library):
    """A word is learnt once, whatever sign is behind it."""
    codec = pieces.PieceCodec(PIECES)
    texts = [f"a word{sign} word{sign}{sign}\n  word{sign}s (word) 1{sign}word▁" for sign in ASCII_SIGNS]
    texts += [t.replace("▁", "") for t in texts]
    learnt = []
    merge = codec.merge_all
    monkeypatch.setattr(codec, "merge_all", lambda segments: learnt.extend(segments) or merge(segments))
    found = codec.round_trip(texts)
    assert [bytes(ids).decode() for ids, _ in found] == [",".join(map(str, library.encode(t))) for t in texts]
    assert [bytes(out).decode() for _, out in found] == [library.decode(library.encode(t)) for t in texts]
    codec, learnt = pieces.PieceCodec(PIECES), []
    merge = codec.merge_all
    monkeypatch.setattr(codec, "merge_all", lambda segments: learnt.extend(segments) or merge(segments))
    codec.round_trip([f"a word{sign}" for sign in ASCII_SIGNS])
    assert learnt.count("▁word") == 1 and len(learnt) == 2 + len(ASCII_SIGNS)


# token files


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(BYTES)
    made.encode_special_tokens = True
    return made


def test_token_files_equal_the_library(spark, sf_dir, tokenizer):
    found = rows(QUERIES["op8_token_ids"](spark, sf_dir), "doc_id", "start", "n_tokens", "ids_crc32")
    start, expected = 0, []
    for key, text in sorted(texts_of(spark, sf_dir)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((key, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == expected


def test_token_files_of_odd_texts(spark, docs, tokenizer):
    rng = np.random.default_rng(3)
    signs = list("ab  \n\n'sé日😀the,.12\t\x1c\x85 ")
    table = ODD + [(100 + n, "".join(rng.choice(signs, rng.integers(0, 50)))) for n in range(500)]
    files = token_files.write_ids(docs(table), BYTES)
    found = token_files.read_ids(spark, files).orderBy("start").collect()
    order = sorted(table, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.key for r in found] == [key for key, _ in order]
    assert [r.ids for r in found] == [
        tokenizer.encode(text or "", add_special_tokens=False).ids + [2] for _, text in order
    ]
    assert files.n_tokens == sum(r.n_tokens for r in found)
    # One document by its frame alone.
    name, start = files.parts[-1], files.starts[-1]
    first = next(r for r in found if r.start == start)
    assert token_files.read_document(files, name, 0).tolist() == first.ids
    empty = token_files.write_ids(docs([]), BYTES)
    assert token_files.read_ids(spark, empty).collect() == [] and empty.n_tokens == 0


def test_token_files_of_words_and_signs(monkeypatch, tokenizer):
    """The library gets a word once, whatever sign is behind it."""
    ids = token_files.IdEncoder(BYTES)
    rng = np.random.default_rng(6)
    texts = [f"a word{sign} word{sign}{sign}\nword{sign}s word{sign}1 (word) it's{sign}" for sign in ASCII_SIGNS]
    texts += ["".join(rng.choice(list("abZé日 \n" + ASCII_SIGNS), 40)) for _ in range(500)]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in ids.encode(texts)] == expected
    assert ids.counts(texts) == [len(e) for e in expected]
    ids, sent = token_files.IdEncoder(BYTES), []
    segments = ids._segments
    monkeypatch.setattr(ids, "_segments", lambda fresh: sent.extend(fresh) or segments(fresh))
    ids.encode([f"a word{sign}" for sign in ASCII_SIGNS])
    assert sent.count(" word") == 1 and len(sent) == 2 + len(ASCII_SIGNS)


def test_cut_segments():
    cuts = cuts_between((b"abc", b" ,"), (b" ", b"abc"))
    texts = ["", "ab, é c", "", "C a", ""]
    parts, numbers, begins = cut_segments(texts, cuts)
    whole = [[parts[n] for n in numbers[a:b]] for a, b in zip(begins, begins[1:], strict=False)]
    assert whole == [[], ["ab", ", é ", "c"], [], ["C ", "a"], []]
    parts, numbers, begins = cut_segments(texts, cuts, lower=True, drop=b"c")
    whole = [[parts[n] for n in numbers[a:b]] for a, b in zip(begins, begins[1:], strict=False)]
    assert whole == [[], ["ab", ", é "], [], [" ", "a"], []]
    assert cut_segments(["", ""], cuts)[2].tolist() == [0, 0, 0] and cut_segments([], cuts)[0] == []


def test_token_files_need_their_dictionary(spark, docs):
    texts = [(n, f"words of a text with number {n} and a few more") for n in range(50)]
    one = token_files.write_ids(docs(texts), BYTES)
    other = token_files.write_ids(docs([(n, t[::-1]) for n, t in texts]), BYTES)
    mixed = token_files.TokenFiles(one.folder, one.parts, one.starts, one.n_tokens)
    from millrace.llm.common import file_system

    files, root = file_system(one.folder)
    files.copy_file(f"{file_system(other.folder)[1]}/dictionary", f"{root}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_ids(spark, mixed).collect()


# personal data


def plain_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def sound(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [
        (kind, m.start(), m.end())
        for kind, pattern in patterns.items()
        for m in re.finditer(pattern, text)
        if sound(kind, m.group())
    ]


def test_base_spans_equal_the_patterns(spark, sf_dir):
    rng = np.random.default_rng(4)
    signs = list("ab@@..-+12 3()5%_é\n0")
    odd = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(5000)]
    odd += ["a@b@c.d", "x@y.z@w.v", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "9" * 4000 + ".1.1.1", "+1 2-"]
    for text in odd:
        assert personal.base_spans(text) == plain_spans(text), text
    found = {r.doc_id: r for r in QUERIES["op3_personal_data"](spark, sf_dir).collect()}
    for key, text in texts_of(spark, sf_dir):
        spans = plain_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        row = found[key]
        assert row.base_sha256 == sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in personal.KINDS] == [sum(s[0] == k for s in spans) for k in personal.KINDS]
        assert set(joined.split(",")) <= set(row.spans.split(",")) or not joined


def test_network_gradient():
    tagger = personal.Tagger({k: v.astype(np.float64) for k, v in personal.Tagger.new().p.items()})
    rng = np.random.default_rng(5)
    ids = rng.integers(0, personal.CLASSES, (3, 9)).astype(np.int16)
    gold = rng.integers(0, personal.TAGS, (3, 9)).astype(np.int8)
    _, slopes = tagger.slopes(ids, gold)
    for name, slope in slopes.items():
        place = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        value, step = tagger.p[name][place], 1e-3
        losses = []
        for moved in (value + step, value - step):
            tagger.p[name][place] = moved
            losses.append(tagger.slopes(ids, gold)[0])
        tagger.p[name][place] = value
        assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(slope[place], rel=1e-2, abs=1e-3)


def test_decoding_finds_the_best_path():
    tagger = personal.Tagger.new(3)
    rng = np.random.default_rng(6)
    tagger.p["T"] = rng.normal(0, 1, tagger.p["T"].shape).astype(np.float32)
    ids = rng.integers(0, personal.CLASSES, (4, 4)).astype(np.int16)
    lengths = np.array([4, 3, 2, 1])
    mask = (np.arange(4) < lengths[:, None]).astype(np.float32)
    scores, tags = tagger.emissions(ids, mask), tagger.decode(ids, lengths)

    def worth(row, path):
        total = tagger.p["S"][path[0]] + tagger.p["Z"][path[-1]] + sum(scores[t, row, tag] for t, tag in enumerate(path))
        return total + sum(tagger.p["T"][a, b] for a, b in zip(path, path[1:], strict=False))

    for row, size in enumerate(lengths):
        grid = np.indices((personal.TAGS,) * size).reshape(size, -1).T
        best = max(worth(row, path) for path in grid)
        assert worth(row, tags[row, :size]) == pytest.approx(best, abs=1e-4)


@pytest.fixture(scope="module")
def tagger(spark):
    rng = np.random.default_rng(7)
    made = []
    for n in range(900):
        words = " ".join(rng.choice(["the", "of", "there", "Anble", "version 3.", "AKIA5BAM7KP", "token=8a9f0"], 12))
        digits = "".join(map(str, rng.integers(1, 9, 10)))
        card = "4" + "".join(map(str, rng.integers(0, 9, 14)))
        card += next(d for d in "0123456789" if personal.luhn(card + d))
        data = (
            f"{rng.choice(['abc', 'hsr', 'loogm'])}.{n % 90 + 10}@mail{n % 9}.example.com",
            ".".join(map(str, rng.integers(1, 255, 4))),
            card,
            f"+1 ({digits[:3]}) {digits[3:6]}-{digits[6:]}",
        )[n % 4]
        cut = int(rng.integers(len(words)))
        cut = words.find(" ", cut) if words.find(" ", cut) >= 0 else len(words)
        made.append((n, f"{words[:cut]} {data} {words[cut:]}"))
    return personal.fit(spark.createDataFrame(made, "doc_id bigint, text string")), made


def test_added_spans(tagger):
    model, made = tagger
    rng = np.random.default_rng(8)
    found, clean = 0, 0
    for _, text in made[:200]:
        kind, start, end = personal.base_spans(text)[0]
        other = personal.variant(kind, text[start:end], rng)
        changed = text[:start] + other + text[end:]
        base = personal.base_spans(changed)
        added = personal.added_spans(model, [changed], [base])[0]
        found += (kind, start, start + len(other)) in [*base, *added]
        clean += not personal.added_spans(model, [text], [personal.base_spans(text)])[0]
    assert found >= 180 and clean >= 195


def test_windows_are_reconciled_over_the_text(tagger):
    model, _ = tagger
    text = ("the there of Anble " * 40) + "hsr.29 @ mail5.example.com" + (" of the there" * 40)
    for shift in range(0, 400, 7):
        own = text[shift:]
        start = own.index("hsr")
        spans = personal.added_spans(model, [own], [[]])[0]
        assert spans == personal.added_spans(model, [own], [[]], gate=False)[0]
        assert spans in ([("email", start, start + 26)], []) and len(spans) <= 1
    covered = [k for s in personal.window_starts(1000) for k in range(s, min(1000, s + personal.WINDOW))]
    assert set(covered) == set(range(1000))


def test_personal_data_of_odd_texts(docs, tagger):
    model, _ = tagger
    found = personal.find(docs(ODD), model).collect()
    assert len(found) == len(ODD) and all(isinstance(r.spans, list) for r in found)
    text = "mail a.b@c.de or +1 (988) 555-2485, é 10.0.0.1"
    masked = personal.mask(docs([(1, text), *ODD]), model)
    assert masked.columns == docs(ODD).columns
    kept = {r.doc_id: r for r in masked.where("doc_id in (1, 2, 7)").collect() if r.text is not None}
    assert kept[1].text == "mail <email> or <phone>, é <ip>" and kept[1].n_chars == len(kept[1].text)
    assert kept[7].text == "word " * 30_000
    assert masked.where("text IS NULL").count() == 2
    assert personal.fit(docs([])) is None and personal.mask(docs([]), None).collect() == []
    assert personal.span_digests(docs(ODD), None).count() == len(ODD)
    assert personal.masked("0123456789", [("ip", 2, 5), ("card", 4, 8), ("ip", 8, 9)]) == "01<ip><ip>9"


def test_tagger_sample_is_of_lines(spark, monkeypatch):
    """Few lines in many documents all train; the bound is on lines, not on documents."""
    seen = []
    monkeypatch.setattr(personal, "SAMPLE_LINES", 50)
    windows = personal.training_windows
    monkeypatch.setattr(personal, "training_windows", lambda found: seen.extend(found) or windows([]))
    text = F.when(F.col("id") < 80, F.concat(F.lit("a line\nwrite to a"), F.col("id") % 40, F.lit("@b.cd"))).otherwise("none")
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert personal.fit(frame) is None
    assert sorted(seen) == sorted(f"write to a{n}@b.cd" for n in range(40))
    seen.clear()
    monkeypatch.setattr(personal, "SAMPLE_LINES", 15)
    assert personal.fit(frame) is None and len(set(seen)) == len(seen) == 15



# quality


def test_word_vectors_equal_a_plain_count(docs):
    table = [(1, "a b c a !! b"), (2, None), (3, ""), (4, "c c b"), (5, "x"), (6, "b a"), (6, "b a")]
    found = quality.word_vectors(docs(table), words=256, dimensions=8)
    index = quality.index_vectors(256, 8).astype(np.float64)
    plain = np.zeros((256, 8))
    for _, text in table:
        words = [zlib.crc32(w.encode()) % 256 for w in re.findall(r"\w+|[^\w\s]+", text or "")]
        for at, word in enumerate(words):
            for step in (-2, -1, 1, 2):
                if 0 <= at + step < len(words):
                    plain[word] += index[words[at + step]]
    length = np.linalg.norm(plain, axis=1, keepdims=True)
    assert np.allclose(found, plain / np.where(length > 0, length, 1), atol=1e-6)


def test_quality_on_held_out_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    scored = QUERIES["op6_quality"](spark, sf_dir)
    assert scored.count() == read_table(spark, sf_dir, "documents").count()
    for r in scored.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    judged = scored.join(read_table(spark, sf_dir, "labels"), "doc_id").where("held_out").collect()
    good = [r.score for r in judged if r.quality == 1]
    poor = [r.score for r in judged if r.quality == 0]
    ranked = np.mean([(a > b) + (a == b) / 2 for a in good for b in poor])
    assert ranked > 0.85
    assert np.mean([s >= 0.3 for s in good]) > 0.95


def test_quality_never_sees_held_out_labels(spark, docs):
    table = [(n, "good words here" if n % 2 else "bad*** junk###") for n in range(400)]
    labels = [(n, n % 2 if zlib.crc32(str(n).encode()) % 5 else 1 - n % 2) for n in range(400)]
    labels = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, quality int")
    frame = docs(table + ODD)
    model = quality.fit(frame, labels)
    scored = quality.score(frame, model)
    assert scored.columns[-1] == "score" and scored.count() == len(table) + len(ODD)
    found = scored.where("doc_id >= 10").collect()
    assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in found)
    assert 0 < model.network.temperature <= 20


def test_quality_sample_is_bounded_in_rows(spark, docs, monkeypatch):
    """One labelled key with many rows, of which a bounded number reaches the driver and the training."""
    table = [(7, f"good words and more of them {n}") for n in range(3000)] + [(8, "poor"), (9, "bad lines"), (11, "fine text")]
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 0), (11, 1)], "doc_id bigint, quality int")
    seen = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda x, y, calibration: seen.append(len(y)) or train(x, y, calibration))
    quality.fit(docs(table), labels, sample=200)
    assert seen == [200]
    quality.fit(docs(table[-4:]), labels, sample=200)
    assert seen == [200, 4]


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.fit(docs(ODD), none)
    assert {r.score for r in quality.score(docs(ODD), model).collect()} == {0.5}
    assert quality.score(docs([]), quality.fit(docs([]), none)).collect() == []


# multiset fingerprints


def plain_vector(text):
    dense, counted = [0] * 8, [0] * 64
    from hashlib import md5

    for paragraph in filter(None, text.split("\n")):
        digest = sha256(paragraph.encode()).hexdigest()
        dense = [(v + int(digest[8 * k : 8 * k + 8], 16)) % 2**32 for k, v in enumerate(dense)]
        for sentence in paragraph.split(". "):
            lane = int(md5(sentence.encode()).hexdigest()[:2], 16) % 64
            counted[lane] = (counted[lane] + 1) % 2**16
    return dense + counted


def as_hex(v):
    return "".join(f"{x:08x}" for x in v[:8]) + "".join(f"{x:04x}" for x in v[8:])


def test_fingerprints_of_edited_texts(docs, monkeypatch):
    monkeypatch.setattr(multiset, "ROWS_IN_RANGE", 5)
    rng = np.random.default_rng(9)
    lines = [f"Line {n}. With two sentences é{n}." for n in range(40)]
    table = [(int(n) * 3, "\n".join(rng.choice(lines, rng.integers(0, 9)))) for n in rng.permutation(60)]
    table += [(1, None), (2, ""), (4, "same"), (4, "same"), (4, "other"), (7, "😀" * 100), (None, "last"), (None, None)]
    found = multiset.with_edited(docs(table)).collect()
    order = sorted(table, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1] or ""))
    expected = []
    for n, (key, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, changed, other = (plain_vector(t) for t in (text, edited, after))
        near = []
        for v in (changed, other):
            spread = np.std(own[8:]) * np.std(v[8:])
            near.append(1.0 if v == own else max(0.0, np.corrcoef(own[8:], v[8:])[0, 1]) if spread else 0.0)
        expected.append((key, len(text), sha256(edited.encode()).hexdigest(), as_hex(own), as_hex(changed), *near))
    assert len(found) == len(expected)
    by = lambda r: (r[0] is not None, *(str(x) for x in r[:5]))
    for one, two in zip(sorted(map(tuple, found), key=by), sorted(expected, key=by), strict=True):
        assert one[:5] == two[:5]
        assert one[5:] == pytest.approx(two[5:], abs=1e-9)
    assert multiset.with_edited(docs([])).collect() == []


def test_fingerprints_add_and_subtract(docs):
    frame = docs([(1, "a\nb"), (2, "b\n\na\n"), (3, "c"), (4, "c\na\nb")])
    v = {r.doc_id: r.v for r in frame.select("doc_id", multiset.vector(multiset.paragraphs(F.col("text"))).alias("v")).collect()}
    assert v[1] == v[2] != v[4]
    row = frame.sparkSession.createDataFrame([(v[1], v[3], v[4])], "a array<bigint>, c array<bigint>, all array<bigint>")
    found = row.select(
        multiset.add(F.col("a"), F.col("c")).alias("sum"), multiset.subtract(F.col("all"), F.col("a")).alias("rest")
    ).first()
    assert found["sum"] == v[4] and found.rest == v[3]
    marked = multiset.fingerprint(docs(ODD), out="score")
    assert marked.where("text IS NULL OR text = ''").select("score").distinct().count() == 1


def test_pipeline_keeps_the_columns(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents").withColumn("score", F.lit("mine")).withColumn("_key", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, sf_dir).schema.names == documents.schema.names, name


def plain_edited(table):
    order = sorted(table, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1] or ""))
    expected = []
    for n, (key, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, changed, other = (plain_vector(t) for t in (text, edited, after))
        near = []
        for v in (changed, other):
            spread = np.std(own[8:]) * np.std(v[8:])
            near.append(1.0 if v == own else max(0.0, np.corrcoef(own[8:], v[8:])[0, 1]) if spread else 0.0)
        expected.append((key, len(text), sha256(edited.encode()).hexdigest(), as_hex(own), as_hex(changed), *near))
    return expected


def same_rows(found, expected):
    assert len(found) == len(expected)
    by = lambda r: (r[0] is not None, *(str(x) for x in r[:5]), round(r[6], 6))
    for one, two in zip(sorted(map(tuple, found), key=by), sorted(expected, key=by), strict=True):
        assert one[:5] == two[:5]
        assert one[5:] == pytest.approx(two[5:], abs=1e-9)


def test_fingerprints_of_hot_keys(docs, monkeypatch):
    monkeypatch.setattr(multiset, "ROWS_IN_RANGE", 50)
    monkeypatch.setattr(multiset, "BLOCK", 7)
    hot = [(500, f"Hot {n}.\nOf many {n % 7}.") for n in range(400)] + [(500, "Copy.\nSame text.")] * 300
    none = [(None, f"None {n}") for n in range(250)] + [(None, None)] * 20
    table = hot + none + [(n, f"Line {n}.\nMore {n % 5}.") for n in range(1000) if n != 500]
    rows = docs(table).select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    dealt, large, _ = multiset._dealt(rows)
    sizes = {r.range: r.n for r in dealt.groupBy("range").agg(F.count("*").alias("n")).collect()}
    assert sorted(sizes[r] for r in large) == [270, 700]
    assert max(n for r, n in sizes.items() if r not in large) <= 4 * 50
    same_rows(multiset.with_edited(docs(table)).collect(), plain_edited(table))
    only = multiset.with_edited(docs([(None, "same")] * 500)).collect()
    assert len(only) == 500 and len({tuple(r) for r in only}) == 1 and only[0].near_next == 1.0
