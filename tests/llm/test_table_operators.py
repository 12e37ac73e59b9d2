"""Operators that compare rows or write files: against brute force and round trips."""

import base64
import re
from collections import Counter
from hashlib import sha1, sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import rows
from llm.conftest import ODD
from millrace.llm import lines, packing, simhash, topk, warc
from millrace.llm.common import file_system, read_table
from millrace.llm.components import components
from millrace.llm.queries import QUERIES, vocabulary


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# components


@pytest.mark.parametrize("hub_links", [100_000, 5])
def test_components(spark, hub_links):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))]
    links += [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5050)] + [(7, 7)]
    found = components(spark.createDataFrame([*links, *links[:5]], "a bigint, b bigint"), hub_links).collect()
    nodes = {n for a, b in links for n in (a, b) if a != b}
    assert {r.node: r.component for r in found} == smallest_reachable(nodes, [x for x in links if x[0] != x[1]])
    assert len(found) == len(nodes)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# SimHash


def plain_fingerprint(text):
    from xxhash import xxh64

    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(table):
    prints = [(key, plain_fingerprint(text)) for key, text in table]
    links = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a][1] ^ prints[b][1]).bit_count() <= 3]
    group = smallest_reachable(range(len(prints)), links)
    least = {}
    for n, (key, _) in enumerate(prints):
        if key is not None:
            least[group[n]] = min(key, least.get(group[n], key))
    return [(key, f"{fp:016x}", least.get(group[n])) for n, (key, fp) in enumerate(prints)]


def by_text(found):
    return sorted(map(str, map(tuple, found)))


def test_simhash_equals_brute_force(spark, sf_dir):
    table = [tuple(r) for r in read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op5_simhash"](spark, sf_dir).collect()
    assert by_text(found) == by_text(plain_components(table))


def test_simhash_of_odd_texts(docs):
    table = ODD + [(20 + n, "A near copy of one long enough text " * 8 + f"w{n % 7}") for n in range(30)]
    table += [(99, "two words"), (98, "Two\x0bWORDS"), (97, "É É É É")]
    assert by_text(simhash.near_duplicates(docs(table)).collect()) == by_text(plain_components(table))
    assert simhash.near_duplicates(docs([])).collect() == []


@pytest.mark.parametrize("tile, side", [(40, 256), (40, 3), (1000, 256)])
def test_simhash_tiles_equal_all_pairs(spark, monkeypatch, tile, side):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [int(v) ^ (1 << int(a)) ^ (1 << int(b)) for v in base for a, b in rng.integers(0, 64, (5, 2))]
    values = sorted({int(v) for v in base} | set(near))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), tile=tile, side=side).collect()
    assert all(((a ^ b) & (2**64 - 1)) and a != b for a, b in links)
    plain = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert smallest_reachable(signed, [tuple(x) for x in links]) == smallest_reachable(signed, plain)


def test_simhash_forest_of_a_large_group():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 500, (2, 3000))
    x, y = simhash._forest(a, b)
    nodes = sorted({*a.tolist(), *b.tolist()})
    whole = smallest_reachable(nodes, zip(a.tolist(), b.tolist(), strict=True))
    assert smallest_reachable(nodes, zip(x.tolist(), y.tolist(), strict=True)) == whole and len(x) < len(nodes)


def test_simhash_keeps_one(docs):
    copies = [(30 + n, "Copies of one text that is the same in all of them") for n in range(20)]
    table = ODD + copies + [(30, "A text of its own under a key that is there twice, the smaller of them")]
    kept = simhash.keep_one(docs(table))
    assert kept.columns == docs([]).columns
    found = kept.collect()
    # Key 30 stands for the copies, and once more for the text that is near nothing.
    expected = [key for key, _, least in dict.fromkeys(plain_components(table)) if key is not None and key == least]
    assert expected.count(30) == 2
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted(expected)
    assert sum(r.doc_id is None for r in found) == 2
    assert simhash.keep_one(docs([])).collect() == []


def test_simhash_keeps_one_of_each_component(docs):
    """A repeated key loses neither a row that is near nothing nor the only row that stands for a group."""
    copies = [(30 + n, "Copies of one text that is the same in all of them") for n in range(20)]
    alone = [(30, "A text of its own under a key that is there twice, the smaller of them")]
    alone += [(35, f"{word} a clean text number {n} that stands {word * 3} for itself") for n, word in enumerate(["fir", "oak", "elm"])]
    found = simhash.keep_one(docs([*copies, copies[0], *alone])).collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted([copies[0], *alone])
    near = [(7, "A near copy of one long enough text " * 30 + f"w{n}") for n in range(9)] + [(7, None), (7, ""), (6, " ")]
    prints = [plain_fingerprint(text) for _, text in near]
    links = [(a, b) for a in range(len(near)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    elected = {}
    for n, group in smallest_reachable(range(len(near)), links).items():
        place = near[n][0], near[n][1] is not None, near[n][1] or ""
        elected[group] = min(place, elected.get(group, place))
    found = simhash.keep_one(docs(near)).collect()
    assert len(elected) < len(near) - 2
    assert sorted((r.doc_id, r.text is not None, r.text or "") for r in found) == sorted(elected.values())


# line dedup


def distance(a, b):
    last = list(range(len(b) + 1))
    for row, x in enumerate(a, 1):
        new = [row]
        for n, y in enumerate(b, 1):
            new.append(min(last[n] + 1, new[-1] + 1, last[n - 1] + (x != y)))
        last = new
    return last[-1]


def edited(rng, text, edits, signs):
    out = list(text)
    for _ in range(edits):
        at, kind = int(rng.integers(len(out) + 1)), int(rng.integers(3))
        if kind == 0:
            out.insert(at, rng.choice(signs))
        elif out and kind == 1:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(signs)
    return "".join(out)


def test_edit_distance_and_keys():
    rng = np.random.default_rng(4)
    for n in range(6000):
        signs = list("ab" if n % 2 else "abcdé fgh")
        a = "".join(rng.choice(signs, rng.integers(3, 40)))
        b = edited(rng, a, int(rng.integers(0, 5)), signs)
        far = distance(a, b)
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        for threshold in (1, 2, 3):
            assert lines.within(a, b, threshold) == (far <= threshold)
            if far <= threshold < len(short):
                assert lines.first_shared(short, long, threshold) >= 0
                ladder = ((threshold + 1, threshold),)
                index = {k for k, _ in lines.keys_of(short, ladder)[0]}
                assert index & {k for k, _ in lines.keys_of(long, ladder)[1]}
        if 0 < far <= allowed(short):
            index = {k for k, _ in lines.keys_of(short)[0]}
            assert index & {k for k, _ in lines.keys_of(long)[1]}


def allowed(line):
    """Edits that link a line with one that is no shorter."""
    return 0 if len(line) < 13 else 1 if len(line) < 24 else 2


def linked(a, b):
    most = allowed(min(a, b, key=len))
    return a != b and abs(len(a) - len(b)) <= most and distance(a, b) <= most


def plain_dedup(table):
    """Text left, and the report, by comparing every line with every other one and closing all links."""
    unique = sorted({(k is not None, k, t or "") for k, t in table}, key=lambda r: (r[0], r[1] or 0))
    seen = []  # occurrences in order
    for _, key, text in unique:
        seen += [((key is not None, key, text, p), line) for p, line in enumerate(text.split("\n")) if line.strip(" ")]
    order = {place: n for n, (place, _) in enumerate(seen)}
    first = {}
    for place, line in seen:
        first.setdefault(line, place)
    near = {a: {b for b in first if linked(a, b)} for a in first}
    group = smallest_reachable(order.values(), [(order[first[a]], order[first[b]]) for a in near for b in near[a]])
    source = {line: seen[group[order[place]]][0] for line, place in first.items()}
    document = {row: n for n, row in enumerate(unique)}
    classes = smallest_reachable(
        document.values(), [(document[place[:3]], document[source[line][:3]]) for place, line in seen]
    )
    out = {}
    for _, key, text in unique:
        left, sources, links, n_lines, removed = [], set(), 0, 0, 0
        for p, line in enumerate(text.split("\n")):
            place = (key is not None, key, text, p)
            if not line.strip(" "):
                left.append(line)
                continue
            n_lines += 1
            links += len(near[line])
            if first[line] == place and all(order[first[x]] > order[place] for x in near[line]):
                left.append(line)
            else:
                removed += 1
                sources.add(source[line][1])
        least = unique[classes[document[key is not None, key, text]]][1]
        out[key, text] = ("\n".join(left), n_lines, removed, links, least, sorted(s for s in sources if s is not None))
    return out


@pytest.fixture
def line_table():
    rng = np.random.default_rng(5)
    signs = list("abcde fghé")
    base = ["".join(rng.choice(signs, rng.integers(5, 60))) for _ in range(40)]
    table = []
    for key in range(80):
        own = [edited(rng, base[int(rng.integers(40))], int(rng.integers(0, 4)), signs) for _ in range(rng.integers(0, 6))]
        table.append((key, "\n".join([*own, ""] if key % 3 else own)))
    return [*table, (200, table[5][1]), (201, table[5][1]), (202, table[6][1]), (202, table[6][1])]


@pytest.mark.parametrize("tile", [512, 2])
def test_line_dedup_equals_brute_force(docs, line_table, monkeypatch, tile):
    classes = lines.line_classes
    monkeypatch.setattr(lines, "line_classes", lambda d, t: classes(d, t, tile))
    expected = plain_dedup(line_table)
    found = lines.dedup_lines(docs(line_table)).collect()
    assert len(found) == len(line_table)
    texts = {}
    for key, text in line_table:
        texts.setdefault(key, text)
    assert any(e[3] for e in expected.values()) and any(e[2] for e in expected.values())
    for row in found:
        assert (row.text, *row.line_report) == expected[row.doc_id, texts[row.doc_id]]


def test_line_dedup_of_odd_texts(docs):
    near = "One line of text, long enough to count."
    table = [*ODD, (300, near.replace("text", "test")), (301, near + "\n" + near.replace("text", "tent") + "\nshort\nshort")]
    expected = plain_dedup(table)
    frame = lines.dedup_lines(docs(table), report="score")
    assert frame.columns == [c for c in docs([]).columns if c != "score"] + ["score"]
    left = {(r.doc_id, r.n_chars): r for r in frame.collect()}
    for key, text in table:
        row = left[key, len(text or "")]
        assert (row.text or "", *row.score) == expected[key, text or ""]
        assert (row.text is None) == (text is None)
    assert lines.dedup_lines(docs([])).collect() == []


def test_line_dedup_joins_short_lines(docs):
    """Variants of a line link from 13 code points on; shorter lines are near a copy of themselves only."""
    near = ["The anhely eran.", "The, anhely eran.", "Heti eror anesti.", "Heti, eror anesti.", "x" * 24, "x" * 23]
    apart = ["Of.", "Ti.", "Le.", "As.", "With.", "Anth.", "abc", "ac", "abcd", "ac", "y" * 12, "y" * 13, "z" * 23, "z" * 25]
    found = {r.doc_id: r for r in lines.dedup_lines(docs(list(enumerate([*near, *apart])))).collect()}
    assert [found[n].line_report.n_links for n in range(20)] == [1] * 6 + [0] * 14
    assert [n for n in range(20) if found[n].line_report.n_removed] == [1, 3, 5, 15]
    rng = np.random.default_rng(9)
    table = [(n, "\n".join("".join(rng.choice(list("ab"), rng.integers(10, 18))) for _ in range(4))) for n in range(40)]
    expected = plain_dedup(table)
    assert any(e[3] for e in expected.values())
    for row in lines.dedup_lines(docs(table)).collect():
        assert (row.text, *row.line_report) == expected[row.doc_id, table[row.doc_id][1]]


def test_line_dedup_refuses_a_ladder_without_segments(docs):
    for ladder in ((), ((2, 2),), ((24, 2), (13, 1))):
        with pytest.raises(ValueError):
            lines.dedup_lines(docs([]), ladder=ladder)


@pytest.mark.parametrize("at_once", [1 << 20, 40])
def test_lines_that_meet(at_once):
    """Lines that share a key, however the rows are dealt to tasks and batches; few rows of a frequent key."""
    rng = np.random.default_rng(12)
    held = [" ".join(rng.choice(["aaaaaaaa", "bbbbbbbb", "cccccccc", "dddddddd"], 3)) + "xyz"[n % 3] for n in range(90)]
    held += ["".join(rng.choice(list("abcdefgh"), 30)) for _ in range(60)]
    marks = {line: k + 1 for k, line in enumerate(dict.fromkeys(held))}
    rows = [(key, marks[line], kind) for line in marks for kind, found in enumerate(lines.keys_of(line)) for key, _ in found]
    rows = [(key, h, kind) for key, h, kind in rows if not kind or (key, h, 0) not in set(rows)]
    under = {}
    for key, h, kind in rows:
        under.setdefault(key, []).append((h, kind))
    expected = {
        h for met in under.values() for h, kind in met if any(g != h and 0 in (kind, role) for g, role in met)
    }
    assert 10 < len(expected) < len(marks)
    dealt = [lines.thinned(*zip(*rows[k : k + at_once], strict=True)) for k in range(0, len(rows), at_once)]
    whole = sorted((r for batch in dealt for r in zip(*batch.to_pydict().values(), strict=True)), key=lambda r: (r[0], r[2]))
    if at_once > len(rows):
        left = Counter(key for key, _, kind in whole if kind != lines.MET)
        shared = {key for key, met in under.items() if len({h for h, _ in met}) > 1 and any(k == 0 for _, k in met)}
        assert max(len(under[key]) for key in shared) > 10
        assert max(left[int(np.uint64(key).view(np.int64))] for key in shared) == 2
    for size in (3, 10_000):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*whole[k : k + size], strict=True), (pa.int64(), pa.int64(), pa.int8()), strict=True)],
                ["key", "h", "kind"],
            )
            for k in range(0, len(whole), size)
        ]
        assert {h for batch in lines.lines_that_meet(batches) for h in batch.column(0).to_pylist()} == expected


@pytest.mark.parametrize("tile", [512, 2])
def test_line_dedup_classes_are_closed(docs, monkeypatch, tile):
    classes = lines.line_classes
    monkeypatch.setattr(lines, "line_classes", lambda d, t: classes(d, t, tile))
    line = "One line of text, long enough to count."
    chain = [(n, "#" * 2 * n + line[2 * n :] + f"\nalone {n} {'xyz'[n] * 9}") for n in range(3)]
    chain += [(9, "alone 2 " + "z" * 9 + "\nand an end that nothing else has"), (10, "and an end that nothing else has")]
    found = {r.doc_id: r.line_report for r in lines.dedup_lines(docs(chain)).collect()}
    assert {k: r.class_id for k, r in found.items()} == dict.fromkeys(found, 0)
    assert [found[k].sources for k in (0, 1, 2, 9, 10)] == [[], [0], [0], [2], [9]]
    rng = np.random.default_rng(10)
    base = ["".join(rng.choice(list("abcdefghij é"), rng.integers(12, 40))) for _ in range(60)]
    table = []
    for key in range(60):
        own = [edited(rng, base[int(rng.integers(60))], int(rng.integers(0, 4)), list("abcdef")) for _ in range(key % 3)]
        table.append((key, "\n".join(own)))
    expected = plain_dedup(table)
    assert 2 < len({e[4] for e in expected.values()}) < 50
    for row in lines.dedup_lines(docs(table)).collect():
        assert (row.text, *row.line_report) == expected[row.doc_id, table[row.doc_id][1]]


def test_line_dedup_query(spark, sf_dir):
    table = [tuple(r) for r in read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op9_line_dedup"](spark, sf_dir).collect()
    seen, exact = set(), {}
    for key, text in sorted(table):
        left = []
        for line in (text or "").split("\n"):
            if not line.strip(" ") or line not in seen:
                left.append(line)
            seen.add(line)
        exact[key] = left
    assert sorted(r.doc_id for r in found) == sorted(exact)
    for r in found:  # near lines go besides the equal ones
        assert r.n_links or r.text_sha256 == sha256("\n".join(exact[r.doc_id]).encode()).hexdigest()


# top-k


def plain_top(table, top=5, every=50):
    size = max((len(v) for _, v in table), default=0)
    whole = [(k, [int(np.floor(256 * float(x))) for x in v] + [0] * (size - len(v))) for k, v in table]
    out = []
    for row, (query, q) in enumerate(whole):
        if query % every == 0:
            others = [x for n, x in enumerate(whole) if n != row]
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), k) for k, v in others)
            out += [(query, n + 1, k, -s) for n, (s, k) in enumerate(scores[:top])]
    return sorted(out)


@pytest.mark.parametrize("tile", [8192, 7])
def test_top_k_equals_brute_force(spark, tile):
    rng = np.random.default_rng(6)
    table = [(int(k), rng.normal(0, rng.choice([0.2, 3]), 6).astype(np.float32).tolist()) for k in rng.permutation(400)]
    table += [(1000 + k, table[0][1]) for k in range(60)]  # ties
    table += [(2000, [0.0] * 6), (2001, []), (2050, [1.5]), (2100, [100000.0] * 6)]
    table += [table[3]] + [(50, table[n][1]) for n in range(5, 9)] + [(50, table[5][1])] * 3  # repeated ids and rows
    table += [(2150, [1e8, 0.0]), (2151, [0.0, -(2.0**43)]), (2152, [0.0, 0.0, 0.0, 3e7])]  # beyond 2**31 when scaled
    junk = [(None, [1.0] * 6), (3000, None), (3050, [float("nan")] * 6), (3100, [1.0, None]), (3150, [float("inf")])]
    frame = spark.createDataFrame(
        [(k, v, "x", 1) for k, v in [*table, *junk]], "vec_id bigint, embedding array<float>, rank string, score int"
    ).repartition(3)
    assert rows(topk.search(frame, tile=tile), "query_id", "rank", "vec_id", "score") == plain_top(table)


def test_products_are_exact_or_refused():
    one = np.array([[2.0**40, 3.0], [-(2.0**33), 2.0**29]])
    expected = [[2**80 + 9, -(2**73) + 3 * 2**29], [-(2**73) + 3 * 2**29, 2**66 + 2**58]]
    assert topk.products(one, one).tolist() == expected
    small = np.array([[2.0**22, 5.0], [0.0, 2.0**30]])
    assert topk.products(one, small).tolist() == [[2**62 + 15, 3 * 2**30], [-(2**55) + 5 * 2**29, 2**59]]
    rows_, ids = np.arange(3), np.array([7, 5, 5])
    assert [x.tolist() for x in topk.best_of(rows_, ids, np.array([4, 4, 9]), 2, 2)] == [[5, 7], [4, 4]]
    assert [x.tolist() for x in topk.best_of(rows_, ids, np.array([4, 4, 1 << 70], object), 2, 5)] == [[5, 7], [4, 4]]
    with pytest.raises(OverflowError):
        topk.best_of(rows_, ids, np.array([4, 4, 1 << 70], object), 0, 5)
    with pytest.raises(OverflowError):
        topk.products(np.array([[np.inf]]), np.array([[1.0]]))


def test_vectors_whose_squares_overflow(spark):
    table = [(0, [1e200, 0.0]), (1, [0.0, 3.0]), (2, [0.0, -2.0]), (50, [0.0, 1.0])]
    found = topk.search(spark.createDataFrame(table, "vec_id int, embedding array<double>"))
    assert rows(found) == plain_top(table)
    with pytest.raises(Exception, match="no long"):
        topk.search(spark.createDataFrame([*table, (3, [1e200, 0.0])], "vec_id int, embedding array<double>"))


def test_top_k_of_few_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert topk.search(spark.createDataFrame([], schema)).collect() == []
    assert topk.search(spark.createDataFrame([(0, [1.0])], schema)).collect() == []
    assert topk.search(spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)).collect() == []
    found = topk.search(spark.createDataFrame([(0, [0.0]), (1, [0.0])], schema))
    assert rows(found) == [(0, 1, 1, 0)]


# WARC


def plain_records(table):
    first = {}
    for key, _, html in table:
        if key is not None:
            first[html or ""] = min(key, first.get(html or "", key))
    out = []
    for key, _, html in table:
        payload, other = (html or "").encode(), first.get(html or "")
        kind = "response" if other is None or other == key else "revisit"
        digest = base64.b32encode(sha1(payload).digest()).decode()
        out.append((key, len(payload), digest, kind, other if kind == "revisit" else None))
    return out


@pytest.mark.parametrize("count", [3, 60])
def test_warc_round_trip(spark, count):
    html = [f"<html><p>Page {n} é</p>\r\n\r\n" + "<div>common parts of pages</div>" * (n % 5) + "</html>" for n in range(count)]
    table = [(n, f"http://a.b/{n}\r\nX: é", html[n % 40]) for n in range(count)]
    table += [(500, None, None), (501, "u", ""), (501, "u", ""), (None, "u", html[0]), (None, None, "alone"), (502, "u", "x" * 500_000)]
    frame = spark.createDataFrame([(*r, "mine") for r in table], "page_id bigint, url string, html string, digest string")
    folder, names = warc.write_archives(frame.repartition(2))
    found = warc.read_archives(spark, folder, names, payloads=True).collect()
    assert by_text([r[:5] for r in found]) == by_text(plain_records(table))
    whole = {r.payload_digest: r.payload for r in found if r.record_type == "response"}
    for r in found:
        assert digest_of(whole[r.payload_digest]) == r.payload_digest
        assert r.url is None or "\n" not in r.url
    folder, names = warc.write_archives(frame.where("page_id < 0"))
    assert warc.read_archives(spark, folder, names).collect() == []
    folder, names = warc.write_archives(frame, least_bytes=1 << 30)
    assert warc.read_archives(spark, folder, names).where("record_type <> 'response'").count() == 0


def digest_of(payload):
    return base64.b32encode(sha1(payload).digest()).decode()


def test_warc_layout(spark):
    import struct

    import zstandard

    pages = spark.createDataFrame([(n, "http://a.b", f"<p>{n}</p>" * 20) for n in range(40)], "page_id bigint, url string, html string")
    folder, names = warc.write_archives(pages.coalesce(1))
    files, root = file_system(folder)
    raw = files.open_input_stream(f"{root}/{names[0]}", compression=None).read()
    frame, size = struct.unpack("<II", raw[:8])
    assert frame == 0x184D2A5D
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size]))
    rest, records = raw[8 + size :], []
    while rest:
        one = unpack.decompressobj()
        records.append(one.decompress(rest))
        rest = one.unused_data
    assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    assert len(records) == sum(warc.read_archives(spark, folder, [n]).count() for n in names[:1])


# packing


def padding(bounds, sizes):
    return sum(min(b for b in bounds if b >= s) - s for s in sizes)


def test_buckets_are_optimal():
    from itertools import combinations

    rng = np.random.default_rng(7)
    for _ in range(60):
        sizes = rng.integers(0, 60, rng.integers(1, 30))
        values, counts = np.unique(sizes, return_counts=True)
        for buckets in (1, 2, 3, 4):
            bounds = packing.boundaries(values, counts, buckets)
            k = min(buckets, len(values))
            choices = [(*c, values[-1]) for n in range(k) for c in combinations(values[:-1], n)]
            assert len(bounds) <= buckets and bounds[-1] == values[-1]
            assert padding(bounds, sizes) == min(padding(c, sizes) for c in choices)
    assert packing.boundaries(np.zeros(0, np.int64), np.zeros(0, np.int64), 4) == []


def check_batches(found, budget):
    batches = {}
    for r in found:
        batches.setdefault(r.batch, []).append(r)
    for members in batches.values():
        assert len({(r.bucket, r.padded) for r in members}) == 1
        assert sorted(r.place for r in members) == list(range(len(members)))
        assert len(members) == 1 or len(members) * members[0].padded <= budget
        assert all((r.n_tokens or 0) <= r.padded for r in members)
    return batches


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    rng = np.random.default_rng(8)
    sizes = [int(x) for x in rng.geometric(0.01, 600)] + [0, 0, 5000]
    table = [(k, n, "mine", 7) for k, n in enumerate(sizes)] + [(None, None, None, None), (None, 4, "x", 0), (1, sizes[1], "mine", 7)]
    frame = spark.createDataFrame(table, "doc_id bigint, n_tokens bigint, batch string, _row int").repartition(3)
    found = packing.pack(frame, buckets=6, budget=2048).collect()
    assert len(found) == len(table) and "_row" in found[0].asDict()
    batches = check_batches(found, 2048)
    groups = len({b.rsplit("-", 1)[0] for b in batches})
    short = [m for m in batches.values() if (len(m) + 1) * m[0].padded <= 2048]
    assert len(short) <= groups
    rounded = [-(-(n or 0) // 8) * 8 for _, n, _, _ in table]
    values, counts = np.unique(rounded, return_counts=True)
    assert {r.padded for r in found} == set(packing.boundaries(values, counts, 6))
    plan = packing.plan(frame, buckets=6)
    assert plan.padding == sum(r.padded - (r.n_tokens or 0) for r in found)
    assert packing.pack(frame.where("doc_id < 0")).collect() == []


def test_equal_rows_are_packed_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    frame = spark.createDataFrame([(None, 9, "same")] * 3000 + [(7, 9, "same")] * 2000, "doc_id bigint, n_tokens int, mark string")
    found = packing.pack(frame, budget=160).collect()
    check_batches(found, 160)
    groups = Counter(r.batch.rsplit("-", 1)[0] for r in found)
    assert len(found) == 5000 and max(groups.values()) <= 100 and {r.mark for r in found} == {"same"}


def test_packing_query(spark, sf_dir):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in read_table(spark, sf_dir, "documents").collect()}
    found = QUERIES["op10_packing"](spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {
        k: len(made.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in texts.items()
    }
    check_batches(found, packing.BUDGET)


# pipeline


def test_pipeline(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    table = {r.doc_id: r.text for r in docs.collect()}
    good = corpus_pipeline.keep_good(spark, docs, sf_dir)
    judged = good.join(read_table(spark, sf_dir, "labels"), "doc_id", "right").collect()
    wanted = [r for r in judged if r.quality == 1]
    assert sum(r.text is not None for r in wanted) >= 0.97 * len(wanted)
    left = {r.doc_id: r for r in corpus_pipeline.drop_lines(spark, docs, sf_dir).collect()}
    assert left.keys() == table.keys()
    assert all(r.n_chars == len(r.text or "") for r in left.values())
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()
    expected = {k for k, _, least in plain_components(list(table.items())) if k == least}
    assert sorted(r.doc_id for r in kept) == sorted(expected)
    assert all(r.text == table[r.doc_id] for r in kept)
    masked = corpus_pipeline.mask_personal_data(spark, docs, sf_dir).collect()
    from millrace.llm.personal import base_spans

    assert all(not base_spans(r.text or "") and r.n_chars == len(r.text or "") for r in masked)
    assert sum(r.text != table[r.doc_id] for r in masked) == sum(bool(base_spans(t or "")) for t in table.values())
    packed = QUERIES["pipeline"](spark, sf_dir).collect()
    check_batches(packed, packing.BUDGET)
    assert {r.doc_id for r in packed} <= table.keys() and len({r.doc_id for r in packed}) == len(packed)


def test_pipeline_of_odd_documents(spark, docs, sf_dir):
    frame = docs(ODD).withColumn("n_tokens", F.lit("mine")).withColumn("k", F.lit(1))
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf_dir)
    assert frame.count() > 0
    frame = docs([])
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf_dir)
    assert frame.collect() == []
