"""Encoding and decoding with a SentencePiece vocabulary of merge type (BPE with byte fallback).

A text is cut into segments that no piece of the vocabulary reaches across. Each distinct segment is
encoded once per task by an agenda of adjacent symbol pairs, best score first and leftmost among equals,
from which pairs are merged until none is left: short segments together, in arrays with a row of pair
scores for each, long ones by a heap. The segments that are new in an Arrow batch are checked against
the sentencepiece library before their ids are used.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import (
    ASCII_LETTERS,
    ASCII_SIGNS,
    chunks,
    claim,
    column,
    cut_segments,
    cuts_between,
    put_together,
)

SPACE = "▁"
# Distinct segments remembered in a generation. A full generation becomes the old one, from which
# segments still in use come back, and the one before it is forgotten. Results do not depend on it.
REMEMBERED = 300_000
# Longer segments are encoded without being remembered.
LONGEST_REMEMBERED = 64
# Up to so many symbols, scanning a list of pair scores beats a heap of them.
SHORT = 32
NEVER = float("-inf")
# Segments of up to so many symbols are merged together, at most so many at a time.
WIDTHS, TOGETHER = (4, 7, 10, 14, 20, SHORT), 1 << 16
# The rank of a pair that is no piece.
NO_RANK = np.iinfo(np.int32).max
# Characters that are cut at a time.
CUT_CHARS = 1 << 21


class PieceCodec:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = model_pb2.ModelProto.SentencePiece
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != model_pb2.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("only merge-type vocabularies with byte fallback are supported")
        if (
            rules.precompiled_charsmap
            or rules.remove_extra_whitespaces
            or not (rules.add_dummy_prefix and rules.escape_whitespaces)
            or model.trainer_spec.treat_whitespace_as_suffix
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
        ):
            raise ValueError("the model normalizes text in a way that is not supported")
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.texts: list[str | bytes] = []
        self.byte_ids = [0] * 256
        for number, piece in enumerate(model.pieces):
            self.texts.append("")
            if piece.type == kinds.NORMAL:
                self.ids[piece.piece] = number
                self.scores[piece.piece] = piece.score
                self.texts[number] = piece.piece
            elif piece.type == kinds.BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_ids[value] = number
                self.texts[number] = bytes([value])
            elif piece.type == kinds.UNKNOWN:
                self.texts[number] = " ⁇ "  # the library's surface of the unknown piece
        self.decimals = [f"{number},".encode() for number in range(len(self.texts))]
        self.is_byte = np.array([isinstance(t, bytes) for t in self.texts])
        self.utf8 = [t if isinstance(t, bytes) else t.replace(SPACE, " ").encode() for t in self.texts]
        self.surfaces = [t.replace(SPACE, " ") if isinstance(t, str) else None for t in self.texts]
        joined = [p for p in self.ids if re.search(f"[^{SPACE}]{SPACE}", p)]
        lines = [p for p in self.ids if "\n" in p and len(p) > 1]
        # No piece reaches from another character to a space, or across a line end, so cut there.
        self.cuts = not joined and not lines and "\n" not in self.ids
        self.segment = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        # Nor does one reach from a letter to most signs.
        joined = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isascii() and a.isalpha()}
        signs = bytes(b for b in ASCII_SIGNS if chr(b) not in joined)
        every = bytes(range(256))
        words = bytes(b for b in every if b not in b" ")
        self.marks = cuts_between((words, b" \n"), (b"\n", every), (ASCII_LETTERS, signs))
        self.agenda = _Agenda(self.ids, self.scores)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        return self.segment.findall(text) if self.cuts else [text]

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment by the agenda of adjacent symbol pairs."""
        ids = self.ids
        if segment in ids and len(segment) == 1:
            return [ids[segment]]
        symbols: list[str] = list(segment)
        if len(symbols) <= SHORT:
            self._merge_short(symbols)
        else:
            self._merge_long(symbols)
        found: list[int] = []
        for symbol in symbols:
            number = ids.get(symbol)
            if number is not None:
                found.append(number)
            elif symbol:
                found.extend([self.byte_ids[b] for b in symbol.encode()])
        return found

    def _merge_short(self, symbols: list[str]) -> None:
        """The agenda as a plain list of pair scores, which is quicker for a few symbols."""
        score = self.scores.get
        agenda = [score(a + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := max(agenda)) != NEVER:
            left = agenda.index(best)
            symbols[left] += symbols.pop(left + 1)
            del agenda[left]
            if left < len(agenda):
                agenda[left] = score(symbols[left] + symbols[left + 1], NEVER)
            if left:
                agenda[left - 1] = score(symbols[left - 1] + symbols[left], NEVER)

    def _merge_long(self, symbols: list[str]) -> None:
        """The agenda as a heap; symbols that went into their left neighbour become empty."""
        scores = self.scores
        count = len(symbols)
        after = list(range(1, count + 1))
        before = list(range(-1, count - 1))
        agenda = []
        for left in range(count - 1):
            score = scores.get(symbols[left] + symbols[left + 1])
            if score is not None:
                agenda.append((-score, left, symbols[left], symbols[left + 1]))
        heapq.heapify(agenda)
        while agenda:
            _, left, first, second = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] != first or right >= count or symbols[right] != second:
                continue  # one of the two has been merged with another symbol since
            merged = symbols[left] = first + second
            symbols[right] = ""
            follower = after[left] = after[right]
            if follower < count:
                before[follower] = left
                score = scores.get(merged + symbols[follower])
                if score is not None:
                    heapq.heappush(agenda, (-score, left, merged, symbols[follower]))
            leader = before[left]
            if leader >= 0:
                score = scores.get(symbols[leader] + merged)
                if score is not None:
                    heapq.heappush(agenda, (-score, leader, symbols[leader], merged))
    def surface(self, ids: Iterable[int]) -> str:
        """Text of ids, the space in front of the whole included."""
        ids = list(ids)
        try:
            return "".join([self.surfaces[number] for number in ids])
        except TypeError:  # there are byte pieces, which make up characters together
            pass
        out: list[str] = []
        pending = b""
        for number in ids:
            text = self.texts[number]
            if isinstance(text, bytes):
                pending += text
                continue
            if pending:
                out.append(_utf8(pending))
                pending = b""
            out.append(text.replace(SPACE, " "))
        if pending:
            out.append(_utf8(pending))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        return [number for segment in self.segments(text) for number in self.merge(segment)]

    def decode(self, ids: Iterable[int]) -> str:
        return self.surface(ids).removeprefix(" ")

    def check(self, fresh: list[str], ids: np.ndarray, begins: np.ndarray, surfaces: list[bytes]) -> None:
        """Compare new segments with the library: as one text, in which they stay segments."""
        if not fresh:
            return
        if not self.cuts:
            for segment, low, high in zip(fresh, begins.tolist(), begins[1:].tolist(), strict=False):
                own = ids[low:high].tolist()
                if self.library.encode(segment[1:]) != own or self.library.decode(own) != self.decode(own):
                    raise AssertionError("the agenda and the sentencepiece library differ")
            return
        line_end, start = self.merge("\n"), self.merge(SPACE)
        expected = np.insert(ids, np.repeat(begins[:-1], len(line_end)), line_end * len(fresh))
        expected = [*start, *expected.tolist()]
        if self.library.encode("\n" + "\n".join(fresh), num_threads=1) != expected:
            raise AssertionError("the agenda and the sentencepiece library differ in encoding")
        if self.library.decode(expected) != "\n" + b"\n".join(surfaces).decode():
            raise AssertionError("the decoder and the sentencepiece library differ")

    def merge_all(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in a row, and where those of each begin (and the last ones end)."""
        rows, sizes, merged = self.agenda.merge(segments)
        rest = np.ones(len(segments), bool)
        rest[rows] = False
        at = np.flatnonzero(rest)
        lists = [self.merge(segments[n]) for n in at.tolist()]
        counts = np.zeros(len(segments), np.int64)
        counts[rows] = sizes
        counts[at] = [len(ids) for ids in lists]
        begins = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(begins[-1], np.int32)
        own = begins[:-1][rows]
        ids[np.repeat(own - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(merged))] = merged
        for low, found in zip(begins[at].tolist(), lists, strict=True):
            ids[low : low + len(found)] = found
        return ids, begins

    def learn(self, wanted: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids (as text, each with a comma after it) and surface, in UTF-8, of distinct segments."""
        if len(self.known) > REMEMBERED:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        found = list(map(known.get, wanted))
        fresh = []
        for number in [n for n, entry in enumerate(found) if entry is None]:
            segment = wanted[number]
            entry = found[number] = old.get(segment)
            if entry is None:
                fresh.append(number)
            else:
                known[segment] = entry
        if not fresh:
            return found
        segments = [wanted[number] for number in fresh]
        ids, begins = self.merge_all(segments)
        decimal = [bytes(part) for part in put_together(self.decimals, ids, begins)]
        surfaces = [bytes(part) for part in put_together(self.utf8, ids, begins)]
        # Byte pieces make up characters together, or signs for what is none.
        whole = np.concatenate([[0], np.cumsum(self.is_byte[ids])])[begins]
        for number in np.flatnonzero(np.diff(whole)).tolist():
            surfaces[number] = self.surface(ids[begins[number] : begins[number + 1]].tolist()).encode()
        self.check(segments, ids, begins, surfaces)
        for number, segment, entry in zip(fresh, segments, zip(decimal, surfaces, strict=True), strict=True):
            found[number] = entry
            if len(segment) <= LONGEST_REMEMBERED:
                known[segment] = entry
        return found

    def round_trip(self, texts: list[str]) -> list[tuple[memoryview, memoryview]]:
        """Of each text its ids as decimal numbers joined by commas, and the UTF-8 of what they decode to."""
        # The library takes the sign for a space as a space, too.
        plain = [self.cuts and SPACE not in text for text in texts]
        out: list[tuple[memoryview, memoryview]] = [(memoryview(b""), memoryview(b""))] * len(texts)
        cut = [n for n, ok in enumerate(plain) if ok and texts[n]]
        if cut:
            segments, numbers, begins = cut_segments([" " + texts[n] for n in cut], self.marks)
            self._fill(out, cut, [s.replace(" ", SPACE) for s in segments], numbers, begins)
        rest = [n for n, ok in enumerate(plain) if not ok and texts[n]]
        if rest:
            lists = [self.segments(texts[n]) for n in rest]
            coded = pa.array([s for segments in lists for s in segments], pa.large_string()).dictionary_encode()
            begins = np.concatenate([[0], np.cumsum([len(segments) for segments in lists])])
            self._fill(out, rest, coded.dictionary.to_pylist(), coded.indices.to_numpy(), begins)
        return out

    def _fill(self, out: list, places: list[int], segments: list[str], numbers: np.ndarray, begins: np.ndarray) -> None:
        pairs = self.learn(segments)
        ids = put_together([pair[0] for pair in pairs], numbers, begins)
        texts = put_together([pair[1] for pair in pairs], numbers, begins)
        for place, one, two in zip(places, ids, texts, strict=True):
            out[place] = one[:-1], two[1:] if two[:1] == b" " else two


class _Agenda:
    """Merges many short segments at a time: each has a row of symbols and one of the ranks of its pairs, of
    which the first lowest is merged, until no row has a pair that is a piece.

    Symbols are numbers: ids of pieces, and numbers above them for other characters of pieces.
    """

    def __init__(self, ids: dict[str, int], scores: dict[str, float]) -> None:
        self.size = 1 + max(ids.values(), default=0)
        symbols = dict(ids)
        for sign in dict.fromkeys(sign for piece in ids for sign in piece):
            symbols.setdefault(sign, self.size + len(symbols) - len(ids))
        self.none = self.size + len(symbols) - len(ids)
        self.of_sign = np.full(0x110000, -1, np.int32)
        for sign, number in symbols.items():
            if len(sign) == 1:
                self.of_sign[ord(sign)] = number
        order = sorted((piece for piece in ids if len(piece) > 1), key=lambda piece: -scores[piece])
        rank_of = {score: rank for rank, score in enumerate(dict.fromkeys(scores[piece] for piece in order))}
        # The piece of each rank; none where pieces share a score.
        self.merged = np.full(max(1, len(rank_of)), -1, np.int32)
        shared = np.zeros(len(self.merged), np.int64)
        pairs = {}
        for piece in order:
            rank = rank_of[scores[piece]]
            self.merged[rank] = ids[piece]
            shared[rank] += 1
            for at in range(1, len(piece)):
                first, second = symbols.get(piece[:at]), symbols.get(piece[at:])
                if first is not None and second is not None:
                    pairs[first << 32 | second] = rank
        self.merged[shared > 1] = -1
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        # A table by hash, eight times as large; what finds its slot taken goes to the next one.
        self.shift = 64 - (8 * max(2, len(pairs))).bit_length()
        self.keys = np.full((1 << 64 - self.shift) + 1, -1, np.int64)
        self.ranks = np.full(len(self.keys), NO_RANK, np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            first = np.unique(slots, return_index=True)[1]
            taken = np.zeros(len(keys), bool)
            taken[first] = True
            taken &= free
            self.keys[slots[taken]], self.ranks[slots[taken]] = keys[taken], ranks[taken]
            keys, ranks, slots = keys[~taken], ranks[~taken], self._next(slots[~taken])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def _next(self, slots: np.ndarray) -> np.ndarray:
        return (slots + 1) % len(self.keys)

    def rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Ranks of the pairs of symbols, NO_RANK for those that are no piece."""
        wanted = first.astype(np.int64) << 32 | second
        slots = self._slots(wanted)
        held = self.keys[slots]
        found = np.where(held == wanted, self.ranks[slots], NO_RANK)
        open_ = np.flatnonzero((held != wanted) & (held != -1))
        slots = slots[open_]
        while len(open_):
            slots = self._next(slots)
            held = self.keys[slots]
            hit = held == wanted[open_]
            found[open_[hit]] = self.ranks[slots[hit]]
            going = ~hit & (held != -1)
            open_, slots = open_[going], slots[going]
        return found

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows that are merged here, the number of ids of each, and these ids one row after another.

        Long segments, and those with characters that are no pieces or with pairs whose pieces share a score,
        are left out.
        """
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        signs = self.of_sign[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        begins = np.cumsum(sizes) - sizes
        strange = np.concatenate([[0], np.cumsum((signs < 0) | (signs >= self.size))])
        own = (sizes > 0) & (strange[begins + sizes] == strange[begins])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero(own & (sizes > low) & (sizes <= width))
            low = width
            columns = np.arange(width)
            for start in range(0, len(rows), TOGETHER):
                part = rows[start : start + TOGETHER]
                inside = columns < sizes[part, None]
                table = np.where(inside, signs[np.minimum(begins[part, None] + columns, len(signs) - 1)], self.none)
                done += self._merge(part, table)
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        rows = np.concatenate([part for part, _ in done])
        counts = np.concatenate([(table != self.none).sum(axis=1) for _, table in done])
        return rows, counts, np.concatenate([table[table != self.none] for _, table in done])

    def _merge(self, rows: np.ndarray, table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows of symbols after all merges, those that are done in the same round together."""
        done = []
        ranks = self.rank(table[:, :-1].ravel(), table[:, 1:].ravel()).reshape(len(rows), -1)
        while len(rows) and ranks.shape[1]:
            left = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), left]
            going = best != NO_RANK
            told = self.merged[np.where(going, best, 0)] >= 0
            if not (going & told).all():
                done.append((rows[~going], table[~going]))
                going &= told
                rows, table, ranks, left, best = (each[going] for each in (rows, table, ranks, left, best))
            every, width = np.arange(len(rows)), table.shape[1] - 1
            merged = self.merged[best]
            # What is behind the pair moves up by one.
            behind = np.arange(width) > left[:, None]
            table = np.where(behind, table[:, 1:], table[:, :-1])
            table[every, left] = merged
            ranks = np.where(behind[:, 1:] | (np.arange(width - 1) >= left[:, None]), ranks[:, 1:], ranks[:, :-1])
            at = np.flatnonzero(left < width - 1)
            ranks[at, left[at]] = self.rank(merged[at], table[at, left[at] + 1])
            at = np.flatnonzero(left > 0)
            ranks[at, left[at] - 1] = self.rank(table[at, left[at] - 1], merged[at])
        if len(rows):
            done.append((rows, table))
        return done


def _utf8(raw: bytes) -> str:
    """Bytes as text; each byte that is not part of a valid character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of a model file, made once per Python worker."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    claim(f"pieces {path}", _codecs.clear)
    return _codecs[path]


def _append(batch: pa.RecordBatch, arrays: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each whole text as ``array<int>``; an existing column ``ids`` is replaced.

    No begin or end ids are added. Null and the empty text have no ids (an empty array). Every other
    column is kept. An empty table gives an empty table.
    """
    kept = df.drop(ids)
    at = kept.columns.index(text)

    def run(batches):
        pieces = codec(path)
        for batch in batches:
            for start, texts in chunks(batch.column(at)):
                found = [
                    [int(n) for n in bytes(joined).split(b",")] if joined else []
                    for joined, _ in pieces.round_trip(texts)
                ]
                yield _append(batch.slice(start, len(texts)), [pa.array(found, pa.list_(pa.int32()))], [ids])

    return kept.mapInArrow(run, _extended(kept, f"`{ids}` array<int>"))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of each id array; null ids give the empty text. ``text`` is replaced if present."""
    kept = df.drop(text)
    at = kept.columns.index(ids)

    def run(batches):
        pieces = codec(path)
        for batch in batches:
            found = [pieces.decode(n for n in value.as_py() or [] if n is not None) for value in batch.column(at)]
            yield _append(batch, [pa.array(found, pa.string())], [text])

    return kept.mapInArrow(run, _extended(kept, f"`{text}` string"))


def _extended(df: DataFrame, extra: str):
    from pyspark.sql.types import StructType

    return StructType([*df.schema.fields, *StructType.fromDDL(extra).fields])


def token_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode each whole text; keep the digests of both instead of ids and text.

    One row per input row: ``key``, ``n_tokens`` (long), ``ids_sha256`` (of the decimal ids joined by
    commas) and ``decoded_sha256`` (of the decoded text in UTF-8), lower-case hex. Null texts count as
    empty: no tokens and the digest of nothing. Repeated rows give repeated results, a null key stays
    null, other columns are ignored.
    """
    from hashlib import sha256

    def run(batches):
        pieces = codec(path)
        for batch in batches:
            for start, texts in chunks(batch.column(1), CUT_CHARS):
                pairs = pieces.round_trip(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array([bytes(ids).count(b",") + 1 if ids else 0 for ids, _ in pairs], pa.int64()),
                        pa.array([sha256(ids).hexdigest() for ids, _ in pairs], pa.string()),
                        pa.array([sha256(out).hexdigest() for _, out in pairs], pa.string()),
                    ],
                    ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    picked = df.select(column(key).alias("key"), column(text).alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return picked.mapInArrow(run, schema).withColumnRenamed("key", key)
