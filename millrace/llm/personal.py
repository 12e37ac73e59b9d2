"""Personal data: base patterns, and a character-level BiLSTM with CRF transitions that adds spans.

The network is trained in numpy on lines of the corpus in which the base patterns label the spans,
together with variants of those spans that the patterns do not match. It reads overlapping windows of
a whole text; spans from all windows are reconciled over the text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import chunks, column, hash_sample, map_batches
from millrace.workspace import written

# The kinds in their order, and the patterns that define them.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Possessive, and only from the first digit of a run on, where the leftmost match must start.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HINT = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")

# Windows of a text, and how much neighbours share; a span that is longer is left to the patterns.
WINDOW, OVERLAP = 256, 64
# At most so many lines of the corpus, each cut to so many characters, train the network.
SAMPLE_LINES, SAMPLE_CHARS = 3_000, 1_000
TRAIN_WINDOW, TRAIN_WINDOWS, EPOCHS = 64, 2_400, 12
CLASSES, EMBEDDED, UNITS, SEED = 98, 12, 16, 11
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _parts_fit(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-3:] if len(part) > 3 else part) <= 255 for part in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Spans by the patterns, kind by kind, leftmost first and not overlapping within a kind."""
    if not _HINT.search(text):
        return []
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        # The address starts as far left as its characters go, but not inside the one before it.
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            free = domain.end()
        else:
            free = max(free, at)  # what is left of this sign cannot reach across it
        at = text.find("@", max(free, at + 1))
    for found in _IP.finditer(text):
        if _parts_fit(found.group()):
            out.append(("ip", found.start(), found.end()))
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = _digits(found.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", found.start(), found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 8 <= len(_digits(found.group())) <= 15:
                out.append(("phone", found.start(), found.end()))
    return out


def character_classes(text: str) -> np.ndarray:
    """A class per code point: printable ASCII one each, other ASCII one, everything else one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points > 126, 97, np.where(points < 32, 96, points - 32)).clip(0, 97).astype(np.int16)


def _squash(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Tagger:
    """Parameters: embedding; input, recurrent weights and bias of both directions; output; CRF."""

    p: dict[str, np.ndarray]

    @staticmethod
    def new(seed: int = SEED) -> Tagger:
        rng = np.random.default_rng(seed)

        def draw(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        p = {"E": draw(CLASSES, EMBEDDED) * np.float32(np.sqrt(CLASSES) * 0.5), "O": draw(2 * UNITS, TAGS)}
        p |= {"o": np.zeros(TAGS, np.float32), "T": np.zeros((TAGS, TAGS), np.float32)}
        p |= {"S": np.zeros(TAGS, np.float32), "Z": np.zeros(TAGS, np.float32)}
        for way in "fb":
            p["W" + way] = draw(EMBEDDED, 4 * UNITS)
            p["U" + way] = draw(UNITS, 4 * UNITS)
            p["c" + way] = np.zeros(4 * UNITS, np.float32)
            p["c" + way][UNITS : 2 * UNITS] = 1
        return Tagger(p)

    def _pass(self, ids: np.ndarray, mask: np.ndarray, way: str, keep: bool = False):
        """Hidden states by place for ids (window, place); with ``keep`` what training needs."""
        rows, places = ids.shape
        table = self.p["E"] @ self.p["W" + way] + self.p["c" + way]
        weights = self.p["U" + way]
        h = np.zeros((rows, UNITS), np.float32)
        c = np.zeros((rows, UNITS), np.float32)
        out = np.empty((places, rows, UNITS), np.float32)
        kept = []
        for t in range(places) if way == "f" else range(places - 1, -1, -1):
            gates = table[ids[:, t]] + h @ weights
            gate = _squash(gates[:, : 3 * UNITS])
            i, f, o = gate[:, :UNITS], gate[:, UNITS : 2 * UNITS], gate[:, 2 * UNITS :]
            g = np.tanh(gates[:, 3 * UNITS :])
            real = mask[:, t, None]
            before, entered = c, h
            c = (f * c + i * g) * real
            squashed = np.tanh(c)
            h = o * squashed
            out[t] = h
            if keep:
                kept.append((t, entered, before, i, f, o, g, squashed, real))
        return (out, kept) if keep else out

    def emissions(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Scores (place, window, tag)."""
        both = np.concatenate([self._pass(ids, mask, "f"), self._pass(ids, mask, "b")], axis=2)
        return both @ self.p["O"] + self.p["o"]

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best tags (window, place) under the transitions; places past a length are outside."""
        rows, places = ids.shape
        mask = (np.arange(places) < lengths[:, None]).astype(np.float32)
        scores = self.emissions(ids, mask)
        best = scores[0] + self.p["S"]
        back = np.zeros((places, rows, TAGS), np.int8)
        for t in range(1, places):
            paths = best[:, :, None] + self.p["T"]
            back[t] = paths.argmax(axis=1)
            new = paths.max(axis=1) + scores[t]
            best = np.where(mask[:, t, None] > 0, new, best)
        tags = np.zeros((rows, places), np.int8)
        tag = (best + self.p["Z"]).argmax(axis=1)
        every = np.arange(rows)
        for t in range(places - 1, -1, -1):
            real = mask[:, t] > 0
            tags[real, t] = tag[real]
            if t:
                tag = np.where(real, back[t, every, tag], tag)
        return tags

    def slopes(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss (negative log-likelihood under the CRF, mean of windows) and its gradient.

        Every window is full: all places are real.
        """
        p, rows, places = self.p, *ids.shape
        ones = np.ones(ids.shape, np.float32)
        forward, kept_f = self._pass(ids, ones, "f", True)
        backward, kept_b = self._pass(ids, ones, "b", True)
        both = np.concatenate([forward, backward], axis=2)
        scores = both @ p["O"] + p["o"]
        alpha = np.empty_like(scores)
        beta = np.empty_like(scores)

        def add(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

        alpha[0] = scores[0] + p["S"]
        for t in range(1, places):
            alpha[t] = add(alpha[t - 1][:, :, None] + p["T"], 1) + scores[t]
        beta[-1] = p["Z"]
        for t in range(places - 2, -1, -1):
            beta[t] = add(p["T"] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = add(alpha[-1] + p["Z"], 1)
        marginal = np.exp(alpha + beta - total[:, None])
        every = np.arange(rows)
        d_scores = marginal.copy()
        for t in range(places):
            d_scores[t, every, gold[:, t]] -= 1
        d = {"S": d_scores[0].sum(axis=0) / rows, "Z": d_scores[-1].sum(axis=0) / rows}
        d_t = np.zeros_like(p["T"])
        for t in range(1, places):
            joint = alpha[t - 1][:, :, None] + p["T"] + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
            d_t += np.exp(joint).sum(axis=0)
            np.subtract.at(d_t, (gold[:, t - 1], gold[:, t]), 1)
        d["T"] = d_t / rows
        path = p["S"][gold[:, 0]] + p["Z"][gold[:, -1]]
        for t in range(places):
            path = path + scores[t, every, gold[:, t]]
            if t:
                path = path + p["T"][gold[:, t - 1], gold[:, t]]
        loss = float((total - path).mean())
        d_scores /= rows
        d["O"] = np.einsum("trh,trk->hk", both, d_scores, optimize=True)
        d["o"] = d_scores.sum(axis=(0, 1))
        d_both = d_scores @ p["O"].T
        d["E"] = np.zeros_like(p["E"])
        for way, kept, part in (("f", kept_f, d_both[:, :, :UNITS]), ("b", kept_b, d_both[:, :, UNITS:])):
            d_table = np.zeros((CLASSES, 4 * UNITS), np.float32)
            d_u = np.zeros_like(p["U" + way])
            d_h = np.zeros((rows, UNITS), np.float32)
            d_c = np.zeros((rows, UNITS), np.float32)
            for t, entered, before, i, f, o, g, squashed, _ in reversed(kept):
                d_h = d_h + part[t]
                d_c = d_c + d_h * o * (1 - squashed * squashed)
                gates = np.concatenate(
                    [d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - g * g)],
                    axis=1,
                )
                d_u += entered.T @ gates
                np.add.at(d_table, ids[:, t], gates)
                d_h = gates @ p["U" + way].T
                d_c = d_c * f
            d["U" + way] = d_u
            d["W" + way] = p["E"].T @ d_table
            d["c" + way] = d_table.sum(axis=0)
            d["E"] += d_table @ p["W" + way].T
        return loss, d

    def train(self, ids: np.ndarray, gold: np.ndarray, epochs: int = EPOCHS, batch: int = 96, seed: int = SEED) -> float:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, loss = 0, 0.0
        for epoch in range(epochs):
            rate = 0.02 if epoch < epochs * 2 // 3 else 0.005
            order = rng.permutation(len(ids))
            losses = []
            for low in range(0, len(order), batch):
                rows = order[low : low + batch]
                loss, slopes = self.slopes(ids[rows], gold[rows])
                losses.append(loss)
                step += 1
                size = np.sqrt(sum(float((s * s).sum()) for s in slopes.values()))
                shrink = min(1.0, 5 / (size + 1e-9))
                for k, s in slopes.items():
                    s = s * np.float32(shrink)
                    first[k] = 0.9 * first[k] + 0.1 * s
                    second[k] = 0.99 * second[k] + 0.01 * s * s
                    self.p[k] -= np.float32(rate) * (first[k] / (1 - 0.9**step)) / (
                        np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
                    )
            loss = float(np.mean(losses)) if losses else 0.0
        return loss


def variant(kind: str, text: str, rng: np.random.Generator) -> str:
    """Another way to write a piece of personal data, one that the patterns do not match whole."""
    digits = _digits(text)
    pick = int(rng.integers(3))
    if kind == "email":
        return text.replace("@", (" @ ", "@ ", " @")[pick])
    if kind == "ip":
        return text.replace(".", ("[.]", " . ", "(.)")[pick])
    if kind == "card":
        groups = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return (".", "/", "  ")[pick].join(groups)
    tail = digits[-10:]
    if len(tail) < 10:
        return text
    return (f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", f"{tail[:3]}.{tail[3:6]}.{tail[6:]}")[pick]


def _tagged(text: str, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(len(text), np.int8)
    for kind, start, end in spans:
        if not tags[start:end].any():
            code = 1 + 2 * KINDS.index(kind)
            tags[start] = code
            tags[start + 1 : end] = code + 1
    return tags


def training_windows(lines: list[str], seed: int = SEED, most: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Windows (class and gold tag by place) around spans, their variants, and other digits."""
    rng = np.random.default_rng(seed)
    found: list[tuple[str, np.ndarray]] = []

    def window(text, tags, start, end):
        pad = TRAIN_WINDOW
        text, tags = " " * pad + text + " " * pad, np.pad(tags, pad)
        low = max(0, end + pad - TRAIN_WINDOW)
        at = int(rng.integers(low, max(low, start + pad) + 1))
        part = tags[at : at + TRAIN_WINDOW].copy()
        # A span that begins before the window is inside from its first place on.
        found.append((text[at : at + TRAIN_WINDOW], part))

    for line in lines:
        spans = base_spans(line)
        tags = _tagged(line, spans)
        for kind, start, end in spans:
            if end - start > TRAIN_WINDOW - 8:
                continue
            window(line, tags, start, end)
            other = variant(kind, line[start:end], rng)
            text = line[:start] + other + line[end:]
            own = np.concatenate([tags[:start], _tagged(other, [(kind, 0, len(other))]), tags[end:]])
            if len(other) <= TRAIN_WINDOW - 8:
                window(text, own, start, start + len(other))
        plain = [m.start() for m in re.finditer(r"[0-9@]", line) if not tags[m.start()]]
        for start in plain[:: max(1, len(plain) // 2)][:2]:
            window(line, tags, start, start + 1)
        if len(line) > TRAIN_WINDOW:
            start = int(rng.integers(len(line) - 1))
            window(line, tags, start, start + 1)
    order = rng.permutation(len(found))[:most]
    ids = np.stack([character_classes(found[k][0]) for k in order]) if len(order) else np.zeros((0, TRAIN_WINDOW), np.int16)
    gold = np.stack([found[k][1] for k in order]) if len(order) else np.zeros((0, TRAIN_WINDOW), np.int8)
    return ids, gold


def fit(df: DataFrame, text: str = "text") -> Tagger | None:
    """Train a tagger on a bounded sample of the corpus's lines that hold a digit or an at sign.

    All distinct lines, cut to ``SAMPLE_CHARS``, or the first ``SAMPLE_LINES`` of them in the order of a hash;
    they are written once and counted. None if no line of the sample holds personal data by the
    patterns: there is nothing to learn from.
    """
    lines = F.filter(F.split(column(text), "\n", -1), lambda line: line.rlike("[0-9@]"))
    found = df.select(F.explode(lines).alias("line")).select(F.substring("line", 1, SAMPLE_CHARS).alias("line"))
    sample = hash_sample(written(found.distinct(), "personal-lines"), ["line"], SAMPLE_LINES).collect()
    ids, gold = training_windows([r.line for r in sample])
    if not gold.any():
        return None
    tagger = Tagger.new()
    tagger.train(ids, gold)
    return tagger


def window_starts(size: int) -> range:
    """Starts of the windows that cover a text of ``size``, each sharing OVERLAP with the next."""
    stride = WINDOW - OVERLAP
    return range(0, max(1, size - OVERLAP), stride)


def _read_tags(tags: np.ndarray, kind_of: dict[int, str]) -> list[Span]:
    """Spans of one window: a begin or inside tag and the inside tags of its kind after it."""
    out: list[Span] = []
    marked = np.flatnonzero(tags)
    k = 0
    while k < len(marked):
        start = end = int(marked[k])
        kind = kind_of[int(tags[start])]
        inside = 2 + 2 * KINDS.index(kind)
        k += 1
        while k < len(marked) and marked[k] == end + 1 and tags[marked[k]] == inside:
            end += 1
            k += 1
        out.append((kind, start, end + 1))
    return out


_KIND_OF = {1 + 2 * k: kind for k, kind in enumerate(KINDS)} | {2 + 2 * k: kind for k, kind in enumerate(KINDS)}


def plausible(kind: str, text: str) -> bool:
    """What every added span must satisfy; in particular it holds a digit or an at sign."""
    digits = _digits(text)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s*@\s*[A-Za-z0-9-]+(\s?\.\s?[A-Za-z0-9-]+)+", text))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", text)
    return 9 <= len(digits) <= 15 and not re.search("[A-Za-z]", text)


def added_spans(tagger: Tagger | None, texts: list[str], base: list[list[Span]], gate: bool = True) -> list[list[Span]]:
    """Spans that the tagger finds in whole texts besides the base spans.

    A window without a digit or an at sign cannot hold a plausible span, and each window is decoded by
    itself, so with ``gate`` such windows are left out without changing the result. A span that
    touches a window's edge inside the text is left to the neighbour, which holds all of it. Where
    spans of different windows overlap, the longer one wins, then the earlier one.
    """
    out: list[list[Span]] = [[] for _ in texts]
    if tagger is None:
        return out
    jobs: list[tuple[int, int]] = []
    for number, text in enumerate(texts):
        starts = window_starts(len(text))
        if not text:
            continue
        if gate:
            wanted: set[int] = set()
            for hit in _HINT.finditer(text):
                at, stride = hit.start(), WINDOW - OVERLAP
                last = min(at // stride, len(starts) - 1)
                k = last
                while k >= 0 and starts[k] + WINDOW > at:
                    wanted.add(k)
                    k -= 1
            jobs.extend((number, starts[k]) for k in sorted(wanted))
        else:
            jobs.extend((number, start) for start in starts)
    found: list[list[Span]] = [[] for _ in texts]
    for low in range(0, len(jobs), 1024):
        part = jobs[low : low + 1024]
        lengths = np.asarray([min(WINDOW, len(texts[n]) - s) for n, s in part])
        ids = np.zeros((len(part), int(lengths.max())), np.int16)
        for row, (number, start) in enumerate(part):
            ids[row, : lengths[row]] = character_classes(texts[number][start : start + WINDOW])
        tags = tagger.decode(ids, lengths)
        for row in np.flatnonzero(tags.any(axis=1)).tolist():
            number, start = part[row]
            for kind, a, b in _read_tags(tags[row, : lengths[row]], _KIND_OF):
                cut_left = a == 0 and start > 0
                cut_right = b == lengths[row] and start + b < len(texts[number])
                if not cut_left and not cut_right and plausible(kind, texts[number][start + a : start + b]):
                    found[number].append((kind, start + a, start + b))
    for number, spans in enumerate(found):
        taken = [(a, b) for _, a, b in base[number]]
        for kind, a, b in sorted(set(spans), key=lambda s: (s[1] - s[2], s[1], s[0])):
            if all(b <= x or y <= a for x, y in taken):
                taken.append((a, b))
                out[number].append((kind, a, b))
    return out


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _joined(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{start}:{end}" for kind, start, end in ordered(spans)])


def find(df: DataFrame, tagger: Tagger | None, text: str = "text", out: str = "spans") -> DataFrame:
    """``df`` with all spans of each whole text: ``array<struct<kind, start, end, base>>``.

    By kind in the order of ``KINDS``, then start; offsets in code points, the end exclusive. Null and
    empty texts have no spans. A column ``out`` that is there is replaced, every other one is kept.
    """
    kept = df.drop(out)
    at = kept.columns.index(text)
    kind = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batch):
        for start, texts in chunks(batch.column(at)):
            base = [base_spans(t) for t in texts]
            rows = []
            for own, more in zip(base, added_spans(tagger, texts, base), strict=True):
                known = set(own)
                rows.append(
                    [
                        {"kind": k, "start": a, "end": b, "base": (k, a, b) in known}
                        for k, a, b in ordered([*own, *more])
                    ]
                )
            part = batch.slice(start, len(texts))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, arrow)], [*part.schema.names, out])

    return map_batches(kept, run, StructType([*kept.schema.fields, *StructType.fromDDL(f"`{out}` {kind}").fields]))


def mask(df: DataFrame, tagger: Tagger | None, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``df`` with every span replaced by its kind in angle brackets, and ``length`` set to the new
    number of code points. Where spans overlap, they go together under the first one's kind. A null
    text stays null; rows, order of columns and all other columns stay as they are."""
    at = df.columns.index(text)
    size_at = df.columns.index(length) if length in df.columns else None

    def run(batch):
        for start, texts in chunks(batch.column(at)):
            part = batch.slice(start, len(texts))
            base = [base_spans(t) for t in texts]
            more = added_spans(tagger, texts, base)
            done = [masked(t, [*b, *m]) if b or m else t for t, b, m in zip(texts, base, more, strict=True)]
            valid = part.column(at).is_valid().to_pylist()
            columns = list(part.columns)
            columns[at] = pa.array([t if ok else None for t, ok in zip(done, valid, strict=True)], pa.string())
            if size_at is not None:
                old = part.column(size_at)
                changed = [len(t) if b or m else o for t, b, m, o in zip(done, base, more, old.to_pylist(), strict=True)]
                columns[size_at] = pa.array(changed, old.type)
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return map_batches(df, run, df.schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by ``<kind>``."""
    out, at = [], 0
    reach = -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < reach:
            reach = max(reach, end)
            at = max(at, reach)
            continue
        out += [text[at:start], f"<{kind}>"]
        at = reach = end
    out.append(text[at:])
    return "".join(out)


def span_digests(df: DataFrame, tagger: Tagger | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key``, counts of base spans by kind, ``base_sha256`` and ``spans`` (all, as text).

    A span is written kind:start:end. Null texts count as empty: counts of zero, no spans, and the
    digest of nothing. Repeated rows give repeated results; other columns are ignored.
    """
    from hashlib import sha256

    picked = df.select(column(key).alias("key"), column(text).alias("text"))

    def run(batch):
        for start, texts in chunks(batch.column(1)):
            base = [base_spans(t) for t in texts]
            more = added_spans(tagger, texts, base)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, len(texts)),
                    *[pa.array([sum(s[0] == kind for s in own) for own in base], pa.int64()) for kind in KINDS],
                    pa.array([sha256(_joined(own).encode()).hexdigest() for own in base]),
                    pa.array([_joined([*own, *new]) for own, new in zip(base, more, strict=True)]),
                ],
                ["key", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"],
            )

    kind = picked.schema["key"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_batches(picked, run, f"key {kind}, {counts}, base_sha256 string, spans string").withColumnRenamed("key", key)
