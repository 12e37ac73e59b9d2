"""Token ids in files: one compressed frame per document, a shared dictionary and an offset index.

A folder holds ``dictionary`` (a Zstandard dictionary trained on serialized id arrays, possibly empty)
and ``part-NNNNN.ids`` files in ascending key order. All numbers are little-endian. A part file is

    8 bytes   b"MRIDS\\x01\\x00\\x00"
    32 bytes  SHA-256 of the dictionary
    frames    one Zstandard frame per document; its content is the ids as unsigned 32-bit integers
    index     for n documents: n + 1 frame offsets (u64), n keys (i64), n token counts (u64),
              n key-present flags (u8)
    footer    n (u64), offset of the index (u64), 8 bytes b"MRIDSEND"

so that one document is read by the footer, its two offsets and its own frame.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import (
    ASCII_LETTERS,
    ASCII_SIGNS,
    chunks,
    claim,
    column,
    cut_segments,
    cuts_between,
    file_system,
    hash_sample,
    put_together,
    write_file,
)
from millrace.workspace import new_dir

MAGIC, END = b"MRIDS\x01\x00\x00", b"MRIDSEND"
# The dictionary is trained on at most so many documents, of each at most so many characters.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
# Distinct segments remembered in a generation. A full generation becomes the old one, from which
# segments still in use come back, and the one before it is forgotten. Results do not depend on it.
REMEMBERED = 500_000
# Longer segments are encoded without being remembered.
LONGEST_REMEMBERED = 64
# New segments that the library gets in one text, and characters that are cut at a time.
GROUP, CUT_CHARS = 100, 1 << 22
# Where texts are cut: before a space, around a line end and behind a letter.
ANY = bytes(range(256))
CUTS = cuts_between((ANY, b" \n"), (b"\n", ANY), (ASCII_LETTERS, ASCII_SIGNS))
# White space of ASCII besides the space and the line end.
OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"


class IdEncoder:
    """Ids of a tokenizers-library vocabulary (byte-level BPE), as little-endian bytes.

    The tokenizer cuts texts into words before it looks for ids, and never joins what a space or a
    line end separates, nor a letter with a digit or punctuation behind it. So a text whose only white
    space is those two is cut there, each distinct segment is encoded by the library once, and the ids
    are put together again. Other texts, and
    vocabularies of another kind, go to the library whole. The strings of special tokens in a text
    are ordinary text.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        words = self.library.pre_tokenizer
        self.cuts = (
            isinstance(words, pre_tokenizers.ByteLevel)
            and words.use_regex
            and not words.add_prefix_space
            and self.library.normalizer is None
        )
        line_end = self.library.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if len(line_end) == 1 else None
        self.cuts = self.cuts and self.line_end is not None
        self.other_space = re.compile(r"[^\S \n]")
        self.long_space = re.compile(r"[ \n]{3}|[ \n]{2}\Z")
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _segments(self, fresh: list[str]) -> list[bytes]:
        """Ids of segments: many in one text, each behind a line end that is taken off again."""
        words = [s for s in fresh if "\n" not in s and s not in ("", " ")]
        found = {}
        if words:
            groups = [words[k : k + GROUP] for k in range(0, len(words), GROUP)]
            for group, raw in zip(groups, self._library(["\n" + "\n".join(g) for g in groups]), strict=True):
                whole = np.frombuffer(raw, "<u4")
                at = (4 * np.append(np.flatnonzero(whole == self.line_end), len(whole))).tolist()
                if len(at) != len(group) + 1:
                    raise AssertionError("a line end was joined with a word")
                for word, low, high in zip(group, at, at[1:], strict=False):
                    found[word] = raw[low + 4 : high]
        rest = [s for s in fresh if s not in found]
        found.update(zip(rest, self._library(rest), strict=True))
        return [found[s] for s in fresh]

    def counts(self, texts: list[str]) -> list[int]:
        """Numbers of ids, without the ids."""
        out = [0] * len(texts)
        plain = [self.plain(text) for text in texts]
        whole = [n for n, ok in enumerate(plain) if not ok]
        for number, ids in zip(whole, self._library([texts[n] for n in whole]), strict=True):
            out[number] = len(ids) // 4
        cut = [n for n, ok in enumerate(plain) if ok]
        if cut:
            segments, numbers, begins = cut_segments([texts[n] for n in cut], CUTS)
            sizes = np.fromiter(map(len, self.learn(segments)), np.int64, len(segments)) // 4
            ends = np.concatenate([[0], np.cumsum(sizes[numbers])])[begins]
            for number, size in zip(cut, np.diff(ends).tolist(), strict=True):
                out[number] = size
        return out

    def learn(self, wanted: list[str]) -> list[bytes]:
        """Ids of distinct segments."""
        if len(self.known) > REMEMBERED:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        found = list(map(known.get, wanted))
        fresh = []
        for number in [n for n, ids in enumerate(found) if ids is None]:
            segment = wanted[number]
            ids = found[number] = old.get(segment)
            if ids is None:
                fresh.append(number)
            else:
                known[segment] = ids
        for number, ids in zip(fresh, self._segments([wanted[n] for n in fresh]), strict=True):
            found[number] = ids
            if len(wanted[number]) <= LONGEST_REMEMBERED:
                known[wanted[number]] = ids
        return found

    def plain(self, text: str) -> bool:
        """Whether single spaces and line ends are the only white space, so that CUTS tells all words.

        Of two in a row the tokenizer splits the first off, as cutting does; of more, or two at the end,
        it makes one word.
        """
        if not self.cuts or any(sign in text for sign in OTHER_SPACE):
            return False
        if not text.isascii() and self.other_space.search(text):
            return False
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return not self.long_space.search(text)
        return True

    def encode(self, texts: list[str]) -> list[bytes | memoryview]:
        """Ids of each text."""
        out: list[bytes | memoryview] = [b""] * len(texts)
        plain = [self.plain(text) for text in texts]
        whole = [n for n, ok in enumerate(plain) if not ok]
        for number, ids in zip(whole, self._library([texts[n] for n in whole]), strict=True):
            out[number] = ids
        cut = [n for n, ok in enumerate(plain) if ok]
        if cut:
            segments, numbers, begins = cut_segments([texts[n] for n in cut], CUTS)
            for number, ids in zip(cut, put_together(self.learn(segments), numbers, begins, 4), strict=True):
                out[number] = ids
        return out


_encoders: dict[str, IdEncoder] = {}


def encoder(path: str) -> IdEncoder:
    """The encoder of a vocabulary file, made once per Python worker."""
    if path not in _encoders:
        if TaskContext.get() is not None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library would take all
        _encoders[path] = IdEncoder(path)
    claim(f"ids {path}", _encoders.clear)
    return _encoders[path]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary for arrays like the samples; empty if they are too few to learn from."""
    samples = [s for s in samples if len(s) >= 8]
    if len(samples) < 8:
        return b""
    try:
        total = sum(map(len, samples))
        return zstandard.train_dictionary(min(size, max(256, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


@dataclass(frozen=True)
class TokenFiles:
    """A written folder: its parts in key order and the ids in front of each."""

    folder: str
    parts: tuple[str, ...]
    starts: tuple[int, ...]
    n_tokens: int


def write_ids(
    df: DataFrame, path: str, folder: str | None = None, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> TokenFiles:
    """Encode each whole text, append ``end_id`` and write the ids in ascending key order.

    Null texts count as empty, so they have the end id alone. Null keys come first; rows that repeat a
    key follow each other in the order of their texts. Columns other than key and text are ignored.
    An empty table gives a folder without parts. The rows are dealt by ranges of the key, the driver
    gets two numbers and a name per part file.
    """
    spark = df.sparkSession
    folder = folder or new_dir(spark, "token-ids")
    rows = df.select(column(key).cast("bigint").alias("key"), F.coalesce(column(text), F.lit("")).alias("text"))
    # At most SAMPLE_DOCS keys, and then their texts.
    keys = hash_sample(rows.where("key IS NOT NULL").select("key"), ["key"], SAMPLE_DOCS)
    sample = (
        rows.join(F.broadcast(keys.distinct()), "key", "left_semi")
        .select("key", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .orderBy(F.xxhash64("key"), "key", "text")
        .limit(SAMPLE_DOCS)
        .collect()
    )
    dictionary = train_dictionary([bytes(ids) for ids in encoder(path).encode([r.text for r in sample])])
    token = uuid.uuid4().hex
    write_file(folder, "dictionary", token, lambda stream: stream.write(dictionary))
    digest = sha256(dictionary).digest()
    shared = spark.sparkContext.broadcast(dictionary)
    tail = struct.pack("<I", end_id)

    def write(batches):
        context = TaskContext.get()
        number = context.partitionId()
        ids = encoder(path)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))

        def fill(stream):
            stream.write(MAGIC + digest)
            offsets, keys, counts, present = [len(MAGIC) + 32], [], [], []
            for batch in _chain(first, batches):
                for start, texts in chunks(batch.column(1), CUT_CHARS):
                    for raw in ids.encode(texts):
                        frame = pack.compress(bytes(raw) + tail)
                        stream.write(frame)
                        offsets.append(offsets[-1] + len(frame))
                        counts.append(len(raw) // 4 + 1)
                    own = batch.column(0).slice(start, len(texts))
                    keys.append(own.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                    present.append(own.is_valid().to_numpy(zero_copy_only=False).astype("u1"))
            stream.write(np.asarray(offsets, "<u8").tobytes())
            stream.write(np.concatenate(keys).tobytes() + np.asarray(counts, "<u8").tobytes())
            stream.write(np.concatenate(present).tobytes())
            stream.write(struct.pack("<QQ", len(counts), offsets[-1]) + END)
            return sum(counts)

        name = f"part-{number:05d}.ids"
        total = write_file(folder, name, f"{context.taskAttemptId()}-{token}", fill)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([name]), pa.array([total], pa.int64())],
            ["number", "name", "n_tokens"],
        )

    # Bounds between rows of one key need the beginning of their texts only.
    front = F.substring("text", 1, 32)
    found = (
        rows.repartitionByRange("key", front)
        .sortWithinPartitions("key", "text")
        .mapInArrow(write, "number int, name string, n_tokens bigint")
        .collect()
    )
    found.sort()
    starts, total = [], 0
    for part in found:
        starts.append(total)
        total += part.n_tokens
    return TokenFiles(folder, tuple(p.name for p in found), tuple(starts), total)


def _chain(first, rest):
    yield first
    for batch in rest:
        if batch.num_rows:
            yield batch


def _open(folder: str, name: str):
    files, root = file_system(folder)
    return files.open_input_file(f"{root}/{name}")


def _read(folder: str, name: str) -> bytes:
    with _open(folder, name) as file:
        return file.read()


def _index(file, digest: bytes):
    """Offsets, keys, counts and key flags of an open part file."""
    if file.size() < 64:
        raise ValueError("not a token file")
    head = file.read_at(40, 0)
    if head[:8] != MAGIC or head[8:] != digest:
        raise ValueError("the file belongs to another dictionary or format")
    n, at = struct.unpack("<QQ", (foot := file.read_at(24, file.size() - 24))[:16])
    if foot[16:] != END:
        raise ValueError("the file is not whole")
    raw = file.read_at(25 * n + 8, at)
    offsets = np.frombuffer(raw, "<u8", n + 1)
    keys = np.frombuffer(raw, "<i8", n, 8 * (n + 1))
    counts = np.frombuffer(raw, "<u8", n, 8 * (2 * n + 1))
    return offsets, keys, counts, np.frombuffer(raw, "u1", n, 8 * (3 * n + 1)).astype(bool)


def read_document(files: TokenFiles, part: str, row: int) -> np.ndarray:
    """Ids of one document, by reading the part's index and that document's frame only."""
    dictionary = _read(files.folder, "dictionary")
    with _open(files.folder, part) as file:
        offsets, _, counts, _ = _index(file, sha256(dictionary).digest())
        frame = file.read_at(int(offsets[row + 1] - offsets[row]), int(offsets[row]))
    unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    return np.frombuffer(unpack.decompress(frame, max_output_size=4 * int(counts[row])), "<u4")


def read_ids(spark: SparkSession, files: TokenFiles, digests: bool = False) -> DataFrame:
    """Read the files back: ``key``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (``array<bigint>``), or with ``digests`` their ``ids_crc32`` instead of the ids."""
    last = ("ids_crc32", "bigint") if digests else ("ids", "array<bigint>")
    schema = f"key bigint, start bigint, n_tokens bigint, {last[0]} {last[1]}"
    folder = files.folder

    def read(batches):
        dictionary = _read(folder, "dictionary")
        digest = sha256(dictionary).digest()
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _open(folder, name) as file:
                    offsets, keys, counts, present = _index(file, digest)
                    starts = start + np.cumsum(counts, dtype=np.int64) - counts.astype(np.int64)
                    for low, high in _runs(offsets, counts):
                        raw = file.read_at(int(offsets[high] - offsets[low]), int(offsets[low]))
                        values = []
                        for row in range(low, high):
                            frame = raw[int(offsets[row] - offsets[low]) : int(offsets[row + 1] - offsets[low])]
                            ids = unpack.decompress(frame, max_output_size=4 * int(counts[row]))
                            if len(ids) != 4 * int(counts[row]):
                                raise ValueError("a document does not have the ids its index says")
                            values.append(zlib.crc32(ids) if digests else np.frombuffer(ids, "<u4").astype("i8"))
                        kind = pa.int64() if digests else pa.list_(pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys[low:high], pa.int64(), mask=~present[low:high]),
                                pa.array(starts[low:high], pa.int64()),
                                pa.array(counts[low:high].astype("i8"), pa.int64()),
                                pa.array(values, kind),
                            ],
                            ["key", "start", "n_tokens", last[0]],
                        )

    parts = list(zip(files.parts, files.starts, strict=True))
    names = spark.createDataFrame(parts, "name string, start bigint")
    return names.repartition(max(1, len(parts))).mapInArrow(read, schema)


def _runs(offsets: np.ndarray, counts: np.ndarray, most: int = 1 << 20):
    """Row ranges whose ids number about ``most`` at most, a longer document by itself."""
    low, size = 0, 0
    for row in range(len(counts)):
        if row > low and size + int(counts[row]) > most:
            yield low, row
            low, size = row, 0
        size += int(counts[row])
    if low < len(counts):
        yield low, len(counts)
