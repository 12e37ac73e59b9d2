"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Every word has a random index vector that its hash determines. A word's own vector is the sum of the
index vectors of the words around it, over all documents. Words are told apart by hash, in a fixed
number of rows, so the table of vectors has a fixed size however many words there are.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import chunks, claim, column, hash_sample, map_batches

WORDS = 1 << 14
DIMENSIONS = 32
# A word's context: so many words on either side.
REACH = 2
# At most so many labelled documents train and calibrate the network, by order of a hash of the key.
SAMPLE = 20_000
THRESHOLD = 0.3
HIDDEN = 32
SEED = 7
# Rows of partial sums that are added up together.
SLICES = 64
# Words whose numbers a task remembers; with more it starts anew.
REMEMBERED = 100_000

# A run of letters, digits and underscores, or a run of other characters that are not white space.
_TOKEN = re.compile(r"\w+|[^\w\s]+")


def index_vectors(words: int = WORDS, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """Sparse random vectors: in each row an eighth of the places is +1 or -1, the rest zero."""
    rng = np.random.default_rng(seed)
    out = np.zeros((words, dimensions), np.float32)
    marked = max(2, dimensions // 8)
    places = rng.random((words, dimensions)).argsort(axis=1)[:, :marked]
    np.put_along_axis(out, places, rng.choice(np.float32([-1, 1]), (words, marked)), axis=1)
    return out


class Words:
    """Row numbers of words, remembered in a Python worker."""

    def __init__(self, rows: int) -> None:
        self.rows = rows
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        found = _TOKEN.findall(text)
        known = self.known
        try:
            return np.fromiter([known[w] for w in found], np.int64, len(found))
        except KeyError:
            if len(known) > REMEMBERED:
                known = self.known = {}
            for word in found:
                if word not in known:
                    known[word] = zlib.crc32(word.encode()) % self.rows
            return np.fromiter([known[w] for w in found], np.int64, len(found))


_words: dict[int, Words] = {}


def _numbered(rows: int) -> Words:
    claim("quality", _words.clear)
    return _words.setdefault(rows, Words(rows))


def word_vectors(df: DataFrame, text: str = "text", words: int = WORDS, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Word vectors from the contexts of all documents: a matrix of ``words`` by ``dimensions``.

    Each task adds up its documents in one matrix. The matrices are summed in slices by a shuffle, so
    the driver gets one matrix. Rows are scaled to unit length (zero for a word never seen).
    """
    picked = df.select(column(text).alias("text"))
    slices = min(SLICES, words)
    size = words // slices

    def gather(batches):
        index = index_vectors(words, dimensions)
        number = _numbered(words)
        total = np.zeros((words, dimensions), np.float64)
        any_row = False
        for batch in batches:
            for _, texts in chunks(batch.column(0), 1 << 19):
                any_row = True
                runs = [number(t) for t in texts]
                gap = np.full(REACH, words, np.int64)  # documents are no context of each other
                line = np.concatenate([gap, *(part for run in runs for part in (run, gap))])
                real = line < words
                vectors = np.zeros((len(line), dimensions), np.float32)
                vectors[real] = index[line[real]]
                around = np.zeros_like(vectors)
                for step in range(1, REACH + 1):
                    around[step:] += vectors[:-step]
                    around[:-step] += vectors[step:]
                order = np.argsort(line[real], kind="stable")
                rows = line[real][order]
                if len(rows):
                    at = np.flatnonzero(np.diff(rows, prepend=-1))
                    total[rows[at]] += np.add.reduceat(around[real][order], at, axis=0, dtype=np.float64)
        if any_row:
            for part in range(slices):
                block = total[part * size : (part + 1) * size]
                if block.any():
                    # The sums are whole numbers.
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([block.ravel().astype(np.int64).tobytes()])],
                        ["slice", "sums"],
                    )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = np.frombuffer(raw.as_buffer(), np.int64)
                sums[part] = sums[part] + block if part in sums else block
        for part, block in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block.tobytes()])], ["slice", "sums"]
            )

    schema = "slice int, sums binary"
    parts = picked.mapInArrow(gather, schema).repartition(slices, "slice").mapInArrow(add, schema).collect()
    total = np.zeros((words, dimensions))
    for row in parts:
        total[row.slice * size : (row.slice + 1) * size] = np.frombuffer(row.sums, np.int64).reshape(-1, dimensions)
    length = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.where(length > 0, length, 1)).astype(np.float32)


def pool(numbers: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A document's features: mean and spread of its word vectors, and two logarithmic sizes."""
    out = np.zeros(2 * vectors.shape[1] + 2, np.float32)
    if len(numbers):
        found, counts = np.unique(numbers, return_counts=True)
        weights = (counts / len(numbers)).astype(np.float32)
        own = vectors[found]
        mean = weights @ own
        out[: len(mean)] = mean
        out[len(mean) : -2] = np.sqrt(np.maximum(weights @ (own * own) - mean * mean, 0))
        out[-2:] = np.log1p(len(numbers)) / 10, np.log1p(len(found)) / 10
    return out


@dataclass(frozen=True)
class Network:
    """Scaling of features, two layers and the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float
    prior: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh(((x - self.mean) / self.scale) @ self.hidden + self.hidden_bias)
        return (z @ self.out + self.out_bias).astype(np.float64)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        if self.prior is not None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def train(x: np.ndarray, y: np.ndarray, calibration: np.ndarray, seed: int = SEED, epochs: int = 30) -> Network:
    """Fit the network on rows that are not ``calibration`` and its temperature on those that are.

    Without both labels to learn from there is nothing to tell apart: the score is then the share of
    label 1, or a half without any labels.
    """
    fit = ~calibration
    if len(set(y[fit].tolist())) < 2:
        empty = np.zeros(0, np.float32)
        return Network(empty, empty, empty, empty, empty, 0.0, 1.0, float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    inputs, labels = ((x[fit] - mean) / scale).astype(np.float32), y[fit].astype(np.float32)
    size = inputs.shape[1]
    params = [
        rng.normal(0, 1 / np.sqrt(size), (size, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32),
        np.zeros(1, np.float32),
    ]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(inputs))
        for low in range(0, len(order), 128):
            rows = order[low : low + 128]
            z = np.tanh(inputs[rows] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(z @ params[2] + params[3], -30, 30)))
            error = (p - labels[rows]) / len(rows)
            back = error[:, None] * params[2] * (1 - z * z)
            slopes = [inputs[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), z.T @ error, error.sum(keepdims=True)]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                params[k] -= 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, *params[:3], float(params[3][0]), 1.0)
    if calibration.any():
        logits, truth = network.logits(x[calibration]), y[calibration]

        def loss(temperature):
            signed = np.where(truth == 1, logits, -logits) / temperature
            return np.logaddexp(0, -signed).mean()

        best = min(np.geomspace(0.25, 20, 120), key=loss)
        network = Network(mean, scale, *params[:3], float(params[3][0]), float(best))
    return network


@dataclass(frozen=True)
class QualityModel:
    vectors: np.ndarray
    network: Network

    def scores(self, texts: list[str]) -> np.ndarray:
        number = _numbered(len(self.vectors))
        return self.network.scores(np.stack([pool(number(t), self.vectors) for t in texts]))


def held_out(key: str = "doc_id"):
    """True for keys that are never learnt from: crc32 of the key as text is divisible by 5."""
    return F.coalesce(F.crc32(column(key).cast("string")) % 5 == 0, F.lit(False))


def fit(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> QualityModel:
    """Learn the quality of texts from ``labels`` (``key``, ``label`` 0 or 1).

    Word vectors come from all documents. The network learns from at most ``sample`` rows with labelled keys
    that are not held out: at most as many keys, in the order of a hash of the key, and of their rows those
    with the smallest hash of key and text. A fifth of them sets the temperature. Null keys and labels teach
    nothing. A key with several labels or rows counts with each, within that bound.
    """
    spark = df.sparkSession
    vectors = word_vectors(df, text)
    usable = (
        labels.select(column(key).alias("key"), column(label).cast("int").alias("label"))
        .where(~held_out("key") & F.col("key").isNotNull() & F.col("label").isin(0, 1))
        .distinct()
    )
    chosen = hash_sample(usable, ["key", "label"], sample)
    # At most ``sample`` rows of two numbers.
    texts = df.select(column(key).alias("key"), column(text).alias("text")).join(F.broadcast(chosen), "key")
    # A key may have any number of rows; those far above the bound are left out before their features are made.
    share = 4 * sample / max(1, texts.count())
    mark = F.xxhash64("key", "text")
    if share < 1:
        texts = texts.where(mark < int(share * 2.0**64) - (1 << 63))
    shared = spark.sparkContext.broadcast(vectors)

    def features(batch):
        number = _numbered(len(shared.value))
        for start, run in chunks(batch.column(1)):
            rows = [pool(number(t), shared.value).tobytes() for t in run]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, len(run)).cast(pa.int64()),
                    batch.column(2).slice(start, len(run)),
                    batch.column(3).slice(start, len(run)),
                    pa.array(rows, pa.binary()),
                ],
                ["key", "label", "mark", "x"],
            )

    schema = "key bigint, label int, mark bigint, x binary"
    made = map_batches(texts.select("key", "text", "label", mark.alias("mark")), features, schema)
    found = made.orderBy("mark", "key", "label", "x").limit(sample).collect()
    found.sort(key=lambda r: (zlib.crc32(b"%d" % r.key), r.key, r.label, r.x))
    size = 2 * vectors.shape[1] + 2
    x = np.frombuffer(b"".join(bytes(r.x) for r in found), np.float32).reshape(-1, size)
    y = np.asarray([r.label for r in found], np.int64)
    calibration = np.asarray([zlib.crc32(b"calibration %d" % r.key) % 5 == 0 for r in found], bool)
    return QualityModel(vectors, train(x, y, calibration))


def score(df: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 of every whole text, 0 to 1; null texts count as empty.

    A column ``out`` that is already there is replaced, every other one is kept.
    """
    from pyspark.sql.types import StructType

    kept = df.drop(out)
    at = kept.columns.index(text)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        for start, texts in chunks(batch.column(at)):
            own = batch.slice(start, len(texts))
            values = pa.array(shared.value.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*own.columns, values], [*own.schema.names, out])

    return map_batches(kept, run, StructType([*kept.schema.fields, *StructType.fromDDL(f"`{out}` double").fields]))
