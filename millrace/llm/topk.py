"""Exact top-k search by inner product with a pivot-distance index.

Vectors of whole numbers get one more coordinate that gives them all the same length, so that the
largest inner products are the smallest distances. Each vector is keyed by its nearest pivot and the
distance from it; the distances about a pivot are cut into annuli. By the triangle inequality no vector
of an annulus is nearer to a query than the query's distance from the pivot lies outside the annulus'
range, so a query visits annuli in the order of that bound and stops when it excludes the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import column, hash_sample
from millrace.workspace import written

TOP, SCALE, EVERY = 5, 256, 50
# Pivots are chosen from at most so many vectors, by order of a hash of the id.
SAMPLE, PIVOTS, ANNULI = 4_096, 16, 8
# Vectors of an annulus that a task compares at once; larger annuli are split into such tiles.
TILE = 8_192
# Annuli that a query visits in the first rounds; the last round visits all that are left.
ROUNDS = (2, 8)


def whole_numbers(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``row`` (a number that no two rows share), ``id`` and ``v`` (``array<double>``, floor of ``scale`` times
    each component, taken as double).

    Left out: null ids, null vectors, and those with a component that is null or not finite.
    """
    scaled = F.transform(column(vector), lambda x: x.cast("double") * scale)
    # From 2**52 on a double is a whole number, and beyond 2**63 its floor would not be a long.
    parts = F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    sound = F.forall(
        column(vector),
        lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")), F.lit(False)),
    )
    rows = df.where(column(key).isNotNull() & column(vector).isNotNull()).where(sound)
    return rows.select(F.monotonically_increasing_id().alias("row"), column(key).cast("bigint").alias("id"), parts.alias("v"))


def _matrix(rows: pa.Array, size: int) -> np.ndarray:
    """Vectors of an Arrow list column, filled up with zeros."""
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == size).all():
        return flat.reshape(len(rows), size)
    out = np.zeros((len(rows), size))
    starts = np.cumsum(lengths) - lengths
    at = np.arange(len(flat)) - np.repeat(starts, lengths)
    out[np.repeat(np.arange(len(rows)), lengths), at] = flat
    return out


def products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in floating point as long as every partial sum stays below 2**53,
    else as whole numbers of any size."""
    size = max(1, one.shape[1])
    most = float(np.abs(one).max(initial=0)) * float(np.abs(other).max(initial=0)) * size
    if most < 2.0**53:
        return (one @ other.T).astype(np.int64)
    if not (np.isfinite(one).all() and np.isfinite(other).all()):
        raise OverflowError("a component is beyond all numbers when scaled")
    whole = np.frompyfunc(int, 1, 1)
    return whole(one).astype(object) @ whole(other).astype(object).T


def best_of(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, own: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best candidates, all but the query's ``own`` row; a best score must be a long."""
    keep = rows != own
    ids, scores = ids[keep], scores[keep]
    if scores.dtype == object:
        order = sorted(range(len(ids)), key=lambda k: (-scores[k], ids[k]))[:top]
        if any(not -(1 << 63) <= scores[k] < 1 << 63 for k in order):
            raise OverflowError("a score is no long")
        return ids[order], scores[order].astype(np.int64)
    if len(ids) > top:
        bar = np.partition(scores, -top)[-top]
        ids, scores = ids[scores >= bar], scores[scores >= bar]
    order = np.lexsort((ids, -scores))[:top]
    return ids[order], scores[order]


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots from a sample: the farthest from those before it, from the first on."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen = [0]
    gaps = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < count and gaps.max() > 0:
        chosen.append(int(gaps.argmax()))
        gaps = np.minimum(gaps, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def _lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the coordinate that makes all of them as long as the longest."""
    return np.column_stack([v, np.sqrt(np.maximum(longest - (v * v).sum(axis=1), 0))])


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (point, pivot) from the differences themselves, a block of points at a time."""
    out = np.empty((len(points), len(pivots)))
    for k in range(0, len(points), 512):
        out[k : k + 512] = np.linalg.norm(points[k : k + 512, None, :] - pivots[None], axis=2)
    return out


def search(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    top: int = TOP,
    every: int = EVERY,
    scale: int = SCALE,
    pivots: int = PIVOTS,
    annuli: int = ANNULI,
    tile: int = TILE,
) -> DataFrame:
    """The ``top`` largest inner products of each query with all other vectors.

    Queries are the rows whose id is divisible by ``every``. Per query and rank from 1: ``query_id``,
    ``rank`` (int), ``vec_id`` and ``score`` (long), ties to the smaller id; fewer ranks if there are fewer
    vectors. Which rows take part, see ``whole_numbers``; shorter vectors are filled up with zeros to the
    longest. Rows that repeat an id are candidates, and queries, each by itself; a row is no candidate of its
    own only. Products are exact, and a score beyond a long is an error. Of equal vectors only the top + 1
    smallest ids are indexed, as no others can be among the best. An empty table, or a single vector, gives no
    rows. Columns other than key and vector are ignored.
    """
    spark = df.sparkSession
    vectors = written(whole_numbers(df, key, vector, scale), "topk-vectors")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = F.array_max(F.transform("v", F.abs))
    most = vectors.agg(F.max(F.size("v")).alias("size"), F.max(length).alias("longest"), F.max(largest).alias("largest")).first()
    size, longest, unit = most["size"] or 0, float(most["longest"] or 0), 1.0
    if longest > 1e290:  # distances are taken of smaller vectors, lest their squares overflow
        unit, longest = 1 / (most["largest"] * max(1, size)), 1.0
    sample = hash_sample(vectors, ["id", "row"], SAMPLE).select("v").toArrow()["v"].combine_chunks()
    centres = choose_pivots(_lifted(_matrix(sample, size) * unit, longest), pivots)
    # Rounding of the distances, and of squares of them, stays far below this.
    slack = 1e-9 * (1 + longest)
    reach = float(np.sqrt(longest)) * 2 + 1
    width = reach / annuli / 2

    def place(batches):
        for batch in batches:
            gaps = _distances(_lifted(_matrix(batch.column(2), size) * unit, longest), centres)
            nearest = gaps.argmin(axis=1)
            gap = gaps[np.arange(len(gaps)), nearest]
            ring = (gap / width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(ring), pa.array(gap)],
                ["row", "id", "v", "pivot", "ring", "gap"],
            )

    same = Window.partitionBy("v").orderBy("id", "row")
    distinct = vectors.withColumn("n", F.row_number().over(same)).where(F.col("n") <= top + 1).drop("n")
    index = written(
        distinct.select("row", "id", "v").mapInArrow(
            place, "row bigint, id bigint, v array<double>, pivot int, ring int, gap double"
        ),
        "topk-index",
    )
    # One row per annulus, at most 2 * pivots * (annuli + 1).
    found = (
        index.groupBy("pivot", "ring")
        .agg(F.min("gap").alias("low"), F.max("gap").alias("high"), F.count("*").alias("n"))
        .orderBy("pivot", "ring")
        .collect()
    )
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    owner = np.asarray([r.pivot for r in found])
    low, high = np.asarray([r.low for r in found]), np.asarray([r.high for r in found])
    tiles = [max(1, -(-r.n // tile)) for r in found]
    numbers = spark.createDataFrame(
        [(r.pivot, r.ring, k, tiles[k]) for k, r in enumerate(found)], "pivot int, ring int, annulus int, tiles int"
    )
    members = written(
        index.join(F.broadcast(numbers), ["pivot", "ring"]).select(
            "annulus", F.pmod(F.xxhash64("id", "row"), F.col("tiles")).cast("int").alias("tile"), "row", "id", "v"
        ),
        "topk-members",
    )

    def visits(first: int, last: int | None):
        """Annuli to visit in a round: those from ``first`` to ``last`` in the order of their bound, unless
        the bound excludes them."""

        def run(batches):
            for batch in batches:
                v = _matrix(batch.column(2), size) * unit
                squares = (v * v).sum(axis=1)
                # The query's own extra coordinate is zero.
                gaps = _distances(np.column_stack([v, np.zeros(len(v))]), centres)[:, owner]
                bound = np.maximum(np.maximum(gaps - high, low - gaps), 0)
                ceiling = (squares[:, None] + longest - bound * bound) / 2
                ceiling += slack * 4 + 1e-6 * np.abs(ceiling)
                with np.errstate(over="ignore"):
                    ceiling = ceiling / unit / unit
                order = np.argsort(bound, axis=1, kind="stable")[:, first:last]
                best = batch.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
                best = np.where(np.isnan(best), -np.inf, best)
                wanted = np.take_along_axis(ceiling, order, axis=1) >= best[:, None]
                rows, at = np.nonzero(wanted)
                annulus = order[rows, at]
                for k in range(0, len(rows), 4_096):
                    own = batch.take(pa.array(rows[k : k + 4_096]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(annulus[k : k + 4_096].astype(np.int32)), *own.columns[:3]],
                        ["annulus", "row", "id", "v"],
                    )

        return run

    def compare(batches):
        group, parts, held = None, [], None

        for batch in batches:
            if not batch.num_rows:
                continue
            annulus, tile_number = (batch.column(k).to_numpy() for k in (0, 1))
            query = batch.column(2).to_numpy(zero_copy_only=False)
            change = (np.diff(annulus) != 0) | (np.diff(tile_number) != 0) | (np.diff(query.astype(np.int8)) != 0)
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            out: list[tuple[np.ndarray, ...]] = []
            for a, b in zip(edges, edges[1:], strict=False):
                here = int(annulus[a]), int(tile_number[a])
                if here != group:
                    group, parts, held = here, [], None
                rows, ids = (batch.column(k).slice(a, b - a).to_numpy() for k in (3, 4))
                v = _matrix(batch.column(5).slice(a, b - a), size)
                if not query[a]:
                    parts.append((rows, ids, v))
                    continue
                if held is None:
                    if not parts:
                        continue
                    held = tuple(np.concatenate([p[k] for p in parts]) for k in range(3))
                for k in range(0, len(ids), 256):
                    scores = products(v[k : k + 256], held[2])
                    for at, (own, number) in enumerate(zip(ids[k : k + 256].tolist(), rows[k : k + 256].tolist(), strict=True)):
                        near, score = best_of(held[0], held[1], scores[at], number, top)
                        out.append((np.full(len(near), number), np.full(len(near), own), near, score))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([o[k] for o in out])) for k in range(4)],
                    ["query_row", "query_id", "vec_id", "score"],
                )

    queries = written(vectors.where(F.col("id") % every == 0).select("row", "id", "v"), "topk-queries")
    ranked = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    best = spark.createDataFrame([], "query_row bigint, query_id bigint, rank int, vec_id bigint, score bigint")
    spans = [0, *[k for k in ROUNDS if k < len(found)], None]
    for first, last in zip(spans, spans[1:], strict=False):
        bars = best.where(F.col("rank") == top).select(F.col("query_row").alias("row"), F.col("score").alias("bar"))
        asked = queries.join(bars, "row", "left").select("row", "id", "v", "bar")
        asked = asked.mapInArrow(visits(first, last), "annulus int, row bigint, id bigint, v array<double>")
        asked = asked.join(F.broadcast(numbers.select("annulus", "tiles")), "annulus").withColumn(
            "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        )
        both = members.select("annulus", "tile", F.lit(False).alias("query"), "row", "id", "v").union(
            asked.select("annulus", "tile", F.lit(True).alias("query"), "row", "id", "v")
        )
        scored = (
            both.repartition("annulus", "tile")
            .sortWithinPartitions("annulus", "tile", "query")
            .mapInArrow(compare, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
        )
        merged = best.select("query_row", "query_id", "vec_id", "score").union(scored)
        merged = merged.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
        best = written(merged.select("query_row", "query_id", F.col("rank").cast("int"), "vec_id", "score"), "topk-best")
    return best.drop("query_row")
