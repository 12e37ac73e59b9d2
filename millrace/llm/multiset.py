"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs, in SQL functions only.

A paragraph, a line that is not empty, hashes to a wide vector of two parts: eight lanes of its
SHA-256, and 64 lanes that count its sentences by hash. A text's fingerprint is the sum of its
paragraphs' vectors, modulo 2**32 in the first part and 2**16 in the second. So it does not depend on
the order of paragraphs, and adding or taking away a paragraph is adding or subtracting its vector.
Equal fingerprints mean equal paragraphs with their multiplicities (up to a collision of the sums);
the correlation of the second parts tells how much two texts have in common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import column, numbered

DENSE, COUNTED = 8, 64
DENSE_MODULUS, COUNTED_MODULUS = 1 << 32, 1 << 16
# Documents in a range of keys that is ordered in one task. The bounds of ranges are numbers on the driver, so there
# are at most MOST_RANGES; with more rows, ranges get larger, and a task sorts its range with spills.
ROWS_IN_RANGE, MOST_RANGES = 2_000, 1 << 17
# Sampled keys for each bound, and how much larger than intended the range of a single key may be.
SAMPLED, UNEVEN = 20, 4
# Texts of one key are dealt to tasks by their first characters, and equal results written out in blocks.
DEALT_CHARS, BLOCK = 256, 10_000


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda p: p != "")


def vector(parts: Column) -> Column:
    """Sum of the wide vectors of an array of paragraphs, as ``array<bigint>``."""
    none = F.array_repeat(F.lit(0).cast("bigint"), DENSE)
    empty = F.array_repeat(F.lit(0).cast("bigint"), COUNTED)
    places = F.array(*[F.lit(1 + 8 * k) for k in range(DENSE)])

    # What a lambda uses more than once is handed to it as an element, so that it is computed once.
    def lanes(digest: Column) -> Column:
        return F.transform(places, lambda at: _number(F.substr(digest, at, F.lit(8))))

    dense = F.aggregate(
        F.transform(parts, lambda p: F.sha2(p, 256)),
        none,
        lambda total, digest: F.zip_with(total, lanes(digest), lambda a, b: (a + b) % DENSE_MODULUS),
    )
    sentences = F.flatten(F.transform(parts, lambda p: F.split(p, "\\. ", -1)))
    counted = F.aggregate(
        F.transform(sentences, lambda s: _number(F.substr(F.md5(s), F.lit(1), F.lit(2))) % COUNTED),
        empty,
        lambda total, lane: F.transform(
            total, lambda n, at: F.when(at == lane, (n + 1) % COUNTED_MODULUS).otherwise(n)
        ),
    )
    return F.concat(dense, counted)


def add(one: Column, other: Column) -> Column:
    """Fingerprint vector of two multisets of paragraphs together."""
    return _combine(one, other, lambda a, b: a + b)


def subtract(one: Column, other: Column) -> Column:
    """Fingerprint vector after the paragraphs of ``other`` are taken out of ``one``."""
    return _combine(one, other, lambda a, b: a - b)


def _combine(one: Column, other: Column, by) -> Column:
    def lanes(v: Column, first: int, size: int) -> Column:
        return F.slice(v, first, size)

    return F.concat(
        F.zip_with(lanes(one, 1, DENSE), lanes(other, 1, DENSE), lambda a, b: F.pmod(by(a, b), F.lit(DENSE_MODULUS))),
        F.zip_with(
            lanes(one, DENSE + 1, COUNTED),
            lanes(other, DENSE + 1, COUNTED),
            lambda a, b: F.pmod(by(a, b), F.lit(COUNTED_MODULUS)),
        ),
    )


def as_text(v: Column) -> Column:
    """A vector as lower-case hex digits: 8 for each of the first lanes, 4 for each of the others."""
    dense = F.transform(F.slice(v, 1, DENSE), lambda x: F.lpad(F.hex(x), 8, "0"))
    counted = F.transform(F.slice(v, DENSE + 1, COUNTED), lambda x: F.lpad(F.hex(x), 4, "0"))
    return F.lower(F.concat(F.array_join(dense, ""), F.array_join(counted, "")))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1: the correlation of the sentence counts, 1 for equal vectors, 0 where it is negative."""
    zero = F.lit(0).cast("bigint")

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda a, b: a + b)

    def sums(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        return F.struct(
            total(x).alias("sx"),
            total(y).alias("sy"),
            total(F.transform(x, lambda a: a * a)).alias("sxx"),
            total(F.transform(y, lambda a: a * a)).alias("syy"),
            total(F.zip_with(x, y, lambda a, b: a * b)).alias("sxy"),
        )

    def correlation(s: Column) -> Column:
        spread = F.sqrt(
            (COUNTED * s["sxx"] - s["sx"] * s["sx"]).cast("double")
            * (COUNTED * s["syy"] - s["sy"] * s["sy"]).cast("double")
        )
        value = (COUNTED * s["sxy"] - s["sx"] * s["sy"]).cast("double") / spread
        return F.when(spread > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))).otherwise(0.0)

    pair = F.struct(F.slice(one, DENSE + 1, COUNTED).alias("x"), F.slice(other, DENSE + 1, COUNTED).alias("y"))
    # Arrays of one element, so that each step is computed once.
    found = F.transform(F.transform(F.array(pair), sums), correlation)
    return F.when(one == other, 1.0).otherwise(F.get(found, F.lit(0)))


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each whole text as hex digits; a null text counts as empty, whose
    fingerprint is all zeros. A column ``out`` that is there is replaced."""
    return df.withColumn(out, as_text(vector(paragraphs(F.coalesce(column(text), F.lit(""))))))


def _ranges(df: DataFrame) -> tuple[Column, int]:
    """Number of the range of ``key`` that a row is in (0 for null, ascending), and the intended rows of one.

    The bounds are quantiles of a sample of the keys, which only says how rows are dealt to tasks. A key that
    several quantiles fall on has a range of its own. The range of a row is found by two short scans, first
    among the bounds of groups and then in the group.
    """
    rows = df.select(F.count("key")).first()[0]
    wanted = min(MOST_RANGES, -(-rows // ROWS_IN_RANGE))
    intended = max(ROWS_IN_RANGE, -(-rows // max(1, wanted)))
    key = F.col("key")
    bounds: list[int] = []
    if wanted > 1:
        shares = [k / wanted for k in range(1, wanted)]
        share = SAMPLED * wanted / rows
        keys = df.select("key").where(key.isNotNull())
        if share < 1:
            keys = keys.where(F.rand(7) < share)
        found = keys.select(F.percentile_approx("key", shares, max(10_000, 10 * wanted))).first()[0] or []
        alone = {k for k, after in zip(found, found[1:], strict=False) if k == after}
        bounds = sorted({*found, *(k + 1 for k in alone if k + 1 < 1 << 63)})
    if not bounds:
        return F.when(key.isNull(), 0).otherwise(1), intended
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[k : k + step] for k in range(0, len(bounds), step)]

    def array(values) -> Column:
        return F.lit([int(v) for v in values]).cast("array<bigint>")

    coarse = F.size(F.filter(array([g[0] for g in groups]), lambda b: b <= key))
    inner = F.array(*[array(g) for g in groups])
    fine = F.size(F.filter(F.get(inner, coarse - 1), lambda b: b <= key))
    number = F.when(coarse == 0, 1).otherwise(1 + step * (coarse - 1) + fine)
    return F.when(key.isNull(), 0).otherwise(number), intended


def _dealt(rows: DataFrame) -> tuple[DataFrame, list[int], list[tuple[int, int | None, int]]]:
    """``rows`` with their ``range``; the ranges of one key that are too large for one task; and for each
    range its number, its top key and the range that it comes after."""
    number, intended = _ranges(rows)
    rows = rows.withColumn("range", number)
    # Three numbers per range come to the driver, of which there are at most about MOST_RANGES.
    found = rows.groupBy("range").agg(F.max("key").alias("top"), F.min("key").alias("low"), F.count("*").alias("n"))
    found = sorted(found.collect(), reverse=True)
    hot = [r.range for r in found if r.top == r.low and r.n > UNEVEN * intended]
    return rows, hot, [(r.range, r.top, found[k - 1].range) for k, r in enumerate(found)]


def _hot_rows(rows: DataFrame) -> DataFrame:
    """Rows of hot keys with the text that follows in the key (``follower``, null after the last), one row for
    all ``copies`` of a text: copies follow each other, and the last one is followed by the next text.

    The texts are sorted and numbered in many tasks, and each is joined to the one with the next number.
    """
    texts = rows.groupBy("range", "key", "text").agg(F.count("*").alias("copies"))
    order = [F.col("range").desc(), F.col("text")]
    placed = numbered(texts, order, "place", [order[0], F.substring("text", 1, DEALT_CHARS)])
    after = placed.select("range", (F.col("place") - 1).alias("place"), F.col("text").alias("follower"))
    return placed.join(after, ["range", "place"], "left").drop("place")


def _repeated(df: DataFrame) -> DataFrame:
    """Each row of ``df`` as often as ``copies`` says, by blocks that are spread over tasks."""
    blocks = df.withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {BLOCK})")))
    times = F.least(F.lit(BLOCK), F.col("copies") - F.col("block") * BLOCK).cast("int")
    blocks = blocks.withColumn("times", times).drop("copies").repartition("edited_sha256", "block")
    return blocks.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("block", "times", "time")


def with_edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited form.

    The edited form replaces the last third (rounded down) of a text's code points by as many of the
    first ones of the next text, or all it has. Next is by descending key, and after the last the first;
    rows that repeat a key follow each other by text, rows with a null key come last, and an only row is
    its own next. Null texts count as empty. Per row: ``key``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``. Other columns are ignored.

    Rows are dealt by ranges of the key. The last row of a range gets the first one of the next range by
    a join with one text per range. Keys with more rows than a range should have, null included, are sorted
    by text over many tasks.
    """
    spark = df.sparkSession
    rows = df.select(column(key).cast("bigint").alias("key"), F.coalesce(column(text), F.lit("")).alias("text"))
    rows, hot, heads = _dealt(rows)
    heads = spark.createDataFrame(heads, "head int, top bigint, range int")
    texts = (
        rows.withColumnRenamed("range", "head")
        .join(F.broadcast(heads), "head")
        .where(F.col("key").eqNullSafe(F.col("top")))
        .groupBy("range")
        .agg(F.min("text").alias("over"))
    )
    order = Window.partitionBy("range").orderBy(F.col("key").desc_nulls_last(), "text")
    even = rows.where(~F.col("range").isin(hot)) if hot else rows
    follow = even.withColumn("follower", F.lead("text").over(order)).join(texts, "range", "left")
    result = _edited(follow.withColumn("next", F.coalesce("follower", "over")), key)
    if hot:
        own = _hot_rows(rows.where(F.col("range").isin(hot)))
        last = own.join(texts, "range", "left").withColumn("next", F.coalesce("follower", "over"))
        copies = own.where("copies > 1").withColumn("next", F.col("text")).withColumn("copies", F.col("copies") - 1)
        result = result.unionByName(_edited(last, key)).unionByName(_repeated(_edited(copies, key, "copies")))
    return result


def _edited(follow: DataFrame, key: str, *kept: str) -> DataFrame:
    """The columns of ``with_edited`` for rows of ``key``, ``text`` and the ``next`` text, and the columns ``kept``."""
    size = F.char_length("text")
    cut = F.floor(size / 3).cast("int")
    follow = follow.withColumn(
        "edited",
        F.concat(F.substr("text", F.lit(1), size - cut), F.substr("next", F.lit(1), cut)),
    )
    own, edited, other = (vector(paragraphs(F.col(c))) for c in ("text", "edited", "next"))
    return (
        follow.select(
            "key",
            size.cast("bigint").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            own.alias("own"),
            edited.alias("changed"),
            other.alias("other"),
            *kept,
        )
        .select(
            F.col("key").alias(key),
            "n_chars",
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("other")).alias("near_next"),
            *kept,
        )
    )
