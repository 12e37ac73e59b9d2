"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    lines,
    multiset,
    packing,
    pattern_packing,
    personal,
    pieces,
    quality,
    repair,
    resampling,
    simhash,
    token_files,
    topk,
    warc,
)
from millrace.llm.common import read_table, show_workers


def vocabulary(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_digests(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return personal.span_digests(docs, personal.fit(docs))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, names = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, folder, names)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.with_edited(read_table(spark, sf_dir, "documents"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_ids(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return token_files.read_ids(spark, files, digests=True).withColumnRenamed("key", "doc_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what line dedup found, and the digest of the text it leaves."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    left = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return lines.dedup_lines(docs).select("doc_id", "line_report.*", left)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.packed_texts(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampling.resample(documents, benchmark)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = repair.damage(read_table(spark, sf_dir, "conversations"))
    return repair.repair(damaged, times="times", with_rows=False)


def _query(function):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        show_workers(spark)
        return function(spark, sf_dir)

    return run


QUERIES = {
    "op1_topk_search": _query(op1_topk_search),
    "op2_sentencepiece": _query(op2_sentencepiece),
    "op3_personal_data": _query(op3_personal_data),
    "op4_warc": _query(op4_warc),
    "op5_simhash": _query(op5_simhash),
    "op6_quality": _query(op6_quality),
    "op7_fingerprints": _query(op7_fingerprints),
    "op8_token_ids": _query(op8_token_ids),
    "op9_line_dedup": _query(op9_line_dedup),
    "op10_packing": _query(op10_packing),
    "op11_pattern_packing": _query(op11_pattern_packing),
    "op12_resampling": _query(op12_resampling),
    "op13_conversation_repair": _query(op13_conversation_repair),
    "pipeline": _query(corpus_pipeline.run),
}

# Eight lanes of a paragraph's SHA-256 and 64 of its sentences, summed; see ``multiset``.
_VECTOR = """list_concat(
    list_transform(range(8), lambda k: CAST(coalesce(list_sum(list_transform(
        list_filter(string_split({text}, chr(10)), lambda p: p <> ''),
        lambda p: CAST('0x' || substr(sha256(p), CAST(1 + 8 * k AS INT), 8) AS BIGINT))), 0) % 4294967296 AS BIGINT)),
    list_transform(range(64), lambda k: CAST(len(list_filter(flatten(list_transform(
        list_filter(string_split({text}, chr(10)), lambda p: p <> ''), lambda p: string_split(p, '. '))),
        lambda s: CAST('0x' || substr(md5(s), 1, 2) AS BIGINT) % 64 = k)) % 65536 AS BIGINT)))"""
_HEX = """array_to_string(list_transform({v}, lambda x, i:
    lpad(lower(to_hex(x)), CASE WHEN i <= 8 THEN 8 ELSE 4 END, '0')), '')"""
_LIKE = """CASE WHEN {x} = {y} THEN 1.0::DOUBLE WHEN sqrt(({sxx}) * ({syy})) > 0 THEN least(1.0::DOUBLE,
    greatest(0.0::DOUBLE, CAST(64 * list_sum(list_transform(range(9, 73), lambda i: {x}[i] * {y}[i]))
    - list_sum({x}[9:72]) * list_sum({y}[9:72]) AS DOUBLE) / sqrt(({sxx}) * ({syy})))) ELSE 0.0::DOUBLE END"""
_SPREAD = "CAST(64 * list_sum(list_transform({v}[9:72], lambda a: a * a)) - list_sum({v}[9:72]) * list_sum({v}[9:72]) AS DOUBLE)"


# Repair: a weight is its cost in ten digits and its audit, so that the least string is the least weight.
def _edit(weight: str, edit: str, cost: str) -> str:
    return f"(lpad(CAST(CAST(substr({weight}, 1, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({weight}, 11) || '{edit}')"


def _keep(role: str, *weights: str) -> str:
    least = ", ".join(_edit(w, "K", "x.extra") for w in weights)
    return f"CASE WHEN x.must = 0 AND x.initial = '{role}' THEN least({least}) END"


def _rerole(*weights: str) -> str:
    return f"CASE WHEN x.must = 0 THEN least({', '.join(_edit(w, 'R', '2 + x.extra') for w in weights)}) END"


# A step of kind 1 or 2 lets a user or an assistant be inserted, one of kind 3 deals with a row.
_STEP = f"""CASE x.kind
    WHEN 1 THEN struct_pack(kind := 1, initial := '', must := 0, extra := 0, n := acc.n, s := acc.s,
        u := least(acc.u, {_edit("acc.n", "I", "2")}, {_edit("acc.s", "I", "2")}, {_edit("acc.a", "I", "2")}), a := acc.a)
    WHEN 2 THEN struct_pack(kind := 2, initial := '', must := 0, extra := 0, n := acc.n, s := acc.s, u := acc.u,
        a := least(acc.a, {_edit("acc.u", "I", "2")}))
    ELSE struct_pack(kind := 3, initial := '', must := 0, extra := 0, n := {_edit("acc.n", "D", "3")},
        s := least({_edit("acc.s", "D", "3")}, {_keep("s", "acc.n")}),
        u := least({_edit("acc.u", "D", "3")}, {_rerole("acc.n", "acc.s", "acc.a")}, {_keep("u", "acc.n", "acc.s", "acc.a")}),
        a := least({_edit("acc.a", "D", "3")}, {_rerole("acc.u")}, {_keep("a", "acc.u")}))
    END"""
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _like(x: str, y: str) -> str:
    return _LIKE.format(x=x, y=y, sxx=_SPREAD.format(v=x), syy=_SPREAD.format(v=y))


ORACLES = {
    "op1_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e,
                row_number() OVER () AS r FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank,
                vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op4_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p
        )
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(1 + ((CAST('0x' || substr(sha, CAST((i // 4) * 5 + 1 AS INT), 5) AS BIGINT)
                    >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS INT), 1)), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM f
    """,
    "op7_fingerprints": f"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
        ), follow AS (
            SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC, text),
                first_value(text) OVER (ORDER BY doc_id DESC, text)) AS next FROM d
        ), edited AS (
            SELECT *, substr(text, 1, CAST(n - n // 3 AS INT)) || substr(next, 1, CAST(n // 3 AS INT)) AS edited FROM follow
        ), v AS (
            SELECT doc_id, n, edited, {_VECTOR.format(text="text")} AS x, {_VECTOR.format(text="edited")} AS y,
                {_VECTOR.format(text="next")} AS z FROM edited
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
            {_HEX.format(v="x")} AS fingerprint, {_HEX.format(v="y")} AS edited_fingerprint,
            {_like("x", "y")} AS near_edited, {_like("x", "z")} AS near_next
        FROM v
    """,
    "op12_resampling": """
        WITH t AS (
            SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
        ), words AS (
            SELECT true AS source, doc_id, row_number() OVER () AS n, text FROM documents
            UNION ALL SELECT false, NULL, row_number() OVER (), text FROM benchmark
        ), split AS (
            SELECT source, doc_id, n, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM words
        ), features AS (
            SELECT source, n, unnest(list_concat(w, list_transform(range(1, len(w)),
                lambda k: w[k] || ' ' || w[k + 1]))) AS feature FROM split
        ), counted AS (
            SELECT source, n, feature, count(*) AS times FROM features GROUP BY ALL
        ), coded AS (
            SELECT feature, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(feature))),
                lambda k: CAST('0x' || substr(hex(encode(feature)), CAST(2 * k + 1 AS INT), 2) AS BIGINT))),
                lambda c, b: xor(c >> 8, crc[CAST(1 + (xor(c, b) & 255) AS INT)]))) % 10000 AS bucket
            FROM (SELECT DISTINCT feature FROM counted), t
        ), found AS (
            SELECT source, n, bucket, times FROM counted JOIN coded USING (feature)
        ), sums AS (
            SELECT k AS bucket, coalesce(sum(times) FILTER (source), 0) AS s, coalesce(sum(times) FILTER (NOT source), 0) AS t
            FROM range(10000) r(k) LEFT JOIN found ON bucket = k GROUP BY k
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM sums
        ), weights AS (
            SELECT n, CAST(sum(gain * times) AS BIGINT) AS total FROM found JOIN gains USING (bucket) WHERE source GROUP BY n
        ), noise AS (
            SELECT doc_id, n, len(w) AS words, CAST(greatest(2 * len(w) - 1, 0) AS BIGINT) AS n_features,
                CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
            FROM split WHERE source
        ), scored AS (
            SELECT doc_id, words, n_features, CASE WHEN n_features = 0 THEN 0
                ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
                weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM noise LEFT JOIN weights USING (n)
        ), ranks AS (
            SELECT *, words >= 20 AS may, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
                count(*) FILTER (words >= 20) OVER () * 25 // 100 AS keep FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= keep THEN place END AS rank FROM ranks
    """,
    "op13_conversation_repair": f"""
        WITH t AS (
            SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
        ), named AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations
        ), kinds AS (
            SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(place, ''),
                lambda c: CAST(unicode(c) AS BIGINT))), lambda c, b: xor(c >> 8, crc[CAST(1 + (xor(c, b) & 255) AS INT)]))) % 20 AS kind
            FROM named, t
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM (SELECT *, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) FROM kinds)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
                rtrim(text, {_WHITE}) AS bare FROM damaged
        ), faults AS (
            SELECT *, left(role, 1) AS initial, CASE WHEN bare = '' THEN 1
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 2
                WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM placed
        ), counted AS (
            SELECT conv_id, coalesce(max(CAST(turn AS HUGEINT)) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                count(*) FILTER (fault = 3) AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
                list(struct_pack(role := role, text := text, initial := initial) ORDER BY p) AS lines,
                flatten(list([struct_pack(kind := 1, initial := '', must := 0, extra := 0, n := '', s := '', u := '', a := ''),
                    struct_pack(kind := 2, initial := '', must := 0, extra := 0, n := '', s := '', u := '', a := ''),
                    struct_pack(kind := 3, initial := initial, must := CAST(fault IN (1, 2) AS INT),
                        extra := CAST(fault = 3 AS INT), n := '', s := '', u := '', a := '')] ORDER BY p)) AS steps
            FROM faults GROUP BY conv_id
        ), solved AS (
            SELECT *, list_reduce(list_concat(steps, [steps[1], steps[2]]), lambda acc, x: {_STEP},
                struct_pack(kind := 0, initial := '', must := 0, extra := 0, n := repeat('0', 10),
                    s := CAST(NULL AS VARCHAR), u := CAST(NULL AS VARCHAR), a := CAST(NULL AS VARCHAR))) AS w FROM counted
        ), best AS (
            SELECT *, least(w.n, w.a) AS weight, substr(least(w.n, w.a), 11) AS audit FROM solved
        ), walked AS (
            SELECT *, list_reduce(list_transform(string_split(audit, ''), lambda e: struct_pack(e := e, p := 1, last := '', text := '')),
                lambda acc, x: struct_pack(e := '', p := acc.p + CAST(x.e <> 'I' AS INT),
                    last := CASE WHEN x.e = 'D' THEN acc.last WHEN x.e = 'K' THEN lines[acc.p].initial
                        WHEN acc.last = 'u' THEN 'a' ELSE 'u' END,
                    text := acc.text || CASE WHEN x.e = 'D' THEN '' ELSE chr(10)
                        || CASE WHEN x.e = 'K' THEN lines[acc.p].role WHEN acc.last = 'u' THEN 'assistant' ELSE 'user' END
                        || ':' || CASE WHEN x.e = 'I' THEN '' ELSE lines[acc.p].text END END),
                struct_pack(e := '', p := 1, last := '', text := '')) AS walk FROM best
        )
        SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
            coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            CAST(coalesce(substr(weight, 1, 10), '0') AS BIGINT) AS cost, coalesce(audit, '') AS audit,
            sha256(coalesce(substr(walk.text, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN walked w ON o.conv_id IS NOT DISTINCT FROM w.conv_id
    """,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
