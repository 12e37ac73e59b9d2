"""A training corpus from the documents table, in five stages.

Each stage takes what its predecessor kept and returns a DataFrame that is written and read again before
the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import lines, packing, personal, quality, simhash
from millrace.llm.common import column, free_name, read_table, show_workers
from millrace.workspace import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below the threshold go.

    Learns from the labels of the documents it is given; without any labels all score a half and stay.
    """
    show_workers(spark)
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return quality.score(docs, model, out=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: repeated and nearly repeated lines go, all but the first; ``n_chars`` follows the text."""
    show_workers(spark)
    report = free_name(docs, "_report")
    left = lines.dedup_lines(docs, report=report, with_class=False)
    if "n_chars" in docs.columns:
        size = F.char_length(column("text")).cast(docs.schema["n_chars"].dataType)
        changed = F.col(f"{report}.n_removed") > 0
        left = left.withColumn("n_chars", F.when(changed, size).otherwise(column("n_chars")))
    return left.drop(report)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each component stays, the one with the smallest doc_id."""
    show_workers(spark)
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span is replaced by its kind; ``n_chars`` follows the text."""
    show_workers(spark)
    return personal.mask(docs, personal.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the batch and the place in it of every document that is left."""
    show_workers(spark)
    import public_tokenizers

    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("packing", pack),
]

# SQL has no trained classifier, SimHash, tokenizer or dynamic programming; tests hold each stage
# against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
