import pytest

from millrace.llm.common import show_workers


@pytest.fixture(autouse=True)
def workers(spark):
    show_workers(spark)


@pytest.fixture
def docs(spark):
    """Documents as rows of id and text, with other columns and names that operators use themselves."""

    def make(rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, _rank int"
        return spark.createDataFrame(
            [(key, text, "en", "src0", len(text or ""), "mine", 1) for key, text in rows], schema
        ).repartition(3)

    return make


ODD = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "\n\n"),
    (5, "the the the"),
    (5, "the the the"),
    (6, "One line of text, long enough to count.\nOne line of text, long enough to count."),
    (7, "word " * 30_000),
    (8, "x" * 50_000),
    (9, "日本語 é ▁ 😀\t<s>\u0000 <|endoftext|>\r\n  a"),
    (None, "a row without any key, and with a text"),
    (None, None),
]
