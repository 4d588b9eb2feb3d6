import pytest

LONG_LINE = " ".join(f"word{k % 977}x{k % 31}" for k in range(6000))
LONG_WORD = "abcdefghij" * 2000
EDGE = [
    (1, "One plain line of text that goes on for a while.\nAnother line, quite short.", "en", "a"),
    (1, "One plain line of text that goes on for a while.\nAnother line, quite short.", "en", "a"),  # repeated row
    (2, "One plain line of text that goes on for a while.\nAnother line, quite short.", "en", "a"),  # the same text
    (1, "The same id with another text, 42 words it has not.", "en", "b"),
    (3, None, "en", "a"),
    (4, "", None, "a"),
    (5, " \t\n \x0b\f\r ", "de", None),
    (6, "!!! ??? ...\n---", None, None),
    (7, LONG_LINE, "en", "a"),
    (8, LONG_WORD, "en", "a"),
    (9, "Ünï ①　x 😀 日本語 <|endoftext|> <s> </s> ▁▁ a  b", "ja", "a"),
    (None, "A row without an id; it still counts.", "en", "a"),
    (None, None, None, None),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows; extra columns named like an operator's own."""
    rows = [(*r, len(r[1] or ""), k, "x", 1.5, [k]) for k, r in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long, "
                                       "node string, `key_id` double, `a.b` array<int>").repartition(3)


@pytest.fixture(scope="session")
def empty(edge, spark):
    return spark.createDataFrame([], edge.schema)


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
