import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from texts or (doc_id, text) pairs, with columns whose names clash with the operators' own."""

    def build(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], SCHEMA)
        return df.selectExpr("*", "'x' AS score", "1 AS n", "'k' AS key", "0 AS label", "'w' AS words", "2 AS part")

    return build


#: Nulls, empty and very long texts, ties and repeated rows; what every operator must take.
HARD = [
    (1, None), (2, ""), (3, "word"), (4, "word"), (4, "word"), (None, "nobody's text here"), (None, None),
    (5, "the quick brown fox jumps over the lazy dog " * 3000), (6, "a" * 50_000), (7, " \n\t  \x0b"),
    (8, "1 2 3 4 5 6 7 8 9 " * 2000), (9, "The Quick brown fox"), (10, "the quick brown fox"), (11, "é ü 日本 🙂\r\n\r\nx"),
]


@pytest.fixture(scope="session")
def hard():
    return HARD


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 0, 0), (3, 1, None), (4, 1, 1), (4, 1, 1), (None, 1, 1), (9, 0, 1)], "doc_id long, quality int, toxic int"
    )
