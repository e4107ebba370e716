"""Small document tables with the odd rows that every operator must take."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(texts):
    return [(i, t, "en", "s", len(t) if t is not None else None) for i, t in texts]


LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(30000))
ODD = [
    (None, "a row without an id that says the same as others do, word for word and line for line"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, LONG),
    (6, "Twice the same row is here, and it counts as two rows of one text in every table."),
    (6, "Twice the same row is here, and it counts as two rows of one text in every table."),
    (7, "Ünïcödé wörds, 日本語 テキスト and emoji 😀 <|endoftext|> with  two spaces\r\nand lines\n\n."),
    (8, "a b c d e a b c d e a b c d e a b c d e"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows_of(ODD), SCHEMA)
    return df.withColumns({c: F.lit("x") for c in ("lot", "key", "row", "shard", "n_words", "length", "part", "bucket", "_kind", "_doc", "_text", "node", "hits", "n_bytes")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
