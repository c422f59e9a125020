"""Rows that every operator has to bear."""

import pytest

LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))

EDGE = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta.", "en", "a", 46),
    (2, "Alpha  beta gamma\tdelta epsilon zeta eta theta.", "en", "a", 47),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n ", "fr", "b", 4),
    (6, "Alpha beta gamma delta epsilon zeta eta theta.", None, None, 46),
    (6, "Alpha beta gamma delta epsilon zeta eta theta.", None, None, 46),
    (None, "a row without an id, kept all the same", "en", "c", 38),
    (7, "Größe, çédille — ▁   　 \U0001f600 日本語 <s> </s> <unk> <|endoftext|>", "de", "c", 60),
    (8, LONG, "en", "a", len(LONG)),
    (9, "1234 5678 !!! ???", "es", "d", 17),
    (10, "zzz", "es", "d", 3),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(EDGE, schema)


@pytest.fixture(scope="session")
def clashing_docs(edge_docs):
    """The same with columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    return edge_docs.withColumns(
        {name: F.lit(7) for name in ("digest", "size", "sid", "n", "bucket", "_text", "kept", "target", "block", "key")}
    )
