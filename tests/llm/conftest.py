import pytest

#: Further columns whose names the operators use themselves.
CLASHING = "id long, row long, n long, node long, size long, weight double, words string, rows string, shard int, kind int, draw long, target double"
LONG = " ".join(f"word{i % 977} x{i}" for i in range(40_000)) + " mit license " + "y" * 50_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, a null id, and columns with clashing names."""
    texts = [
        (1, "The MIT  License\tand more: licensed under the Apache License, Version 2.0.", "a"),
        (2, None, "a"), (3, "", None), (4, "one two", "b"), (4, "one two", "b"), (None, "one two", "b"), (5, LONG, "b"),
        (6, "Été à Zürich 中文 🙂 <|endoftext|> </s>\n\n  end ", None), (7, " \t\n", "c"), (8, "a" * 3000, "c"), (9, "ONE TWO", "a"),
        (10, "x\u00a0y\u2003z\x1cq\x00w ▁▁ a", "a"), (11, LONG, "c"), (12, LONG + " tail", "a"),
    ]
    rows = [(i, t, s, 7, 7, 7, 7, 7, 0.5, "w", "r", 1, 1, 7, 0.5) for i, t, s in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {CLASHING}")


@pytest.fixture
def empty_docs(odd_docs):
    return odd_docs.limit(0)


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
