import pytest


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long
    text, and extra columns whose names clash with results."""
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta", "en", "s", 10, 0.5, "x"),
            (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "s", 10, 0.5, "x"),
            (2, None, None, None, None, None, None), (3, "", "en", "s", 0, 1.0, ""), (4, " \t\n", "de", "s", 3, 1.0, ""),
            (None, "no id here at all", "en", None, 4, 0.0, "y"), (5, "é🙂 ß ▁x </s> [INST]", "fr", "t", 9, 0.1, "z"),
            (6, " ".join(f"w{i}" for i in range(30000)), "en", "s", 1, 0.2, "long"), (7, "x" * 70000, "en", "s", 1, 0.2, "one word")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, ids string")


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (5, 0, 1), (99, 1, 0)],
                                 "doc_id long, quality int, toxic int")
