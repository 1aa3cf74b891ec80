import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes a small documents table with columns whose names clash with those of the operators."""

    def make(*rows):
        schema = "doc_id bigint, text string, node bigint, words string, n_chars bigint, kept boolean"
        return spark.createDataFrame([(i, t, 5, "w", len(t or ""), False) for i, t in rows], schema)

    return make
