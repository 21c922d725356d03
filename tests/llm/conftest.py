import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, ids string, hits string"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents (doc_id, text) with further columns whose names clash with those of results."""

    def make(rows):
        return spark.createDataFrame([(i, t, None if t is None else "en", "s", None, "r", "x", "h") for i, t in rows], COLUMNS)

    return make
