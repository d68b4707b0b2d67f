import duckdb  # noqa: F401
import pytest

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text) as a documents table, with columns whose names operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None, 1, "x", 2.0) for i, t in rows],
                                     DOC_COLUMNS + ", id int, n string, score double")

    return make
