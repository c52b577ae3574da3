import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) or whole rows."""

    def make(rows):
        full = [r if len(r) == 5 else (r[0], r[1], "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
