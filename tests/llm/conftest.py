import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, d string, key string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with columns whose names might clash."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, f"s{(i or 0) % 3}" if i is None or i % 5 else None, len(t or ""), "x", "y") for i, t in rows], DOCS)

    return make
