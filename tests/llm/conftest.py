import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang, source]) rows, with a clashing extra column."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0, "x") for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    return make
