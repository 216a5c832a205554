import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table of (id, text) or whole rows."""

    def make(rows, extra=""):
        full = [r if len(r) > 2 else (*r, "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA + extra)

    return make
