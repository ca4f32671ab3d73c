import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents-shaped frames from (doc_id, text[, lang[, source]]) rows."""
    def make(rows, extra=""):
        full = [(*r, *(["en", "s"][len(r) - 2:]))[:4] if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([tuple(r) for r in full],
                                     "doc_id long, text string, lang string, source string" + extra)
    return make
