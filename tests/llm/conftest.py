import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, lang, source)."""

    def documents(*rows):
        full = []
        for i, r in enumerate(rows):
            r = (i, r) if isinstance(r, str) or r is None else r
            doc_id, text, lang, source = (*r, *("en", "a")[len(r) - 2 :]) if len(r) < 4 else r
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, SCHEMA)

    return documents
