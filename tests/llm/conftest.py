import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            doc, text, source = (i, r, "a") if isinstance(r, str) or r is None else (*r, "a")[:3]
            full.append((doc, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return make
