import pytest

from marketpipe.llm.shared import prepare

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, n string, c string, label string"


@pytest.fixture
def docs(spark):
    """Builds documents from (doc_id, text[, lang, source]) rows, with extra columns whose names clash with inner ones."""
    prepare(spark)

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or ""), "x", "y", "z", "w") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
