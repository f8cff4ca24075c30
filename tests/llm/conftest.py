import pytest


@pytest.fixture()
def docs_of(spark):
    """A documents table from texts, with a clashing column; ids 0.. or as given."""
    def make(texts, ids=None, sources=None, langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, (langs or ["en"] * len(texts))[k], (sources or ["s"] * len(texts))[k], "extra")
                for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row string")
    return make
