import pytest

from odd_rows import ODD

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    """Python workers import the repository from where the tests do."""
    import __spark_entry__ as entry
    spark.sparkContext.environment.setdefault("PYTHONPATH", entry.ROOT)


@pytest.fixture
def docs(spark):
    """Make a documents table from texts or (doc_id, text) pairs."""
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(*r, "en", "s", None) for r in rows], DOCS)
    return make


@pytest.fixture
def odd(docs):
    return docs(ODD)
