import pytest


@pytest.fixture(autouse=True)
def workers(spark):
    from flowlake.llm.common import reach_workers

    reach_workers(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table of (doc_id, text, lang, source), with columns that clash with names
    the operators use inside."""

    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, source string, row string, chunk int, place int, key string, size int, h int"
        filled = [tuple(r) + (None,) * (4 - len(r)) + ("x", 1, 2, "k", 3, 4) for r in rows]
        return spark.createDataFrame(filled, schema)

    return make
