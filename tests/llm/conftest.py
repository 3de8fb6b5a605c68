import pytest

from boardroll.llm.common import release


@pytest.fixture(scope="session", autouse=True)
def _clean(spark):
    yield
    release(spark)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) pairs, with columns whose names clash."""

    def build(*rows, parts=3):
        ddl = "doc_id long, text string, lang string, source string, score double, fp string"
        full = [(i, t, "en", "s", 0.5, "x") for i, t in rows]
        return spark.createDataFrame(full, ddl).repartition(parts)

    return build
