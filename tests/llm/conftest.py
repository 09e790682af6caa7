import pytest

TEXT = "doc_id bigint, text string"


@pytest.fixture
def docs_of(spark):
    """A frame of (doc_id, text), with extra columns whose names clash with what operators add."""

    def make(rows, parts=2):
        rows = [(i, t, "x", "y") for i, t in rows]
        return spark.createDataFrame(rows, TEXT + ", verdict string, n_lines string").repartition(parts)

    return make
