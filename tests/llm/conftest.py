import pytest

from truant.llm._common import shared_dir


@pytest.fixture(scope="session")
def llm_spark(spark):
    shared_dir(spark)
    return spark


@pytest.fixture
def docs_of(llm_spark):
    """Rows of (doc_id, text) as a table with further columns, some named like those that operators make."""

    def make(rows, schema="doc_id long, text string"):
        df = llm_spark.createDataFrame(rows, schema)
        extra = {"fp": "1", "digest": "'d'", "item_id": "7", "score": "0.5", "kept": "'k'", "n": "2", "hash": "'h'", "source": "'s'"}
        return df.selectExpr("*", *[f"{v} as {k}" for k, v in extra.items() if k not in df.columns])

    return make
