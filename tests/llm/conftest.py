import pytest


@pytest.fixture(scope="session")
def tokenizer():
    from listrata.llm.queries import tokenizer

    return tokenizer()


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of (doc_id, text) with columns that clash with what operators add."""

    def make(rows, **more):
        rows = [(i, t, "en", "a", "b", "c", "d") for i, t in rows]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, id string, found string, gone string, body string"
        )

    return make
