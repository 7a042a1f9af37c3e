import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts, start=0):
        return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "doc_id long, text string")

    return make


#: Texts that every operator must bear.
ODD = [None, "", " ", "\n\n", "a", "a\x00b", "\U0001F600 é", "x" * 200_000, "same words here again and more", "same words here again and more", "word " * 30_000]
