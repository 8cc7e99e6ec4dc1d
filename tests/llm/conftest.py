import pytest

LONG = "word " * 3000
TEXTS = [None, "", " \n\t ", "One.", LONG, "plain text with a few words in it", "plain text with a few words in it"]


@pytest.fixture
def odd_docs(spark):
    """Null, empty, long and repeated texts, null and repeated ids, columns with clashing names."""
    rows = [(i if i != 1 else None, t, "rid", "node", 1.5) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, rid string, node string, toxicity double")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
