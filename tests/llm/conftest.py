import pytest
from llm_samples import odd_texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators make themselves, to clash with.
CLASHING = "doc_id long, text string, n_chars long, n_words long, spans string, score double, rep long, u long, component_id long, near_copy_id long"


@pytest.fixture(scope="module")
def docs_of(spark):
    def make(texts, first=0):
        rows = [(first + i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="module")
def odd(spark, docs_of):
    """Odd texts, a row twice, and rows without doc_id."""
    docs = docs_of(odd_texts())
    again = spark.createDataFrame([(12, odd_texts()[12], "en", "src", 0), (None, "no id", None, None, None), (None, None, None, None, None)], SCHEMA)
    return docs.union(again)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, 5, 6, "s", 0.5, 7, 8, 9, 10) for i, t in enumerate(odd_texts()[2:8])]
    return spark.createDataFrame(rows, CLASHING)
