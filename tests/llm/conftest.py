import pytest
from pyspark.sql import functions as F

from tickforge.llm.common import reachable, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
WORDY = "The sea is calm and the boats go out before dawn every day of the week to fish for cod. "


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    reachable(spark)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="session")
def benchmark(spark, sf_dir):
    return table(spark, sf_dir, "benchmark")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empties, white space, a very long text, ties, repeated rows, other scripts."""
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\x0b ", None, "a", 4), (4, LONG, "en", None, None),
        (5, WORDY * 3, "en", "b", 1), (6, WORDY * 3, "en", "b", 1), (6, WORDY * 3, "en", "b", 1), (7, "déjà VU 語 😀 <|endoftext|>", "fr", "b", 9),
        (None, WORDY * 3, "en", "b", 1), (None, "x", None, None, None), (8, "1234 5678 --", "de", "c", 3), (9, "Z", None, "c", 1),
        (10, "!!", "en", "a", 2),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    """Extra columns named like results and internals."""
    names = ["score", "kept", "ids", "row", "fp", "predicted", "lang_pred", "langs", "n_words", "key", "y", "shard", "LANG_PRED_", "c0"]
    return odd_docs.withColumns({n: F.lit(n) for n in names})
