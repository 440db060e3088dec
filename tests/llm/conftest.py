import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
# empty, blank, one word, equal texts, more than one space, no ASCII, a very long one
TEXTS = [
    None, "", " \n\t ", "x", "same words here", "same words here", "Same  WORDS\nhere", "é ü 日本語 ▁ 👩‍👩‍👧",
    "long " * 30_000, "a" * 40_000, "token = abcdef123456", "# | $ 1 2 3\n# | $ 1 2 3",
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, a null id, repeated rows, null sources, and columns with clashing names."""
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 3}") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", None), (None, None, "s1"), (4, "same words here", "s1"), (7, "x", None), (7, "x", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clashing = ("row", "id", "size", "score", "node", "component_id", "kept", "record", "label", "block", "n")
    return frame.select("*", *(F.lit("other").alias(name) for name in clashing)).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
