import random

import pytest

DOCS = "doc_id bigint, text string"


@pytest.fixture
def frame(spark):
    """A frame from rows and a schema, in several partitions."""

    def make(rows, schema=DOCS, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture
def prose():
    """Texts of random words from a small vocabulary, the same each time."""
    dice = random.Random(7)
    words = ["".join(dice.choices("abcdefghij", k=dice.randrange(2, 9))) for _ in range(3000)]

    def make(count):
        return " ".join(dice.choices(words, k=count))

    return make
