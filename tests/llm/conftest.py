import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names an operator might use for its own.
CLASHING = ["key", "row", "n", "size", "score", "ids", "blob", "root", "pair", "bucket", "node", "label", "weight", "position", "found"]


def sentence(rng: random.Random, words: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    base = sentence(rng, 60)
    rows = [(i, sentence(rng, rng.randint(1, 80)), rng.choice(["en", "de"]), rng.choice(["a", "b", "é"]), 5) for i in range(40)]
    rows += [(100, base, "en", "a", 1), (101, base, "en", "b", 1), (101, base, "en", "b", 1), (102, base + " tail", None, None, None)]
    rows += [(None, base, "de", "a", 3), (None, None, None, None, None), (103, None, "en", "a", 0), (104, "", "en", "a", 0)]
    rows += [(105, " \n\t ", "de", None, 4), (106, "one", "de", "a", 3), (107, sentence(rng, 9000), "en", "a", 9), (108, "x" * 70_000, "en", "b", 9)]
    rows += [(109, base, "en", "a", 1), (103, base, "en", "a", 7), (110, "ÀÉ ñandú word \U0001f600 end.\r\nnext line", "es", "é", 2)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every odd case; extra columns have names that clash."""
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    return docs.withColumns({c: F.lit(f"clash-{c}") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
