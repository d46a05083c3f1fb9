import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Column names that operators use inside or return; as further columns they must not disturb.
CLASHING = ["row", "score", "kept", "label", "node", "text_sha256", "lang_pred", "start", "length", "uid", "gram", "bucket"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = ["ta", "ko", "mi", "ren", "sol", "va", "dur", "pel", "in", "os"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Missing values, empty and blank texts, repeated rows, repeated ids, a very long text."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
        (2, "The quick brown fox jumps  over the lazy dog.\n", "en", None, None),
        (3, None, "en", "a", None),
        (4, "", None, "a", 0),
        (5, " \t\n", None, None, 3),
        (None, "An orphan text without an id is here", None, None, None),
        (7, "A repeated row stands here twice over", "de", "b", 1),
        (7, "A repeated row stands here twice over", "de", "b", 1),
        (8, "one id", "fr", "b", 1),
        (8, "and another text under that id", "fr", "b", 1),
        (9, "12345 !!! 678", None, "c", 3),
        (10, prose(1, 60_000), "xx", "c", 3),
        (11, "Größe süß Ähre ça été où naïve 漢字 \x00 K\xa0x", "de", "c", 3),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    from pyspark.sql import functions as F

    return odd_docs.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
