import pytest

WORDS = (
    "the of and to in is that for was on with they from this have not but what all were when your can said there "
    "use each which she how their will other about out many then them these some her would make like him into time "
    "has look two more write see number way could people than first water been call who oil its now find long down"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _block long, _row string, key string"


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing names."""
    long = prose(1, 30_000) + " " + "x" * 5_000
    rows = [
        (1, prose(2, 120), "en", "a", 5, 0, "r", "k"),
        (2, None, "en", "a", None, None, None, None),
        (3, "", None, None, 0, 1, "", ""),
        (4, " \t\n ", "de", "b", 4, 1, "x", "y"),
        (5, long, "en", "a", len(long), 2, "z", None),
        (None, prose(3, 80), "en", None, None, 3, "q", "k"),
        (6, prose(2, 120), "en", "b", 5, 4, "r", "k"),
        (7, "ÄÖ ünï 你好 \U0001f600 don't 123  <|endoftext|> end", "de", "b", 9, 5, "r", "k"),
        (1, prose(2, 120), "en", "a", 5, 0, "r", "k"),
        (8, "same line here\n\nsame second line\nother " + prose(4, 60), "en", "a", 1, 1, "r", "k"),
        (9, "intro\nsame line here\nsame second line\n" + prose(5, 60), "en", "c", 1, 1, "r", "k"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
