import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, k1 long, bucket int, row string, score double, near_id long, bad_id long, kept_id long, words string, h long"


def make_words(seed, n):
    r = random.Random(seed)
    return [r.choice("ba ko li mu ne so ti ra".split()) + r.choice("x y z q w v".split()) + str(r.randrange(40)) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, ids in no order; extra columns that clash."""
    extra = (1, "k", 2, 3, "r", 0.5, 4, 5, 6, "w", 7)
    passage = " ".join(make_words(5, 70))
    base = " ".join(make_words(6, 120))
    near = base.rsplit(" ", 3)[0] + " changed the end"
    long_text = " ".join(make_words(7, 60_000))
    rows = [
        (9, base, "en", "a"),
        (2, None, None, None),
        (1, "", "en", "b"),
        (5, "  \n\t ", "fr", "a"),
        (7, base, "en", "c"),
        (7, base, "en", "c"),
        (12, near, "en", None),
        (None, "no id here but some words", "en", "a"),
        (None, base, None, None),
        (20, long_text, "en", "a"),
        (21, passage + " tail one two", "de", "b"),
        (22, "head " + passage.upper(), "de", "b"),
        (23, "head of another " + passage, "de", "b"),
        (30, "one two", None, "b"),
        (31, "one two", "en", "b"),
        (40, "Ünïcödé ß 日本語 🙂 " * 30, "de", "ü"),
    ]
    return [(i, t, lang, s, len(t or ""), *extra) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(9, 1, 0), (7, 0, 1), (7, 1, 0), (12, 1, None), (None, 1, 1), (20, None, 0), (21, 0, 1), (22, 1, 0), (23, 1, 1), (99, 1, 1), (30, 0, 0)]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, quality int, toxic int, score string")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
