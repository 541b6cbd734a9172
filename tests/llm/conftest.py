import pytest

WORDS = "the of and to in a is that for it was on with as by at from this have or one had not but what all were when we there can".split()


def prose(seed: int, n: int, words=WORDS) -> str:
    """Words in a fixed pseudo-random order."""
    out, x = [], seed * 2654435761 % 2**32 or 1
    for _ in range(n):
        x = (1103515245 * x + 12345) % 2**31
        out.append(words[(x >> 8) % len(words)] + words[(x >> 14) % len(words)] + words[(x >> 20) % len(words)])
    return " ".join(out)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def text_of():
    return prose


@pytest.fixture
def odd(spark):
    """Documents with nulls, empty and long texts, repeats, clashing columns."""
    long_text = "\n".join(prose(i, 12) for i in range(2000))
    rows = [
        (1, "", "en", "a", 0, "x"), (2, None, None, None, None, None), (None, prose(9, 30), "en", "a", 1, "x"),
        (3, prose(3, 40), "en", "a", 1, "x"), (3, prose(3, 40), "en", "a", 1, "x"), (4, long_text, "en", "b", 1, "x"),
        (5, prose(3, 40), "en", "", 1, "x"), (6, "é 　 \U0001f600 word", "en", "b", 1, "x"), (7, "\n\n \t\n", "en", "b", 1, "x"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score string"
    ).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "spans")


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
