import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, c long, stratum int"
WORDS = "the of and a idiot clown river stone moving cloud paper lamp green seven walk under open table light north".split()


def make_text(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = [r.choice(WORDS[:4] + WORDS[6:]) + (r.choice("abcdefgh") * r.randint(0, 2)) for _ in range(n)]
    return "".join(w + (".\n" if i % 11 == 10 else " ") for i, w in enumerate(words)).strip()


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source); other columns clash with names of operators."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", 7, 0.5, 1, 2, 3) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, other white space, one very long text, repeated rows and copies."""
    long = make_text(99, 6000)
    return [(1, None, None), (2, "", "a"), (3, " \n\t ", "a"), (None, "no id here", "b"), (4, make_text(4, 80), "b"), (4, make_text(4, 80), "b"), (5, make_text(4, 80), "c"),
            (6, long, "c"), (7, "one", "a"), (8, "One", None), (9, "x\x0by\x0cz   été\r\nA", "a"), (20, make_text(20, 60), "a"), (21, make_text(4, 79) + " other", "b")]
