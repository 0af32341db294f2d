import pytest

from linkweft.llm.frames import ship

# Rows that every operator has to take: nulls, empty, blank, very long, repeated, tied.
LONG = " ".join(f"word{k % 977}x{k % 13}" for k in range(30_000))
PASSAGE = " ".join(f"shared{k}" for k in range(60))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en"),
    (2, None, None),
    (3, "", "en"),
    (4, " \t\n ", "en"),
    (5, LONG, "en"),
    (6, f"before it {PASSAGE} after it", "en"),
    (7, f"elsewhere {PASSAGE} and on", "en"),
    (8, LONG, "en"),
    (8, LONG, "en"),
    (None, f"no id {PASSAGE}", "en"),
    (None, None, None),
    (9, "naïve café – “quoted” text with   and 　 spaces 東京", "fr"),
    (10, "x", "en"),
]


@pytest.fixture(scope="session")
def workers(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(workers):
    """The odd rows, with columns named like outputs of the operators."""
    rows = [(i, t, lang, 7, "mine", 1) for i, t, lang in ROWS]
    return workers.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, Score string, row int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")


@pytest.fixture(scope="session")
def no_labels(workers):
    return workers.createDataFrame([], "doc_id long, quality int, toxic int")
