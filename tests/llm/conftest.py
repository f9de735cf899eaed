import pytest

SMALL = "/root/testdata/sf0.01"
# Column names that the operators use themselves, in the role of a user's own columns.
CLASHING = "part long, nth long, fp long, kept string, score string, key string, label string"


@pytest.fixture
def small():
    return SMALL


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text), with further columns whose names clash."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
        tail = (None, None, 7, 7, 7, 7, "x", "x", "x", "x")
        return spark.createDataFrame([(i, t, *tail) for i, t in rows], schema)

    return make


EDGE_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "word"),
    (5, "two words"),
    (6, "Same text here, twice."),
    (7, "Same text here, twice."),
    (7, "Same text here, twice."),
    (None, "no id at all, two  spaces\n and a line"),
    (8, "x" * 30_000),
    (9, "long text of words, " * 3_000),
    (10, "<|endoftext|> é 日本語 \x1c 'll 123"),
]


@pytest.fixture
def edge_docs(make_docs):
    return make_docs(EDGE_TEXTS)


@pytest.fixture
def edge_texts():
    return EDGE_TEXTS


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])
