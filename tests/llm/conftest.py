import pytest

#: Names that operators use inside, too: other columns may be called anything.
EXTRA = ("score", "kept", "row", "digest", "key", "slot", "fp", "__id", "__row", "u", "name", "block", "copies")


@pytest.fixture
def docs(spark):
    """A frame of (doc_id, text, lang, source) with columns of clashing names."""

    def make(rows):
        full = [(*r, *([None] * (4 - len(r))), *["x"] * len(EXTRA)) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in EXTRA))

    return make


#: Nulls, empty and blank texts, ties, repeated rows, a very long text, letters beyond ASCII.
ROWS = [
    (1, "alpha beta gamma delta epsilon", "en", "a"), (2, None, "en", None), (3, "", None, "a"), (4, " \t\n", "de", "b"), (5, "alpha beta gamma delta epsilon", "en", "b"), (5, "alpha beta gamma delta epsilon", "en", "b"),
    (None, "no id here", "en", "a"), (None, "no id here", "en", "a"), (6, "Straße ÄÖÜ 123 \x00 ſK", "de", "c"), (7, "word " * 60_000, "en", "a"), (8, "x" * 200_000, None, "c"), (9, "alpha", "en", "a"), (9, "another text of one id", "en", "a"),
]


@pytest.fixture
def edge(docs):
    return docs(ROWS)


@pytest.fixture
def empty(docs):
    return docs([])
