import pytest

CLASHING = ["rid", "sig", "line", "size", "target", "copies", "place", "later", "row_key", "n_lines", "removed_lines", "score", "ids", "shard"]


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source) rows, with columns whose names clash with inner ones."""

    def make(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None, "x", -1, *["y"] * len(CLASHING)) for r in rows]
        names = "doc_id long, text string, lang string, source string, n_chars long, id string, n long, "
        return spark.createDataFrame(rows, names + ", ".join(f"{c} string" for c in CLASHING))

    return make
