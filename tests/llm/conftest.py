from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row long, _doc string, size string, kept int, _e string"
PROSE = " ".join(f"word{i} and thing{i % 7}." for i in range(40))


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Writes rows as a table of files and reads it back: the operators number rows as they are read."""
    def store(rows, schema):
        path = str(tmp_path_factory.mktemp("table") / "t.parquet")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return store


def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, and columns that clash by name."""
    extra = (7, "x", "y", 1, "z")
    long = " ".join(f"w{i % 977} v{i}" for i in range(30_000))
    rows = [(1, PROSE, "en", "a", 10), (1, PROSE, "en", "a", 10), (2, PROSE, None, None, None), (None, None, None, None, None)]
    rows += [(3, "", "en", "a", 0), (4, " \n\t ", "en", "b", 4), (5, long, "en", "b", len(long)), (None, PROSE + " more", "en", "c", 1)]
    rows += [(6, None, "en", "a", 0), (7, "one", "en", "é", 3), (8, "one two three four", "en", None, 18)]
    return [r + extra for r in rows]


@pytest.fixture(scope="session")
def odd(stored):
    return stored(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def none(stored):
    return stored([], DOCS)
