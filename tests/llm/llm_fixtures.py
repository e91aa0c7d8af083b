import pytest

LONG = "lorem ipsum dolor " * 20_000

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "_row int, size string, key int, sha int, kept string, _size int, fp int, xent string")


def _doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None, i, "x", 1, 2, "k", 3, 4, "y")


@pytest.fixture
def messy(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and extra columns whose names helpers might use."""
    rows = [
        _doc(0, "Alpha beta gamma delta epsilon zeta"), _doc(1, "Alpha  beta gamma\ndelta epsilon zeta"),
        _doc(2, None), _doc(3, ""), _doc(4, " \t\n"), _doc(5, LONG), _doc(6, LONG + "end"),
        _doc(7, "12 34 !!", None, None), _doc(None, "no id at all, just some words here", None, "t"),
        _doc(8, "same row"), _doc(8, "same row"), _doc(9, "Éa ñu üß 漢字 😀", "xx", "t"), _doc(10, "!", "xx", None),
        _doc(11, "Alpha beta gamma delta epsilon zeta", "fr", "é"), (None,) * 13,
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
