import pytest

SF = "/root/testdata/sf0.001"
#: Texts for the defined cases: null, empty, white space, very long, ties, other scripts, control strings.
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "word " * 30_000,
    "x" * 50_000,
    "Same text, twice: it's here.",
    "Same text, twice: it's here.",
    "Über Ärger naïve İstanbul é 日本語 \U0001f600 don't we'll",
    "<|endoftext|> \x1c a\x1fb \x0b\x0c  x <|startoftext|>",
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Documents of odd texts with a null id, a repeated row, and extra columns that clash with the operators' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, part string, start string"
    rows = [(i, t, None, "s", None, "x", None, "y") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", "en", None, 5, None, "z", None), rows[6]]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
