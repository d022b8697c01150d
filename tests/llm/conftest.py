import pytest

WORDS = "the of and to stone river light mountain über señor école 42 x9 ### | , A B".split()


def texts():
    """Awkward texts: null, empty, blank, repeated, very long, near copies and odd characters."""
    long = " ".join(WORDS[i * i % len(WORDS)] + str(i % 97) for i in range(30_000))
    base = " ".join(f"w{i}" for i in range(200))
    return [None, "", "   \n\t ", "one", "one two", "one two three", base, base, base.replace("w7 ", "q7 "), base.upper(), long, long + " tail", "a " * 700, "=" * 900, "é" * 500, "no\x00null \x1f sep\x85x", "<|endoftext|> marker", "ＡＢ ß İ"]


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward documents, with names that clash with the operators' own and repeated rows."""
    rows = [(i, t, "en", "src0", len(t or ""), 7, 8, "clash", "id") for i, t in enumerate(texts())]
    rows += [rows[6], (None, "a text without an id", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp long, row_id long, node string, id string").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
