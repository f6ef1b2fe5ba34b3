import random

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang) of the smallest test table."""
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long, repeated and strange texts."""
    rng = random.Random(7)
    long = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60_000))
    return [
        None,
        "",
        " ",
        "\n\n\t",
        "a",
        "same words here again and again",
        "same words here again and again",
        "12 34 !!",
        "漢字 😀 é ﬁ İ ſ K ▁▁ <s></s> <|endoftext|>",
        long,
        "x" * 50_000,
        "\x00 a\x0bb\x1fc",
    ]


@pytest.fixture
def odd(spark, odd_texts):
    """The odd texts as documents with a null id, null columns, a repeated row, and extra columns of clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None, None, 1, "x", 2, 0) for i, t in enumerate(odd_texts)]
    rows += [rows[5], (None, "a row without an id", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS + ", n long, component_id string, rank int, hash long")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
