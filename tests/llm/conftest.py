import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)`` tuples."""

    def build(rows, extra=None):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({name: F.lit("x") for name in extra})
        return df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and blank texts, one very long text, repeated rows and a repeated id."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(40_000)) + "."
    return [
        (1, "One plain line of words that is long enough to stay.\nAnd another one here."),
        (2, None), (3, ""), (4, " \t\n "), (5, long_text), (5, "Another text under the same id."),
        (6, "repeated row text here"), (6, "repeated row text here"), (None, "a text without an id"),
        (None, None), (7, "ünï çødé ẞ   x y  double  spaces\r\nand\x0b\x0cmore"), (8, "x"),
        (9, "One plain line of words that is long enough to stay.\nAnd another one here."),
    ]


FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")
