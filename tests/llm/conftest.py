import pytest
from pyspark.sql import functions as F

#: Columns that operators use inside: tables may have them too.
CLASHING = ("fp", "key", "class", "n", "u", "v", "root", "row", "tie", "bytes", "spans", "size", "weight", "rate", "start", "word", "m",
            "_measures", "measures", "_mix", "of", "_draw", "drawn", "_copy", "copy", "_c", "_judged", "judged", "value", "_fp", "_f", "_rest", "_text",
            "units", "rows", "first", "left", "removed")

LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls in every column, empty, blank and long texts, repeated rows and clashing columns."""
    rows = [
        (0, "One line.\nOne line.\nAnother, longer line of words.", "en", "a"),
        (1, None, "en", "a"),
        (2, "", None, "b"),
        (3, " \t\n ", "de", None),
        (4, LONG, "en", "b"),
        (4, LONG, "en", "b"),
        (5, "Zwei Wörter", "de", None),
        (5, "same id, another text", "en", None),
        (None, "no id", None, None),
        (None, None, None, None),
        (7, "no id", "en", "c"),
        (8, "\x00\x1c\u00a0\u2003 odd spaces 中文 😀 <|endoftext|> end", "fr", "c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(messy):
    """The same table without rows."""
    return messy.where("false")
