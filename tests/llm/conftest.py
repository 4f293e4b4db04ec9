import pytest

LONG = "wort " * 4000


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and columns whose names clash."""
    passage = " ".join(f"benchword{i}" for i in range(40))
    rows = [
        (1, "The Cat sat on the mat. " * 3, "en"),
        (2, "the cat SAT on the mat. " * 3, "en"),
        (3, None, "de"),
        (4, "", None),
        (4, "", None),
        (None, "no id here, only text", "fr"),
        (None, None, None),
        (7, LONG + passage + " " + LONG, "de"),
        (8, "Intro. " + passage.upper() + " outro", "en"),
        (9, "released under the MIT License. See https://opensource.org/licenses/MIT", "en"),
        (9, "two rows, one id", "en"),
        (10, " 　 \n\n\t xé́ <|endoftext|> don't 日本語 12.5 ×÷", "xx"),
        (11, "short item", "en"),
        (12, "a short item appears short item", "en"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    clash = ["row", "score", "digest", "fp", "hits", "row_number", "h", "length", "label", "n", "doc", "keep_id"]
    return df.select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
