import pytest

from quayside.plans.session import Scratch


@pytest.fixture
def scratch(spark):
    made = Scratch(spark)
    yield made
    made.clear()


@pytest.fixture
def odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and columns whose names clash with internal ones."""
    long = "word salad " * 20_000
    rows = [
        (0, None, "en", "a", None), (1, "", "en", None, 0), (2, long, None, "b", len(long)), (3, "one", "en", "b", 3), (3, "one", "en", "b", 3),
        (None, "no id here at all", "en", "a", 17), (5, "  \t\n\n ", "en", "a", 6), (6, "Élan vital, 你好 ▁ x\x00y\n\none", "fr", "a", 23), (7, "123 $%", "en", "a", 6),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("id", "h", "line", "words", "fp", "item", "score", "lang_pred", "n_lines", "first"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df
