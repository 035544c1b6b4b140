import pytest

SF_SMALL = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string, rest string, node long, `a.b` string"


@pytest.fixture()
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    def make(*more):
        prose = " ".join(f"w{i % 97}x{i}" for i in range(300))
        rows = [(1, prose, "en", "s", 9, "e", "r", 1, "q"), (2, prose, "en", "s", 9, None, "r", 2, "q"), (2, prose, "en", "s", 9, None, "r", 2, "q"),
                (2, "another text under one id", "de", None, 9, None, None, None, None), (3, "", "en", "s", 0, "e", "r", 1, "q"),
                (4, None, None, None, None, None, None, None, None), (None, prose, "en", "s", 9, "e", "r", 1, "q"),
                (5, " \t\n ", "en", "s", 4, "e", "r", 1, "q"), (6, "x" * 200_000, "en", "s", 200_000, "e", "r", 1, "q"),
                (7, "long " * 60_000, "en", "s", 300_000, "e", "r", 1, "q"), (8, "émigré ▁ 日本語 😀 12", None, "s", 5, "e", "r", 1, "q"), *more]
        return spark.createDataFrame(rows, SCHEMA)
    return make


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
