import pytest

TESTDATA = "/root/testdata/sf0.001"
# Names that the operators use themselves, as columns of the caller's.
CLASHES = ["kept", "words", "rule", "score", "labels", "spans", "ids", "print", "bands", "_words", "_text", "_id", "component_id", "found", "base"]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{TESTDATA}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{TESTDATA}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank, tiny, huge and repeated texts, a null id, and clashing columns."""
    long_text = " ".join(f"w{i % 977} password=abcdef{i}" if i % 500 == 0 else f"w{i % 977}" for i in range(20_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "One", "en", None, 3), (5, "one", "en", "a", 3),
        (6, long_text, "en", "a", len(long_text)), (7, "mail a@b.example now", "en", "a", 20), (7, "mail a@b.example now", "en", "a", 20),
        (None, "mail a@b.example now", None, "a", None), (8, "naïve 漢字 \U0001f600 x" * 30, "fr", "b", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *[f"'mine' AS `{c}`" for c in CLASHES])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
