import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, shard int, _at string, rank int, key string, _n int"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns whose names clash with what operators use inside."""

    def f(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t), "x", 7, "y", 3, "k", 9) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return f


#: Nulls, empty and blank texts, repeated rows and ids, null ids, astral and combining characters, one long text.
ODD = [None, "", " \n\t ", "a", "one two three", "one two three", "é è 😀 ﬁ é", "word " * 20_000, "#*$%", "x" * 50_000, "1" * 30_000]


@pytest.fixture(scope="session")
def odd(make):
    return make([*ODD, "same id", "same id", "other"], [*range(len(ODD)), 100, 100, None])


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
