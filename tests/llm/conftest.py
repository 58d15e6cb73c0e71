import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def work(spark):
    from casewatch.llm.common import Workspace

    made = []

    def new(tag="test"):
        made.append(Workspace(spark, tag))
        return made[-1]

    yield new
    for w in made:
        w.close()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows
    and extra columns whose names clash with those of the operators."""
    long_text = " ".join(f"wort{i % 997} und der tag" for i in range(60_000))
    rows = [
        (1, "the cat sat on the mat and the dog ran over the hill", "en", "a", 10),
        (2, "the cat sat on the mat and the dog ran over the hill", "en", "a", 10),
        (2, "the cat sat on the mat and the dog ran over the hill", "en", "a", 10),
        (3, None, "en", "b", None),
        (4, "", None, None, 0),
        (5, " \t\n", "de", "", 3),
        (None, "der hund lief \x0b\x0c durch den wald", "de", None, None),
        (None, None, None, None, None),
        (6, long_text, "de", "a", 7),
        (7, "12345 !!! ???", "en", "c", 4),
        (8, "Der Hund lief durch den Wald", "de", "a", 4),
        (9, "\U0001f600 été İstanbul", "fr", "a", 4),
    ]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in ("shard", "slot", "fp", "digest", "kept", "removed", "entropy", "mix_position", "item_id", "count", "score"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
